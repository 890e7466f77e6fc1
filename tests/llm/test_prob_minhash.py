"""Operator 6: the work between comparisons grows with the links found, not with the classes that are already known."""

import random

import pytest

from paymart.llm import graph, prob_minhash


def brute(edges, nodes):
    up = {n: n for n in nodes}
    for _ in nodes:
        for u, v in edges:
            up[u] = up[v] = min(up[u], up[v])
    return up


@pytest.mark.parametrize("edges", [[], [(3, 3)], [(2, 1), (3, 1), (9, 7)], [(i, i + 1) for i in range(40)], [(5, 1), (5, 2), (2, 8), (9, 4)]])
def test_components_of_forests_and_chains(spark, edges):
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for u, v in edges if u != v for n in (u, v)}
    assert got == brute([e for e in edges if e[0] != e[1]], nodes)


def test_links_between_classes_leave_their_members_out_of_the_rounds(spark, monkeypatch):
    classes = spark.createDataFrame([(i, 0) for i in range(500)] + [(i, 600) for i in range(600, 700)] + [(800, 800), (801, 800)], "node long, component long")
    sizes, real = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df, **how: sizes.append((kept := real(df, **how)).count()) or kept)
    got = graph.merged(classes, spark.createDataFrame([(3, 650), (17, 601), (1000, 801), (2000, 2001)], "u long, v long"))
    found = {r.node: r.component for r in got.collect()}
    assert len(found) == got.count() == 500 + 100 + 2 + 1 + 2
    assert found == {**{i: 0 for i in [*range(500), *range(600, 700)]}, 800: 800, 801: 800, 1000: 800, 2000: 2000, 2001: 2000}
    assert max(sizes[:-1]) <= 4 and len(sizes) == 2  # links only; a forest of stars needs no round


def test_dense_group_has_the_classes_of_all_pairs(spark, monkeypatch):
    """Texts that agree in many slots without being alike: the pairs left to the last pass are sifted by longer signatures."""
    draw = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(90):
        words = list(base)
        for at in draw.sample(range(400), draw.choice([2, 6, 8, 9])):
            words[at] = f"x{i}_{at}"
        texts.append(" ".join(words))
    calls, real = [], prob_minhash.likely
    monkeypatch.setattr(prob_minhash, "LEVELS", ())
    monkeypatch.setattr(prob_minhash, "likely", lambda pairs, sketches, least, agree=prob_minhash.AGREE: calls.append((agree, pairs.count())) or real(pairs, sketches, least, agree))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in prob_minhash.op6_prob_minhash(docs).collect()}
    sets = [prob_minhash.shingles(t) for t in texts]
    links = [(i, j) for i in range(90) for j in range(i) if max(prob_minhash.similarity(sets[i], sets[j])) >= 0.8]
    assert got == brute(links, range(90))
    assert calls[-1][0] == prob_minhash.AGREE_LONG


def test_last_pass_compares_blocks_and_makes_no_row_of_a_pair(spark, monkeypatch):
    """300 classes of one text in one bucket: 44,850 pairs, but rows in proportion to the texts and their blocks only."""
    draw = random.Random(7)
    base = [f"w{i}" for i in range(300)]
    texts = {}
    for i in range(300):
        words = list(base)
        for at in draw.sample(range(300), 7):
            words[at] = f"x{i}_{at}"
        texts[i] = " ".join(words)
    for i in range(40, 50):  # alike, but in two classes so far
        texts[i + 100] = texts[i] + " more"
    monkeypatch.setattr(prob_minhash, "BLOCK", 100)
    held = spark.createDataFrame(list(texts.items()), "doc long, text string")
    buckets = spark.createDataFrame([(1, i, 5) for i in texts], "bucket long, rep long, pop long")
    classes = spark.createDataFrame([], "node long, component long")
    blocks = prob_minhash.outside_largest_class(buckets, classes, lambda reps: prob_minhash.long_sketches(held, reps))
    rows = blocks.collect()
    assert len(rows) == 299 * 3 + 300 * 3 and max(r.i for r in rows) == max(r.j for r in rows) == 2
    sketch = {r.rep: prob_minhash.np.frombuffer(r.sketch, prob_minhash.np.uint8).reshape(2, -1) for r in rows}
    near = lambda u, v: (sketch[u] == sketch[v]).sum(1).max() >= prob_minhash.AGREE_LONG
    want = {(u, v) for v in texts for u in range(v) if near(u, v)}
    got = [tuple(r) for r in prob_minhash.likely(blocks, None, 0.8, prob_minhash.AGREE_LONG).collect()]
    assert len(got) == len(set(got)) and set(got) == want and {(i, i + 100) for i in range(40, 50)} <= want


@pytest.mark.parametrize("small", [0, 8])
def test_pairs_of_a_bucket(spark, monkeypatch, small):
    """A small bucket's texts all meet across classes, a large one's meet its most popular text, in no second join."""
    monkeypatch.setattr(prob_minhash, "SMALL", small)
    rows = [(1, 4, 9, 4), (1, 5, 7, 5), (1, 6, 7, 4), (1, 7, 2, 7), (2, 8, 1, 8), (2, 9, 1, 8)]
    pairs, large = prob_minhash.bucket_pairs(spark.createDataFrame(rows, "bucket long, rep long, pop long, c long"))
    every = {(4, 5), (4, 7), (5, 6), (5, 7), (6, 7)}
    assert {tuple(r) for r in pairs.collect()} == (every if small else {(4, 5), (4, 7)}) and pairs.count() == (5 if small else 2)
    assert large.count() == (0 if small else 4)


def test_texts_of_buckets_that_still_hold_two_classes(spark):
    """Buckets 1 and 2 still hold two classes, 3 has come to one. Rows are looked up for buckets like 3 only."""
    rows = [(1, 4, 9), (1, 5, 7), (2, 4, 9), (2, 6, 3), (3, 6, 3), (3, 7, 2), (3, 8, 2)]
    classes = spark.createDataFrame([(6, 6), (7, 6), (8, 6)], "node long, component long")
    buckets = spark.createDataFrame(rows, "bucket long, rep long, pop long")
    got = [tuple(r) for r in prob_minhash.still_two(buckets, classes).collect()]
    assert sorted(got) == [(4, 9), (5, 7), (6, 3)]
    dense = prob_minhash.still_two(buckets.where("bucket < 3"), classes)
    assert "Join" not in dense._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in dense.collect()) == [(4, 9), (5, 7), (6, 3)]
    assert prob_minhash.still_two(buckets.where("bucket = 3"), classes).isEmpty()
