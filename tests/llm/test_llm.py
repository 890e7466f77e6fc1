"""Training-data operators against brute force on small inputs; nulls, empties, repeated rows, clashing columns."""

import collections
import hashlib
import itertools
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paymart.llm import line_crf, packing, prob_minhash, range_coder, suffix_dedup, tool_calls, warc_zip, weighted_sampling
from paymart.llm.bpe import coder, op7_bpe
from paymart.llm.cotraining import keep_good, op10_cotraining
from paymart.llm.token_cache import default_tokenizer, library_encoder

SF = "/root/testdata/sf0.001"
PASSAGE = "The committee met on a rainy day and talked at length about nothing much, before it went home in the dark. " * 3
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "J̌ ΟΔΟΣ Σ İ don't I'LL 12.5 x…y ﬁ 中文 🙂 é <|endoftext|> b"), (5, "one two"),
    (6, "a start, then " + PASSAGE + " an end"), (7, PASSAGE + "other end"), (8, "same " * 400), (9, "same " * 400), (9, "same " * 400),
    (None, "no id " + PASSAGE), (10, "words " + " ".join(f"w{i}" for i in range(3000))),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, k string, t string, spans string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, "s", None, "k", "t", "x") for i, t in ODD], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def ids_of(text):
    tok = library_encoder(default_tokenizer()).tok
    return tok.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_bpe_matches_library(odd, empty):
    tok = library_encoder(default_tokenizer()).tok
    want = []
    for i, t in ODD:
        ids = ids_of(t)
        text = tok.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in op7_bpe(odd, default_tokenizer()).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert op7_bpe(empty, default_tokenizer()).count() == 0
    assert coder(default_tokenizer()).encode(["a b"]) == library_encoder(default_tokenizer()).encode(["a b"])


def test_range_coder_round_trip_and_checksum():
    rng = np.random.default_rng(0)
    for ids in ([7], rng.integers(0, 49408, 5000), np.tile(rng.integers(0, 300, 700), 9), [2**31 - 2, 0, 1], rng.zipf(1.3, 4097) % 40000):
        ids = np.array(ids, np.uint32)
        blocks = range_coder.encode_blocks(ids)
        assert (range_coder.decode_blocks(blocks) == ids).all()
    bad = bytearray(blocks[0])
    bad[-3] ^= 1
    with pytest.raises((ValueError, IndexError)):
        range_coder.decode_blocks([bytes(bad)])


def test_range_coder_finds_every_changed_bit_of_a_blocks_last_words():
    block = range_coder.encode_blocks(np.array([3, 1, 2, 3, 1, 2, 2], np.uint32))[0]
    for bit in range(48):
        bad = bytearray(block)
        bad[-1 - bit // 8] ^= 1 << bit % 8
        with pytest.raises((ValueError, IndexError)):
            range_coder.decode_blocks([bytes(bad)])


def test_range_coder_finds_predictions_for_all_steps_at_once():
    rng = np.random.default_rng(1)
    symbols = rng.integers(1, 8, (70, range_coder.BLOCK)).astype(np.int16)
    mixer = range_coder.Mixer(np.full(70, 7), decodes=True)
    found = range_coder.predictions(symbols)
    for step, s in enumerate(np.ascontiguousarray(symbols.T)):
        got = mixer.recall()
        assert (found[step] == got).all()
        mixer.weigh(got)
        start, size = mixer.span(s)
        assert (size > 0).all() and (mixer.find(start)[0] == s).all() and (mixer.find(start + size - 1)[0] == s).all()
        mixer.learn(s, symbols.T)


def test_range_coder_alphabet_takes_two_bytes_a_wide_gap():
    for ids, length in (([5, 6, 1000, 49_000], 4 + 2 * 2), ([0, 70_000], 2 + 4), ([3], 1), ([300], 3), ([2**31 - 2], 5)):
        raw = range_coder.pack_alphabet(np.array(ids, np.uint32))
        assert len(raw) == length and range_coder.unpack_alphabet(raw, len(ids)).tolist() == ids


def test_token_files(odd, empty):
    got = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in range_coder.op4_range_coder(odd, default_tokenizer()).collect()}
    rows = sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0))
    start, want = 0, set()
    for i, t in rows:
        ids = [*ids_of(t), 1]
        want.add((i, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    assert got == want
    assert range_coder.op4_range_coder(empty, default_tokenizer()).count() == 0


def test_packing(odd, empty):
    rows = packing.op9_best_two_fit(odd, default_tokenizer(), capacity=64).collect()
    want = collections.Counter()
    for i, t in ODD:
        ids = [*ids_of(t), 0]
        for k in range(0, len(ids), 64):
            want[(i, k // 64, k, len(ids[k : k + 64]), zlib.crc32(packed(ids[k : k + 64])))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert packing.op9_best_two_fit(empty, default_tokenizer()).count() == 0


def test_best_two_fit_replaces_the_smallest():
    # greedy takes 6 + 3; its 3 gives way to 2 + 2, which fill the gap of 10 - 6 exactly
    patterns = packing.plan_patterns({6: 1, 3: 1, 2: 2}, 10)
    assert patterns[0] == (1, [6, 2, 2])


def brute_spans(rows, length):
    counts = collections.Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        counts.update(raw[k : k + length] for k in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if counts[raw[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        n_spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("group", [2048, 2])
def test_suffix_dedup(spark, odd, empty, group):
    assert collections.Counter(map(tuple, suffix_dedup.op2_suffix_dedup(odd, group=group).collect())) == brute_spans(ODD, 200)
    edges = [(i, f"{i} left {i * 7919}" * 3 + PASSAGE[:230] + f"{i * 104729} right" * 3) for i in range(9)]
    docs = spark.createDataFrame(edges, "doc_id long, text string")
    assert collections.Counter(map(tuple, suffix_dedup.op2_suffix_dedup(docs, group=group).collect())) == brute_spans(edges, 200)
    assert suffix_dedup.op2_suffix_dedup(empty).count() == 0


def test_maximal_repeats(spark):
    docs = spark.createDataFrame([(1, "x" + PASSAGE[:250] + "y1"), (2, "zz" + PASSAGE[:250] + "q"), (3, "unrelated")], "doc_id long, text string")
    got = suffix_dedup.repeats(docs).collect()
    assert got and max(r.n_bytes for r in got) <= 250
    assert any(sorted(o.start for o in r.occurrences) and len(r.occurrences) == 2 for r in got)


def test_remove_repeats_keeps_columns(odd):
    out = suffix_dedup.remove_repeats(odd)
    assert out.columns == odd.columns and out.count() == len(ODD)


def test_warc(spark, tmp_path):
    long = "<p>" + "x" * 1200
    rows = [(1, "u1", long), (2, "u2", "short"), (3, None, None), (4, "u4", long), (5, "u\r\n5", "short"), (9, "u9", long), (None, "n", long), (2, "u2", "short")]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string").repartition(2)
    got = collections.Counter(tuple(r) for r in warc_zip.op3_warc_zip(pages).collect())
    want = collections.Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = len(raw) >= 1000 and i is not None and i != 9
        want[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None)] += 1
    assert got == want
    for zip64 in (False, True):
        manifest = warc_zip.write_packages(warc_zip.mark_revisits(pages), f"file://{tmp_path}/{zip64}", package_bytes=700, zip64=zip64)
        assert manifest.count() > 1
        assert warc_zip.read_packages(manifest, span_bytes=300).count() == len(rows)
    import zipfile
    for row in manifest.collect():
        with zipfile.ZipFile(row.package.removeprefix("file://")) as z:
            assert z.testzip() is None and set(z.namelist()) == {warc_zip.ARCHIVE, warc_zip.INDEX}
    assert warc_zip.op3_warc_zip(pages.limit(0)).count() == 0


def test_line_rules(odd, empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in line_crf.op5_line_crf(odd, labels).collect()}
    import re
    want = set()
    for i, t in ODD:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        counts = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {k + j for k, x in enumerate(zip(w, w[1:], w[2:])) if counts[x] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.add((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)))
    assert got == want
    assert line_crf.op5_line_crf(empty, labels).count() == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(30):
        model = line_crf.LineField(transition=rng.normal(size=(2, 2)))
        scores = rng.normal(size=6).tolist()
        value = lambda y: sum(s for s, k in zip(scores, y) if k) + sum(model.transition[a, b] for a, b in zip(y, y[1:]))
        best = max(itertools.product((0, 1), repeat=6), key=value)
        assert tuple(model.viterbi(scores)) == best


def line_field_documents():
    """Labelled documents whose bad ones turn to number rows after 40 clean lines, and a document of both."""
    clean = [" ".join(f"{w}{k}a" for w in ("river", "stone", "over", "the", "long", "walk", "home")) for k in range(120)]
    rows = [" ".join(str(10_000 + 97 * k + j) for j in range(7)) for k in range(40)]
    docs = [(i, "\n".join(x.replace("river", f"river{i}") for x in clean), 1) for i in range(20)]
    docs += [(100 + i, "\n".join(clean[:40] + [f"{x} {i}" for x in rows]), 0) for i in range(20)]
    return docs, "\n".join(clean[:6] + rows[:6] + clean[6:12] + rows[6:12]), [1] * 6 + [0] * 6 + [1] * 6 + [0] * 6


def test_line_field_sees_lines_after_the_first_ones_and_switches_inside(spark):
    docs, mixed, want = line_field_documents()
    rows = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in docs], "doc_id long, quality int")
    model = line_crf.train(rows, labels)
    got = line_crf.label_lines(spark.createDataFrame([(7, mixed)], "doc_id long, text string"), model).first()
    assert list(got.labels) == want
    assert (model.transition == line_crf.LineField().transition).all()


def test_line_field_switches_are_not_unlearnt():
    # chains of one label each, short ones as well: the labels of a mixed document still change inside it
    rng = np.random.default_rng(5)
    line = lambda x: np.array([1.0, *[0.0] * 10, x])
    chains = [(np.array([line(max(0.0, (0.3 if y else 0.7) + rng.normal() * 0.25)) for _ in range(4)]), y) for y in (0, 1) for _ in range(100)]
    model = line_crf.fit(chains)
    scores = (np.array([line(x) for x in (0.1, 0.1, 0.9, 0.9, 0.1, 0.1, 0.1)]) @ model.emission).tolist()
    assert model.viterbi(scores) == [1, 1, 0, 0, 1, 1, 1]


def test_line_field_gradient_of_long_and_short_chains():
    # documents over CHAIN lines are fitted whole: with all lines of one document alike, its length changes no label
    good, bad = np.array([[1.0] + [0.0] * 11]), np.array([[1.0] + [0.0] * 10 + [1.0]])
    model = line_crf.fit([(np.repeat(good, 2500, 0), 1), (good, 1), (np.repeat(bad, 3, 0), 0), (np.repeat(bad, 1500, 0), 0)])
    assert (good @ model.emission)[0] > 0 > (bad @ model.emission)[0]


@pytest.mark.parametrize("judge", [lambda d, l: line_crf.op5_line_crf(d, l), lambda d, l: op10_cotraining(d, l)])
def test_judges_keep_good_and_reject_bad(spark, judge):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = judge(spark.read.parquet(f"{d}/documents.parquet"), labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in got}
    assert kept[1] > 0.93 and kept[0] < 0.1


def test_training_takes_one_row_of_a_repeated_id(spark, monkeypatch):
    import paymart.llm.cotraining as cotraining
    docs = [(i, f"text number {i} of a few words", "en", "s", 9) for i in range(12)]
    docs += [(i, f"copy {k} of one id\nand a line", "en", "s", 9) for i in (0, 11) for k in range(300)] + [(1, None, None, None, None)] * 300
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10)] + [(0, 1, 0)], "doc_id long, quality int, toxic int")
    seen = {}
    monkeypatch.setattr(cotraining, "cotrain", lambda rows: seen.setdefault("op10", len(rows)) and None)
    monkeypatch.setattr(line_crf, "fit", lambda chains: seen.setdefault("op5", len(chains)) and None)
    cotraining.train(docs, labels)
    line_crf.train(docs, labels)
    assert seen["op10"] == 13 and seen["op5"] in (10, 11)  # ids and contradicting labels count; an empty text has no lines


def test_cotraining_odd(odd, empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert op10_cotraining(odd, labels).where("kept").count() == len(ODD)
    assert keep_good(empty, labels).count() == 0


def test_signatures_of_many_texts_equal_those_of_one():
    texts = [t or "" for _, t in ODD] + ["a", "a b c d e", "x " * 300, " ".join(f"v{i % 90}" for i in range(700))]
    alone = [prob_minhash.signature(h, n.astype(float)) for h, n in map(prob_minhash.shingles, texts)]
    assert (prob_minhash.signatures_of(texts) == np.array(alone)).all() and prob_minhash.signatures_of([]).shape == (0, 128)


def test_prob_minhash_estimate_and_classes(spark, odd, empty):
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(1, 2**62, 300).astype(np.uint64))
    b = np.unique(np.concatenate([a[60:], rng.integers(1, 2**62, 60).astype(np.uint64)]))
    wa, wb = rng.integers(1, 4, len(a)), rng.integers(1, 4, len(b))
    estimate = (prob_minhash.signature(a, wa.astype(float), 4096) == prob_minhash.signature(b, wb.astype(float), 4096)).mean()
    exact, plain = prob_minhash.similarity((a, wa), (b, wb))
    naive = 0.0
    x, y = dict(zip(a.tolist(), wa.tolist())), dict(zip(b.tolist(), wb.tolist()))
    for i in x.keys() & y.keys():
        naive += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
    assert abs(exact - naive) < 1e-9 and abs(estimate - exact) < 0.04 and plain == len(x.keys() & y.keys()) / len(x.keys() | y.keys())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.class_id for r in prob_minhash.op6_prob_minhash(docs).collect()}
    sets = {r.doc_id: prob_minhash.shingles(r.text or "") for r in docs.collect()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        if max(prob_minhash.similarity(sets[i], sets[j])) >= 0.8:
            p, q = root(i), root(j)
            parent[max(p, q)] = min(p, q)
    assert got == {i: root(i) for i in sets}
    classes = {r.doc_id: r.class_id for r in prob_minhash.op6_prob_minhash(odd).collect()}
    assert classes[1] == classes[2] == classes[3] == 1 and classes[8] == classes[9] == 8 and classes[10] == 10
    assert prob_minhash.keep_representatives(odd).count() == len(set(classes.values()))
    assert prob_minhash.op6_prob_minhash(empty).count() == 0


def test_equal_shingle_sets_of_unlike_counts_are_one_class(spark):
    rows = []
    for k in range(20):  # the second text repeats a passage of the first a hundred times
        words = [f"p{k}w{i}" for i in range(300)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:14] * 99 + words))]
    weighted, plain = prob_minhash.similarity(*(prob_minhash.shingles(t) for _, t in rows[:2]))
    assert weighted < 0.25 and plain > 0.9
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in prob_minhash.op6_prob_minhash(docs).collect()} == {i: i - i % 2 for i, _ in rows}
    texts = [t for _, t in rows] + ["", "a b", "x " * 300]
    ends, keys = prob_minhash.buckets_of(texts)
    for text, own in zip(texts, np.split(keys, ends[:-1])):
        h, n = prob_minhash.shingles(text)
        sigs = np.array([prob_minhash.signature(h, n.astype(float)), prob_minhash.signature(h, np.ones(len(h)))])
        assert len(set(own.tolist())) == len(own) and set(own.tolist()) == set(prob_minhash.band_keys(sigs).ravel().tolist())


def test_weighted_sampling(spark, odd, empty):
    rows = weighted_sampling.op8_weighted_sampling(odd).collect()
    assert len(rows) == len(ODD)
    order = sorted({i for i, _ in ODD}, key=lambda i: (i is not None, i or 0))
    text = {i: t or "" for i, t in ODD}
    for r in rows:
        own, after = text[r.doc_id], text[order[(order.index(r.doc_id) + 1) % len(order)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        x, y = (collections.Counter(v.lower().split()) for v in (own, edited))
        if x or y:
            assert abs(r.near_edited - sum((x & y).values()) / sum((x | y).values())) < 0.3
    same = {r.fingerprint for r in rows if r.doc_id in (8, 9)}
    assert len(same) == 1 and len(next(iter(same))) == 4 * weighted_sampling.SAMPLES
    assert weighted_sampling.op8_weighted_sampling(empty).count() == 0


def test_reach_leaves_samples_as_they_are(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(2, "doc_id")
    near = {r.doc_id: r.samples for r in weighted_sampling.fingerprints(docs, ["doc_id"], ["text"]).collect()}
    far = {r.doc_id: r.samples for r in weighted_sampling.fingerprints(docs, ["doc_id"], ["text"], reach=None).collect()}
    assert near == far


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", 1, "f", '{"n": 1.0, "b": "é"}', []), (1, "b", 3, "f", '{"n": 99}', ["a", "zz"]), (1, "c", 5, "g", "{", ["b", "b"]),
            (1, "early", 2, "f", None, ["late"]), (1, "late", 7, "f", '{"n": 2}', ["a"]), (1, "x", 4, "f", '{"n": 2}', ["y"]), (1, "y", 6, "f", '{"n": 2}', ["x"]),
            (1, "a", 1, "f", '{"n": 1.0, "b": "é"}', []), (2, "a", 1, "f", '{"n": true}', ["a"]), (None, "a", 1, "f", '{"n": 3}', []), (3, None, 1, "f", '{"n": 3}', None),
        ],
        "conv_id long, call_id string, turn long, name string, arguments string, refs array<string>",
    )
    results = spark.createDataFrame([(1, "a", 2, "ok"), (1, "a", 4, "again"), (1, "nobody", 2, "lost"), (None, "a", 1, "stray")], "conv_id long, call_id string, turn long, content string")
    schemas = {"f": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "maximum": 10}}}}
    rows = tool_calls.link_tool_calls(calls, results, schemas).collect()
    by = {(r.conv_id, r.call_id): r for r in rows if r.status != "unlinkable"}
    first = by[1, "a"]
    assert (first.status, first.n_copies, first.n_results, first.result_turn, first.valid) == ("answered", 2, 2, 2, True)
    assert first.record == '{"arguments":{"b":"é","n":1},"id":"a","name":"f","result":"ok"}'
    assert by[1, "b"].errors == ["$.n maximum"] and by[1, "b"].n_missing_refs == 1 and by[1, "c"].errors == ["unknown tool"] or by[1, "c"].errors == ["$ not JSON"]
    assert by[1, "nobody"].status == "orphan" and by[2, "a"].errors == ["$.n type"] and by[2, "a"].position is None
    place = {k[1]: r.position for k, r in by.items() if k[0] == 1}
    assert place["x"] is None and place["y"] is None
    assert place["a"] < place["b"] < place["c"] and place["a"] < place["late"] < place["early"]
    assert sorted(v for v in place.values() if v is not None) == list(range(5))
    assert sum(r.status == "unlinkable" for r in rows) == 3
    assert tool_calls.link_tool_calls(calls.limit(0), results.limit(0), schemas).count() == 0
    assert tool_calls.canonical(json.loads('{"b":[1,{"z":null,"a":"\\n"}],"a":2}')) == '{"a":2,"b":[1,{"a":"\\n","z":null}]}'


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "repeated_passages", "packing"]
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} <= docs.keys() and len(rows) > 50
    assert all(r.offset + r.length <= 2048 for r in rows)


@pytest.mark.parametrize("schema", [
    {"anyOf": [{"type": "string"}]}, {"type": "object", "properties": {"a": {"multipleOf": 2}}}, {"items": {"uniqueItems": True}},
    {"additionalProperties": {"$ref": "#/x"}}, {"type": "date"}, {"type": ["string", "any"]}, {"items": True}])
def test_unknown_schema_rules_raise(spark, schema):
    with pytest.raises(ValueError):
        tool_calls.check_schema(schema)
    calls = spark.createDataFrame([], "conv_id long, call_id string, turn long, name string, arguments string, refs array<string>")
    results = spark.createDataFrame([], "conv_id long, call_id string, turn long, content string")
    with pytest.raises(ValueError):
        tool_calls.link_tool_calls(calls, results, {"f": schema})
    tool_calls.check_schema({"type": "object", "title": "t", "properties": {"a": {"type": ["integer", "null"], "description": "d"}}})
