"""Window removal against brute force, with small chunks, shards and groups; the sketch never undercounts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from paymart.llm import count_min_windows as cm

SCHEMA = "chunk long, windows long, text string, doc_id long, ids string, body string, n_words int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, width=20):
    texts = [(2**63 - 1 if i is None else i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, words in texts:
        for k in range(len(words) - width + 1):
            w = tuple(words[k : k + width])
            first[w] = min(first.get(w, i), i)
    for (doc, _), (i, words) in zip(rows, texts):
        gone, seen = set(), set()
        for k in range(len(words) - width + 1):
            w = tuple(words[k : k + width])
            if first[w] < i or w in seen:
                gone.update(range(k, k + width))
            seen.add(w)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        yield doc, len(words), len(gone), kept


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(1, 2, t, i, "x", "y", 3) for i, t in rows], SCHEMA).repartition(parts)


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta Äpfel 中文 🙂 b.a x-1 I'll".split()) + str(rng.randrange(90)) for _ in range(n))


def rows_with_copies():
    shared, other = sentence(1, 60), sentence(2, 21)
    rows = [(i, sentence(100 + i, 5 + i % 50) + "\n\n" + (shared if i % 3 else other) + " end" * (i % 30)) for i in range(60)]
    rows += [(200, shared.replace(" ", "\t\r\n\x0b\x0c ")), (-5, "lead " + shared + " tail"), (201, "same " * 300), (202, "same " * 19), (203, "same " * 20)]
    rows += [(300, None), (301, ""), (302, " \n\t "), (None, "null id " + shared), (None, shared), (7, shared), (7, shared), (7, other)]
    rows += [(400, sentence(9, 3000)), (401, sentence(9, 3000) + " more"), (402, " nbsp em " * 30), (403, "w" * 5000 + " " + sentence(9, 40))]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"chunk": 900, "shard": 64, "group": 50}, {"chunk": 1, "shard": 1 << 12, "group": 7, "cells": 1}])
def test_against_brute_force(spark, sizes):
    rows = rows_with_copies()
    got = Counter(tuple(r) for r in cm.keep_first_windows(frame(spark, rows), **sizes).collect())
    assert got == Counter(brute(rows))


def test_other_width_and_digest(spark):
    rows = rows_with_copies()
    got = Counter(tuple(r) for r in cm.keep_first_windows(frame(spark, rows), width=3, chunk=5000).collect())
    assert got == Counter(brute(rows, 3))
    digests = Counter(tuple(r) for r in cm.op12_count_min_windows(frame(spark, rows)).collect())
    assert digests == Counter((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute(rows))


def test_tables_without_windows(spark):
    none = cm.op12_count_min_windows(frame(spark, []))
    assert none.count() == 0 and none.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    short = [(1, "a b c"), (2, None), (2, None)]
    assert Counter(tuple(r) for r in cm.keep_first_windows(frame(spark, short)).collect()) == Counter(brute(short))


def test_cells_survive_their_encoding():
    rng = np.random.default_rng(0)
    for n, top in ((0, 9), (1, 1 << 23), (5000, 1 << 23), (90, 100)):
        cells = np.unique(rng.integers(0, top, n))
        twice = rng.integers(0, 2, len(cells)).astype(bool)
        back, bits = cm.decode_cells(cm.encode_cells(cells, twice))
        assert (back == cells).all() and (bits == twice).all()


def test_sketch_loses_no_repeated_window(spark):
    rows = rows_with_copies()
    docs = frame(spark, rows).selectExpr("doc_id i", "cast(text as binary) t")
    table = cm.chunks(docs, 20, 2000)
    shards, shard = 5, 256
    answers = [r.asDict() for r in cm.merged(cm.sketches(table, 20, shards, shard), shard).collect()]
    seen, passed = Counter(), Counter()
    for row in table.collect():
        chunk = cm.Chunk(row.asDict(), 20)
        keys = list(zip(chunk.h1.tolist(), chunk.h2.tolist()))
        seen.update(keys)
        found = cm.Candidates(chunk, [a for a in answers if a["chunk"] == chunk.number], shards, shard, 3)
        passed.update(keys[k] for k in found.at)
    assert all(passed[k] == n for k, n in seen.items() if n > 1)
    assert 0 < sum(n for k, n in passed.items() if seen[k] == 1) < sum(n == 1 for n in seen.values())
