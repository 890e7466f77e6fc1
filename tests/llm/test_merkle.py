"""The Merkle manifest against a plain tree, with blocks small enough for several stages; odd rows."""

import hashlib
import zlib
from collections import Counter

import pytest

from paymart.llm import merkle

SCHEMA = "text string, doc_id long, g string, lang string, n_chars long, source string, idx long, n long, u long, p long, digest string"


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def way(nodes, i):
    """(root, [(nodes before, siblings)]) by whole levels."""
    steps = []
    while len(nodes) > 1:
        a = i - i % 8
        steps.append((i - a, nodes[a:i] + nodes[i + 1 : a + 8]))
        nodes, i = [digest(nodes[k : k + 8]) for k in range(0, len(nodes), 8)], i // 8
    return nodes[0], steps


def brute(rows):
    """Rows: doc_id, source, lang, n_chars, text."""
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((r, leaf(r)))
    for group in langs.values():
        group.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    order = sorted(langs, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {g: [x for _, x in langs[g]] for g in order}
    subroots = [way(leaves[g], 0)[0] for g in order]
    for k, g in enumerate(order):
        root, above = way(subroots, k)
        for i, (r, own) in enumerate(langs[g]):
            subroot, steps = way(leaves[g], i)
            folded = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                folded = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, run in steps + above:
                folded = digest([*run[:left], folded, *run[left:]])
            proof = digest(x for _, run in steps + above for x in run)
            yield r[0], own, subroot, root, proof, folded, folded == root


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(t, i, "x", lang, n, s, 1, 2, 3, 4, "d") for i, s, lang, n, t in rows], SCHEMA).repartition(parts)


def test_manifest_against_plain_tree(spark):
    rows = [(i, "web", "en", i, f"Text {i} ÄÉ") for i in range(700)]
    rows += [(None, None, None, None, None), (None, "s", "en", 3, "Null ID"), (5, "web", "en", 5, "another of id 5"), (3, "", "", 0, "")]
    rows += [(9, "web", "de", 2, "Same row")] * 70 + [(-7, "ü", "fr", 1, "Lone"), (10**12, "s", "日本", 1, "A\nZ" * 5000), (12, "s", "日本", 1, None)]
    assert any(zlib.crc32(str(i).encode()) % 3 == 0 for i in (9, 10**12, 12))
    got = [tuple(r) for r in merkle.op13_merkle_versions(frame(spark, rows)).collect()]
    assert Counter(got) == Counter(brute(rows))
    assert {True, False} == {r[-1] for r in got}


@pytest.mark.parametrize("levels", [1, 2])
def test_stages_of_small_blocks(spark, levels):
    rows = [(i, "s", "en" if i % 9 else "de", i, f"T {i}") for i in range(600)]
    leaves = frame(spark, rows).selectExpr("doc_id id", "lang grp", "sha2(text, 256) digest", "if(doc_id % 2 = 0, sha2(lower(text), 256), null) changed")
    one = Counter(tuple(r) for r in merkle.prove_leaves(leaves).collect())
    assert Counter(tuple(r) for r in merkle.prove_leaves(leaves, levels=levels).collect()) == one


def test_lone_groups_and_empty_table(spark):
    one = [(4, "s", "en", 1, "Only")]
    assert [tuple(r) for r in merkle.op13_merkle_versions(frame(spark, one)).collect()] == list(brute(one))
    many = [(i, "s", f"l{i}", 1, "Each Its Own") for i in range(20)]
    assert Counter(tuple(r) for r in merkle.op13_merkle_versions(frame(spark, many)).collect()) == Counter(brute(many))
    none = merkle.op13_merkle_versions(frame(spark, []))
    assert none.count() == 0 and none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_versions_share_what_they_do_not_copy():
    leaves = [digest([str(i)]) for i in range(70)]
    tree = merkle.Tree(leaves, 8)
    before = [list(row) for row in tree.rows]
    copies = tree.version(13, "0" * 64)
    assert tree.rows == before
    assert len(copies) == len(tree.rows)  # one node a level
    assert copies[-1] == merkle.Tree([*leaves[:13], "0" * 64, *leaves[14:]], 8).root
    assert merkle.unpack(merkle.pack(tree.way(13))) == tree.way(13)
