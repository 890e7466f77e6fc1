"""Operator 13, Merkle dataset manifest: a persistent tree whose versions copy only the ancestors of what changed.

Every row is a leaf, the sha256 of its fields. Within a group (a language) the leaves ascend by id, and every ARITY
consecutive nodes become the hash of their digests, level by level, until one node remains: the group's subroot. The
subroots, ordered by group, give the root in the same way.

The tree is stored in aligned blocks of ARITY ** LEVELS nodes. Upwards, a task reduces the nodes of a block to the block's
root; the roots are the nodes of the next stage, so that a group of any size takes a few stages, each spread over its
blocks. Downwards, each block hands its nodes their way to the root: the siblings on each level, in the block and above.
In the last step, a block of leaves makes a version for each changed leaf: the version shares every untouched node with
the original tree and copies the leaf's ancestors within the block; it goes on along the block's way, copying the upper
ancestors, to the version's root. So versions stay spread as the leaves are, and no task sees more than a block of nodes.

Ranks come from a range partitioning by (group, id, leaf): each partition numbers its rows, and the counts of the
partitions before are added. Equal rows are told apart by a number of their own, so that many of them are spread as well.

Null fields count as `-`; a null id comes first in its group and is never changed; a null group is a group of its own, the
first. Rows that share an id are ordered by their leaves; equal rows are leaves beside each other, with results of their
own. Texts of any length are hashed whole, by built-in functions. An empty table gives an empty result. Columns that a leaf
doesn't use, whatever their names, are not read."""

from __future__ import annotations

import hashlib
import string
import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.common import cut, workers_can_import

ARITY, LEVELS = 8, 4
NODES = "g string, idx long, n long, digest string"
WAYS = "g string, idx long, way binary, subroot string, root string"
PROOFS = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = struct.Struct("<BB")
_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def h(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Tree:
    """A block's nodes. They are never changed; a version is what it has copied."""

    def __init__(self, leaves: list[str], arity: int, levels: int | None = None):
        """`levels` to reduce by, or None: until one node remains."""
        self.arity, self.rows = arity, [leaves]
        while len(self.rows[-1]) > 1 if levels is None else len(self.rows) <= levels:
            below = self.rows[-1]
            self.rows.append([h(below[i : i + arity]) for i in range(0, len(below), arity)])

    @property
    def root(self) -> str:
        return self.rows[-1][0]

    def way(self, i: int) -> list[tuple[int, list[str]]]:
        """(nodes before, siblings) on each level from leaf i up."""
        steps = []
        for row in self.rows[:-1]:
            first = i - i % self.arity
            steps.append((i - first, row[first:i] + row[i + 1 : first + self.arity]))
            i //= self.arity
        return steps

    def version(self, i: int, leaf: str) -> list[str]:
        """The copies that the tree with another leaf i has in place of its ancestors, from below; all else is shared."""
        copies = [leaf]
        for row in self.rows[:-1]:
            first = i - i % self.arity
            run = row[first : first + self.arity]
            run[i - first] = copies[-1]
            copies.append(h(run))
            i //= self.arity
        return copies


def pack(steps: list[tuple[int, list[str]]]) -> bytes:
    return b"".join(_STEP.pack(left, len(nodes)) + bytes.fromhex("".join(nodes)) for left, nodes in steps)


def unpack(way: bytes) -> list[tuple[int, list[str]]]:
    steps, at = [], 0
    while at < len(way):
        left, n = _STEP.unpack_from(way, at)
        at += _STEP.size
        steps.append((left, [way[at + 32 * k : at + 32 * k + 32].hex() for k in range(n)]))
        at += 32 * n
    return steps


def climb(digest: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root of a version that goes on with `digest`."""
    for left, nodes in steps:
        digest = h([*nodes[:left], digest, *nodes[left:]])
    return digest


def filled(schema: str, columns: list | None = None) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    columns = columns or [[] for _ in fields]
    return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, _ARROW[kind]) for (_, kind), c in zip(fields, columns)], [name for name, _ in fields])


def framed(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(framed, fields)), 256)


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """`rows` with their place `idx` in their group g and its size n, by `order`, without a task for a whole group."""
    rows = cut(rows.withColumn("u", F.monotonically_increasing_id()))
    held = rows.repartitionByRange(F.col("g"), *order, F.col("u")).withColumn("p", F.spark_partition_id())
    inside = Window.partitionBy("p", "g").orderBy(*order, "u")
    held = cut(held.withColumn("k", F.row_number().over(inside)))
    counts = held.groupBy("p", "g").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    bases = counts.select("p", "g", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"), F.sum("c").over(Window.partitionBy("g")).alias("n"))
    return held.join(bases, ["p", "g"]).withColumn("idx", F.col("base") + F.col("k") - 1).drop("p", "u", "k", "base", "c")


def _tree(nodes: pa.Table, digest: str, arity: int, levels: int) -> tuple[pa.Table, Tree]:
    nodes = nodes.sort_by("idx")
    whole = nodes.column("n")[0].as_py() <= arity**levels
    return nodes, Tree(nodes.column(digest).to_pylist(), arity, None if whole else levels)


class Manifest:
    """The stages of nodes of all groups, from the leaves up; `tops` has a node for each group."""

    def __init__(self, leaves: DataFrame, arity: int = ARITY, levels: int = LEVELS):
        """`leaves`: NODES, read several times, so cut off from its lineage."""
        workers_can_import(leaves.sparkSession)
        self.arity, self.levels, self.block = arity, levels, arity**levels
        self.stages = [leaves.select("g", "idx", "n", "digest")]
        most = leaves.agg(F.max("n")).first()[0] or 0
        while most > 1:
            self.stages.append(cut(self._reduced(self.stages[-1])))
            most = -(-most // self.block)

    def _blocks(self, nodes: DataFrame):
        return nodes.withColumn("b", F.floor(F.col("idx") / self.block)).groupBy("g", "b")

    def _reduced(self, nodes: DataFrame) -> DataFrame:
        arity, levels, block = self.arity, self.levels, self.block

        def reduce(key: tuple, rows: pa.Table) -> pa.Table:
            _, tree = _tree(rows, "digest", arity, levels)
            n = -(-rows.column("n")[0].as_py() // block)
            return filled(NODES, [[key[0].as_py()], [key[1].as_py()], [n], [tree.root]])

        return self._blocks(nodes).applyInArrow(reduce, NODES)

    @property
    def tops(self) -> DataFrame:
        return self.stages[-1]

    def down(self, ways: DataFrame, stage: int = 0) -> DataFrame:
        """WAYS of the nodes of a stage, from those of the tops."""
        arity, levels = self.arity, self.levels

        def hand(nodes: pa.Table, above: pa.Table) -> pa.Table:
            if not nodes.num_rows:
                return filled(WAYS)
            nodes, tree = _tree(nodes, "digest", arity, levels)
            upper, subroot, root = (above.column(c)[0].as_py() for c in ("way", "subroot", "root"))
            n = nodes.num_rows
            own = [pack(tree.way(i)) + upper for i in range(n)]
            return filled(WAYS, [nodes.column("g"), nodes.column("idx"), own, [subroot] * n, [root] * n])

        for nodes in reversed(self.stages[stage:-1]):
            ways = cut(self._blocks(nodes).cogroup(ways.groupBy("g", "idx")).applyInArrow(hand, WAYS))
        return ways

    def versions(self, leaves: DataFrame, ways: DataFrame) -> DataFrame:
        """PROOFS of leaves (NODES, id, changed): `ways` are those of the blocks of leaves; changed null: the leaf as it is."""
        arity, levels = self.arity, self.levels

        def prove(nodes: pa.Table, above: pa.Table) -> pa.Table:
            if not nodes.num_rows:
                return filled(PROOFS)
            nodes, tree = _tree(nodes, "digest", arity, levels)
            way, subroot, root = (above.column(c)[0].as_py() for c in ("way", "subroot", "root"))
            upper = unpack(way)
            beyond = "".join(x for _, run in upper for x in run)
            leaf = nodes.column("digest").to_pylist()
            proofs = [h([*(x for _, run in tree.way(i) for x in run), beyond]) for i in range(len(leaf))]
            changed = nodes.column("changed").to_pylist()
            folded = [climb(tree.version(i, leaf[i] if c is None else c)[-1], upper) for i, c in enumerate(changed)]
            n = len(leaf)
            return filled(PROOFS, [nodes.column("id"), leaf, [subroot] * n, [root] * n, proofs, folded])

        if len(self.stages) == 1:  # no group has two leaves: a leaf is its own block
            return self._blocks(leaves).cogroup(ways.groupBy("g", "idx")).applyInArrow(prove, PROOFS)
        ways = self.down(ways, 1)
        return self._blocks(leaves).cogroup(ways.groupBy("g", "idx")).applyInArrow(prove, PROOFS)


def prove_leaves(rows: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """PROOFS of rows (id, grp, digest, changed): the manifest of all of them, and a version for each changed leaf."""
    grouped = rows.select(F.col("id").cast("long").alias("id"), F.coalesce(F.concat(F.lit("+"), "grp"), F.lit("")).alias("g"), "digest", "changed")
    leaves = cut(numbered(grouped, [F.col("id"), F.col("digest")]))
    tree = Manifest(leaves, arity, levels)
    tops = tree.tops.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest")
    tops = cut(numbered(tops, [F.col("name")]))
    crown = Manifest(tops, arity, levels)
    top = crown.tops.select("g", "idx", F.lit(b"").alias("way"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    ways = crown.down(top).select("idx", "way", "root")
    subroots = tops.join(ways, "idx").select(F.col("name").alias("g"), F.lit(0).cast("long").alias("idx"), "way", F.col("digest").alias("subroot"), "root")
    return tree.versions(leaves, subroots)


def op13_merkle_versions(docs: DataFrame) -> DataFrame:
    """Every document's proof against the manifest; tampering lower-cases the text of every third id by its checksum."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    fields = {c: F.col(c) for c in FIELDS}
    leaves = docs.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("grp"), leaf_of(list(fields.values())).alias("digest"),
        F.when(tampered, leaf_of(list((fields | {"text": lower}).values()))).alias("changed"))
    proofs = prove_leaves(leaves)
    return proofs.select(F.col("id").alias("doc_id"), *proofs.columns[1:], (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({x})::VARCHAR || ':' || {x}, '-')" for x in fields) + ")"


#: DuckDB has no crc32: `checked` works it out bit by bit. Siblings are gathered level by level, then in the tree of subroots.
OP13_SQL = f"""
WITH RECURSIVE checked AS (
  SELECT *, list_reduce([ascii(x) FOR x IN string_split(doc_id::VARCHAR, '')],
    lambda a, b: list_reduce(range(8), lambda y, k: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END, xor(a, b)),
    4294967295) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, coalesce('+' || lang, '') AS g, {_leaf_sql("text")} AS leaf,
    CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN {_leaf_sql(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} END AS changed
  FROM checked),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
inner_nodes(lvl, g, i, n, d) AS (
  SELECT 0, g, i, n, leaf FROM ranked
  UNION ALL
  SELECT any_value(lvl) + 1, g, i // 8, any_value((n + 7) // 8), sha256(string_agg(d, '' ORDER BY i)) FROM inner_nodes WHERE n > 1 GROUP BY g, i // 8),
subroots AS (SELECT g, lvl AS height, d AS subroot FROM inner_nodes WHERE n = 1),
tops AS (SELECT *, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM subroots),
top_nodes(lvl, i, n, d) AS (
  SELECT 0, i, n, subroot FROM tops
  UNION ALL
  SELECT any_value(lvl) + 1, i // 8, any_value((n + 7) // 8), sha256(string_agg(d, '' ORDER BY i)) FROM top_nodes WHERE n > 1 GROUP BY i // 8),
nodes AS (
  SELECT g, lvl, i, d FROM inner_nodes WHERE n > 1
  UNION ALL
  SELECT '*', lvl, i, d FROM top_nodes WHERE n > 1),
climb(g, leaf_i, step, height, lvl, tree, i, d, siblings) AS (
  SELECT r.g, r.i, 0, s.height, 0, r.g, r.i, coalesce(r.changed, r.leaf), '' FROM ranked r JOIN subroots s USING (g)
  UNION ALL
  SELECT c.g, c.leaf_i, c.step + 1, any_value(c.height), any_value(c.lvl) + 1, c.tree, any_value(c.i // 8),
    sha256(string_agg(CASE WHEN o.i = c.i THEN c.d ELSE o.d END, '' ORDER BY o.i)),
    any_value(c.siblings) || coalesce(string_agg(o.d, '' ORDER BY o.i) FILTER (WHERE o.i <> c.i), '')
  FROM climb c JOIN nodes o ON o.g = c.tree AND o.lvl = c.lvl AND o.i // 8 = c.i // 8
  GROUP BY c.g, c.leaf_i, c.step, c.tree),
crown(g, leaf_i, step, lvl, i, d, siblings) AS (
  SELECT c.g, c.leaf_i, 0, 0, t.i, c.d, c.siblings FROM climb c JOIN tops t USING (g) WHERE c.step = c.height
  UNION ALL
  SELECT c.g, c.leaf_i, c.step + 1, any_value(c.lvl) + 1, any_value(c.i // 8),
    sha256(string_agg(CASE WHEN o.i = c.i THEN c.d ELSE o.d END, '' ORDER BY o.i)),
    any_value(c.siblings) || coalesce(string_agg(o.d, '' ORDER BY o.i) FILTER (WHERE o.i <> c.i), '')
  FROM crown c JOIN nodes o ON o.g = '*' AND o.lvl = c.lvl AND o.i // 8 = c.i // 8
  GROUP BY c.g, c.leaf_i, c.step),
root AS (SELECT d AS root, lvl AS height FROM top_nodes WHERE n = 1)
SELECT r.doc_id, r.leaf, s.subroot, root.root, sha256(c.siblings) AS proof_sha256, c.d AS folded_root, c.d = root.root AS verified
FROM ranked r JOIN subroots s USING (g) CROSS JOIN root JOIN crown c ON c.g = r.g AND c.leaf_i = r.i AND c.step = root.height
"""
