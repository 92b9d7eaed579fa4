"""Merkle manifest of a table, with a witness for each row.

Each row is a leaf: the sha256 of its fields, each as ``-`` if null, else as its UTF-8 byte count,
``:`` and its value.  The leaves of a group, in the order of their ids, form a tree in which every two
consecutive nodes become the hash of both (digests as hex text) and a lone last node the hash of
itself, until one is left; the groups' roots, in the order of the groups, form the tree above.

Witnesses are built while leaves are appended (``Frontier``).  Each open subtree keeps the partial
witnesses of its leaves: the siblings that are known so far.  When a sibling completes, the witnesses
of both halves are extended by each other's root.  Groups are cut into aligned blocks of
``2 ** HEIGHT`` leaves, each of which is one small task; its root is a finished subtree of that
height, so the roots of all blocks are appended to the next level in just the same way, again in
blocks, until a group has one root.  A leaf's whole witness is its own in its block, that of the
block's root in the level above, and so on.  A leaf finds its block by its place in the group: the
rows are range-partitioned, numbered inside their partition, and the partitions' counts summed up.
So no task ever sees more than a block, and a group may hold any share of the rows.

Null groups are a group of their own, the first.  Null ids come first in their group, rows of equal
id are ordered by their digests (equal rows are interchangeable).  Nulls in other fields are ``-``,
empty texts ``0:``.  An empty table gives no rows.  Other columns of the input are not read, whatever
their names are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import keyed
from .common import stage, tasks
from .registry import named, table

#: A block has up to ``2 ** HEIGHT`` nodes.
HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(fields: Sequence[Column | str]) -> Column:
    """Hex digest of a row's fields."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


# ---------------------------------------------------------------- witnesses


def join(*digests: bytes) -> bytes:
    """The parent of nodes; digests are hashed as hex text."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


class Frontier:
    """The open subtrees of a growing tree, the largest first, with the witnesses of their leaves.

    A witness is the siblings from the leaf up and, for each level, on which side the sibling is:
    ``L``, ``R`` or ``-`` where the node has none.
    """

    def __init__(self):
        self.open: list[tuple[int, bytes, list[int]]] = []  # height, root, leaves
        self.siblings: list[list[bytes]] = []
        self.sides: list[list[str]] = []

    def append(self, digest: bytes) -> None:
        """One more leaf; every subtree that it completes extends the witnesses below it."""
        self.siblings.append([])
        self.sides.append([])
        self.open.append((0, digest, [len(self.sides) - 1]))
        self._merge()

    def _merge(self) -> None:
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            height, right, right_leaves = self.open.pop()
            _, left, left_leaves = self.open.pop()
            for leaves, other, side in ((left_leaves, right, "R"), (right_leaves, left, "L")):
                for i in leaves:
                    self.siblings[i].append(other)
                    self.sides[i].append(side)
            self.open.append((height + 1, join(left, right), left_leaves + right_leaves))

    def close(self, height: int | None) -> bytes:
        """The root: lone nodes rise until one is left and has the height, if one is asked for."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            h, root, leaves = self.open.pop()
            for i in leaves:
                self.sides[i].append("-")
            self.open.append((h + 1, join(root), leaves))
            self._merge()
        return self.open[0][1]


def folded(digest: bytes, siblings: bytes, sides: str) -> bytes:
    """The root that a leaf and its witness give."""
    at = 0
    for side in sides:
        if side == "-":
            digest = join(digest)
            continue
        other = siblings[at : at + 32]
        at += 32
        digest = join(other, digest) if side == "L" else join(digest, other)
    return digest


# ---------------------------------------------------------------- trees


def placed(df: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``df`` with each row's place in its tree (``pos``) and the tree's number of rows (``n``)."""
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for t in batch.column(tree).to_pylist():
                last, at = t, (at + 1 if t == last else 0)
                places.append(at)
            columns = [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    # Rows that agree in everything are interchangeable; the last key lets many of them be parted.
    salted = df.withColumn("salt", F.monotonically_increasing_id())
    keys = [tree, *order, "salt"]
    ordered = salted.repartitionByRange(tasks(df), *keys).sortWithinPartitions(*keys).select(*df.columns)
    rows = stage(ordered.mapInArrow(number, schema))
    counts = rows.groupBy(tree, "part").agg(F.count(F.lit(1)).alias("rows"))
    # A tree's window has one row for each range partition that the tree reaches into.
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(tree)
    bases = counts.select(tree, "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"), F.sum("rows").over(whole).alias("n"))
    found = keyed.attach(rows, keyed.stage(bases), [tree, "part"], ["base", "n"])
    return found.withColumn("pos", F.col("base") + F.col("at")).drop("base", "at", "part")


def witnessed(nodes: DataFrame, tree: str) -> DataFrame:
    """``nodes`` (tree, pos, n, digest and others) with siblings, sides and root of each.

    One round of blocks for each ``HEIGHT`` levels.  A node's block is one group of at most
    ``2 ** HEIGHT`` rows.
    """
    levels, wide = [], nodes
    while True:
        wide = wide.withColumn("block", F.shiftright("pos", HEIGHT))
        added = [T.StructField("siblings", T.BinaryType()), T.StructField("sides", T.StringType()), T.StructField("top", T.BinaryType())]
        schema = T.StructType([*wide.schema.fields, *added])
        level = stage(wide.groupBy(tree, "block").applyInArrow(_sealer(schema.names), schema))
        levels.append(level)
        tops = level.filter("top is not null").select(
            tree, F.col("block").alias("pos"), F.shiftright(F.col("n") + F.lit((1 << HEIGHT) - 1), HEIGHT).alias("n"), F.col("top").alias("digest")
        )
        if not (tops.agg(F.max("n")).first()[0] or 0) > 1:
            break
        wide = tops
    above = tops.select(tree, F.col("pos").alias("block"), F.lit(b"").alias("more"), F.lit("").alias("more_sides"), F.col("digest").alias("root"))
    for level in reversed(levels):
        # A block has few rows, so no key of this join is hot.
        level = level.drop("top").join(above, [tree, "block"])
        level = level.withColumns({"siblings": F.concat("siblings", "more"), "sides": F.concat("sides", "more_sides")})
        above = level.select(
            tree, F.col("pos").alias("block"), F.col("siblings").alias("more"), F.col("sides").alias("more_sides"), "root"
        )
    return level.drop("block", "more", "more_sides", "n")


def _sealer(names: Sequence[str]):
    """The function that builds one block."""

    def seal(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        frontier = Frontier()
        for digest in rows.column("digest").to_pylist():
            frontier.append(digest)
        whole = rows.column("n")[0].as_py() > 1 << HEIGHT  # otherwise this block is the whole tree
        top = frontier.close(HEIGHT if whole else None)
        siblings = pa.array([b"".join(s) for s in frontier.siblings], pa.binary())
        sides = pa.array(["".join(s) for s in frontier.sides], pa.string())
        tops = pa.array([top] + [None] * (rows.num_rows - 1), pa.binary())
        return pa.table([*rows.columns, siblings, sides, tops], names=names)

    return seal


def manifest(
    df: DataFrame,
    id_col: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    carry: Sequence[tuple[str, Column]] = (),
) -> DataFrame:
    """doc_id, leaf, siblings, sides, subroot and root of every row, digests as bytes.

    ``siblings`` are the digests from the leaf up to the root, 32 bytes each, ``sides`` says where
    each level's is (see ``Frontier``).  ``carry`` are further columns (name, expression over the
    input) to keep.
    """
    key = F.when(F.col(group).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    rows = df.select(
        key.alias("tree"), F.col(id_col).alias("doc_id"), F.unhex(leaf(fields)).alias("digest"), *[c.alias(f"carry_{k}") for k, c in carry]
    )
    rows = stage(rows)
    leaves = witnessed(placed(rows, "tree", ["doc_id", "digest"]), "tree")
    leaves = stage(leaves.drop("pos").withColumnRenamed("root", "subroot"))
    groups = leaves.groupBy("tree").agg(F.first("subroot").alias("digest"))
    groups = stage(groups.select(F.lit(0).alias("whole"), "tree", "digest"))
    upper = witnessed(placed(groups, "whole", ["tree"]), "whole")
    upper = upper.select("tree", F.col("siblings").alias("more"), F.col("sides").alias("more_sides"), "root")
    # A group may hold most rows: the join spreads hot keys.
    found = keyed.attach(leaves, keyed.stage(upper), ["tree"], ["more", "more_sides", "root"])
    return found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        F.concat("siblings", "more").alias("siblings"),
        F.concat("sides", "more_sides").alias("sides"),
        "subroot",
        "root",
        *[F.col(f"carry_{k}").alias(k) for k, _ in carry],
    )


def folded_root(df: DataFrame, start: str, out: str = "folded_root") -> DataFrame:
    """``df`` with the root that the digest in ``start`` and the row's witness give."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in (start, "siblings", "sides")], strict=True)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([folded(*r) for r in rows], pa.binary())], schema.names)

    return df.mapInArrow(fold, schema)


_CRC = """xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
    lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END)))"""


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode(CAST({x} AS VARCHAR))) || ':' || CAST({x} AS VARCHAR) END"


def _leaf_sql(**other: str) -> str:
    return "sha256(" + " || ".join(_field(other.get(f, f)) for f in FIELDS) + ")"


# Level by level: all nodes of all trees, then each leaf's way up through them.
_UP = """{up}(tree, lvl, pos, n, digest) AS (SELECT tree, 0, pos, n, digest FROM {start}
  UNION ALL SELECT tree, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {up} WHERE n > 1 GROUP BY tree, lvl, pos // 2, n)"""
_WAY = """{way}(k, tree, lvl, pos, n, proof, digest) AS (SELECT k, tree, 0, pos, n, '', start FROM {start}
  UNION ALL SELECT w.k, w.tree, w.lvl + 1, w.pos // 2, (w.n + 1) // 2, w.proof || coalesce(s.digest, ''),
  sha256(CASE WHEN s.digest IS NULL THEN w.digest WHEN w.pos % 2 = 0 THEN w.digest || s.digest ELSE s.digest || w.digest END)
  FROM {way} w LEFT JOIN {up} s ON s.tree = w.tree AND s.lvl = w.lvl AND s.pos = xor(w.pos, 1) WHERE w.n > 1)"""


def _sql() -> str:
    return f"""WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS k, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS tree,
  {_leaf_sql()} AS digest, CASE WHEN {_CRC} % 7 = 0 THEN {_leaf_sql(n_chars='(n_chars + 1)')} ELSE {_leaf_sql()} END AS start
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
{_UP.format(up='up', start='leaves')},
{_WAY.format(way='way', up='up', start='leaves')},
tops AS (SELECT tree AS lang, digest FROM up WHERE n = 1),
groups AS (SELECT 0 AS tree, lang, digest, row_number() OVER (ORDER BY lang) - 1 AS pos, count(*) OVER () AS n FROM tops),
{_UP.format(up='over', start='groups')},
arrived AS (SELECT w.k, g.tree, g.pos, g.n, w.proof, w.digest AS start FROM way w JOIN groups g ON g.lang = w.tree WHERE w.n = 1),
{_WAY.format(way='above', up='over', start='arrived')},
root AS (SELECT digest FROM over WHERE n = 1)
SELECT doc_id, l.digest AS leaf, t.digest AS subroot, r.digest AS root, sha256(a.proof || b.proof) AS proof_sha256,
  b.digest AS folded_root, b.digest = r.digest AS verified
FROM leaves l JOIN tops t ON t.lang = l.tree JOIN arrived a USING (k) JOIN above b ON b.k = l.k AND b.n = 1, root r"""


@named("op12_merkle", _sql())
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of all documents, and the roots that tampered rows lead to."""
    documents = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    other = leaf([F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS])
    start = F.unhex(F.when(tampered, other).otherwise(leaf(FIELDS)))
    found = folded_root(manifest(documents, carry=[("start", start)]), "start")
    text = lambda c: F.lower(F.hex(c))
    return found.select(
        "doc_id",
        *[text(c).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(text("siblings").cast("binary"), 256).alias("proof_sha256"),
        text("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
