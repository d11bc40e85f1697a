"""Merkle manifest of a table, with a proof for every row, by pointer jumping.

Each row is a leaf: the digest of its fields.  The leaves of a group form a binary
tree in key order; the groups' roots form one more tree, whose root stands for the
table.  Levels are built for blocks of 256 neighbours at a time, from arrays that no
more than 256 digests ever meet in.

Proofs come from repeated self-joins.  A node holds a pointer to an ancestor and the
segment of siblings on the way there.  Each round joins it with the node it points to:
distances double and segments are concatenated, until every leaf points to the root,
after as many rounds as the depth has binary digits.  Only nodes on levels that a leaf
can still jump to are carried on, so a round handles little more than the leaves.

Places of leaves come from a range partitioning and the row counts of its partitions, so
no task sees a whole group, however many rows a group or a key has.

Defined results: null fields are ``-`` and are unlike empty text (``0:``); null keys come
first in their group, null groups first among the groups, ties of the key in order of
their leaves; rows that repeat are leaves of their own; an empty table gives no rows;
other columns than those named are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import bounded_broadcast, scratch
from promolens.sources.mart import remove_staged

#: Levels that are built from one grouping; 2 to this power digests meet in an array.
SPAN = 8
#: Bytes of a proof's step: the side (``right``, ``left``, ``alone``) and the sibling.
STEP = 33
RIGHT, LEFT, ALONE = b"\0", b"\1", b"\2" + bytes(32)
#: Most rows of a node table that are broadcast (of 33 bytes a step); beyond that it is joined.
BROADCAST_ROWS = 20_000
#: The tree over the groups; the groups' own trees have numbers from 0 on.
TOP = -1


def leaf(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values, each ``-`` or its length in bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def proof_digest(proof: Column) -> Column:
    """Digest of a proof's siblings in order."""
    return F.sha2(F.array_join(F.transform(F.filter(proof, lambda s: s != "-"), lambda s: F.substring(s, 2, 64)), ""), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    def step(digest, s):
        sibling = F.substring(s, 2, 64)
        return F.sha2(F.when(s == "-", digest).when(s.startswith("l"), F.concat(sibling, digest)).otherwise(
            F.concat(digest, sibling)), 256)
    return F.aggregate(proof, start, step)


class _Tables:
    """Tables written in the checkpoint folder; those that nothing reads any more are deleted."""

    def __init__(self, spark):
        self.spark, self.paths = spark, {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch(self.spark, f"merkle-{name}")
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_staged(self.spark, self.paths.pop(name))


def _numbered(tables: _Tables, name: str, df: DataFrame, group: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``t`` (number of its group, ascending with the group), ``n`` (rows of the group)
    and ``i`` (place in the group); and the groups.  ``df`` must be a stored table, so that ties fall
    the same way whenever a task runs again."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col("_tie")]
    dealt = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    dealt = tables.put(name, dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    spans = dealt.groupBy(group, "_part").agg(F.min("_at").alias("first"), F.count("*").alias("rows"))
    each = Window.partitionBy(group)
    before = F.coalesce(F.sum("rows").over(each.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = tables.put(f"{name}-spans", spans.select(
        group, "_part", F.min("first").over(each).alias("t"), F.sum("rows").over(each).alias("n"),
        (F.col("first") - before).alias("_shift")))
    numbered = dealt.join(bounded_broadcast(spans, BROADCAST_ROWS), [group, "_part"])
    numbered = numbered.withColumn("i", F.col("_at") - F.col("_shift")).drop("_at", "_part", "_shift")
    return numbered, spans.select(group, "t", "n").distinct()


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def depth(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return max(n - 1, 0).bit_length()


def _blocks(nodes: DataFrame) -> DataFrame:
    """``(t, n, i, h)`` of one level -> per block of neighbours the levels above it: ``(t, n, b, l0 .. l8)``.
    A level above the tree's root is empty."""
    block = F.shiftright("i", SPAN)
    out = nodes.groupBy("t", "n", block.alias("b")).agg(F.sort_array(F.collect_list(F.struct("i", "h"))).alias("_c"))
    out = out.select("t", "n", "b", F.col("_c.h").alias("l0"))

    def parents(below):
        pairs = F.sequence(F.lit(0), F.shiftright(F.size(below) - 1, 1))
        return F.transform(pairs, lambda j: F.unhex(F.sha2(F.concat(
            _text(F.get(below, 2 * j)), F.coalesce(_text(F.get(below, 2 * j + 1)), F.lit(""))), 256)))

    for k in range(SPAN):
        parent = parents(F.col(f"l{k}"))
        out = out.withColumn(f"l{k + 1}", F.when(F.col("n") > 1 << k, parent).otherwise(F.array().cast("array<binary>")))
    return out


def _children(blocks: DataFrame, low: int) -> DataFrame:
    """Every node of the blocks' levels that has a parent, one step from it: node, pointer, segment."""
    def level(k):
        here = F.col(f"l{k}")

        def node(h, p):
            step = F.when(p % 2 == 1, F.concat(F.lit(LEFT), F.get(here, p - 1))).when(
                p + 1 < F.size(here), F.concat(F.lit(RIGHT), F.get(here, p + 1))).otherwise(F.lit(ALONE))
            return F.struct(F.lit(low + k).alias("level"), (F.shiftleft("b", SPAN - k) + p).alias("i"), step.alias("seg"))
        none = F.array().cast("array<struct<level:int,i:bigint,seg:binary>>")
        return F.when(F.size(f"l{k + 1}") > 0, F.transform(here, node)).otherwise(none)

    each = blocks.select("t", F.explode(F.flatten(F.array(*[level(k) for k in range(SPAN)]))).alias("_c")).select("t", "_c.*")
    return each.select("t", "level", "i", F.col("t").alias("up_t"), (F.col("level") + 1).alias("up_level"),
                       F.shiftright("i", 1).alias("up_i"), "seg")


def _trees(tables: _Tables, name: str, leaves: DataFrame, most: int) -> tuple[DataFrame | None, DataFrame]:
    """Nodes below the root of each tree of ``(t, n, i, h)``, and the roots ``(t, h)``."""
    nodes, roots, level = [], [], leaves
    for low in range(0, max(depth(most), 1), SPAN):
        blocks = tables.put(f"{name}-{low}", _blocks(level))
        nodes.append(_children(blocks, low))
        top = F.coalesce(*[F.when(F.size(f"l{k}") == 1, F.get(f"l{k}", 0)) for k in range(SPAN + 1)])
        is_top = F.col("n") <= (1 << SPAN)
        roots.append(blocks.where(is_top).select("t", top.alias("h")))
        level = blocks.where(~is_top).select("t", F.shiftright(F.col("n") + (1 << SPAN) - 1, SPAN).alias("n"),
                                             F.col("b").alias("i"), F.get(f"l{SPAN}", 0).alias("h"))
    return reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, roots)


def _jump(tables: _Tables, nodes: DataFrame, most: int) -> DataFrame:
    """Segments of all leaves up to the root, for trees of at most ``most`` levels in all."""
    at, known = 0, tables.put("jump-0", nodes)
    while (1 << at) < most:
        on_level = F.shiftright("level", at)
        onward = known.where((on_level % 2 == 0) | (F.col("t") == TOP))
        target = known.where((on_level % 2 == 1) | (F.col("t") == TOP)).select(
            *[F.col(c).alias(f"up_{c}") for c in ("t", "level", "i")],
            *[F.col(f"up_{c}").alias(f"far_{c}") for c in ("t", "level", "i")], F.col("seg").alias("rest"))
        joined = onward.join(bounded_broadcast(target, BROADCAST_ROWS), ["up_t", "up_level", "up_i"], "left")
        further = joined.select("t", "level", "i", *[F.coalesce(f"far_{c}", f"up_{c}").alias(f"up_{c}") for c in ("t", "level", "i")],
                                F.concat("seg", F.coalesce("rest", F.lit(b""))).alias("seg"))
        at += 1
        known = tables.put(f"jump-{at}", further)
        tables.drop(f"jump-{at - 1}")
    return known.where((F.col("level") == 0) & (F.col("t") != TOP)).select("t", "i", "seg")


def manifest(df: DataFrame, fields: list[Column], *, key="doc_id", group="lang", carry: list[str] = ()) -> DataFrame:
    """``(key, leaf, subroot, root, proof, *carry)`` for each row: digests as lower-case hex; ``proof`` holds the
    steps from the leaf to the root, each ``l`` or ``r`` and the sibling on that side, or ``-`` for none."""
    if {key, "leaf", "subroot", "root", "proof"} & set(carry):
        raise ValueError("a carried column has the name of a result")
    spark = df.sparkSession
    tables = _Tables(spark)
    named = df.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("_group"), F.col(key).alias("_key"),
                      F.unhex(leaf(*fields)).alias("h"), F.struct(F.lit(0).alias("_"), *carry).alias("_carry"))
    rows, groups = _numbered(tables, "leaves", tables.put("rows", named), "_group", [F.col("_key").asc_nulls_first(), F.col("h")])
    most = groups.agg(F.max("n")).first()[0]
    if most is None:
        return df.sparkSession.createDataFrame([], df.select(F.col(key), *[F.lit("").alias(c) for c in ("leaf", "subroot", "root")],
                                               F.array(F.lit("")).alias("proof"), *carry).schema)
    places = rows.select("t", "n", "i", "h")
    below, subroots = _trees(tables, "tree", places, most)
    subroots = tables.put("subroots", subroots.join(groups.select("t", "n"), "t").withColumn("_all", F.lit(TOP).cast("long")))
    # the trees' roots are the leaves of the tree on top
    named_roots, _ = _numbered(tables, "tops", subroots.withColumnsRenamed({"t": "tree", "n": "leaves"}), "_all", [F.col("tree")])
    named_roots = tables.put("named", named_roots.drop("t").withColumn("t", F.lit(TOP).cast("long")))
    count = named_roots.count()
    above, root = _trees(tables, "top", named_roots.select("t", "n", "i", "h"), count)
    root = root.select(_text(F.col("h"))).first()[0]
    # a tree's root is known by the place in its own tree: its level is that of a tree of so many leaves
    own_level = F.length(F.regexp_replace(F.bin(F.col("leaves") - 1), "^0+$", "")).cast("int")
    bottom = above.where("level = 0").join(named_roots.select("i", "tree", own_level.alias("own_level")), "i").select(
        F.col("tree").alias("t"), F.col("own_level").alias("level"), F.lit(0).cast("long").alias("i"), "up_t", "up_level", "up_i", "seg")
    nodes = below.unionByName(bottom).unionByName(above.where("level > 0"))
    paths = _jump(tables, nodes, depth(most) + depth(count))
    tables.drop(*[name for name in tables.paths if name.startswith(("rows", "tree-", "top", "named"))])
    steps = F.floor(F.octet_length("seg") / STEP).cast("int")
    side = lambda s: F.substring(F.hex(s), 2, 1)
    cut = lambda j: F.substring("seg", j * STEP + 1, STEP)
    proof = F.when(F.coalesce(steps, F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(0), steps - 1), lambda j: F.when(side(cut(j)) == "2", F.lit("-")).otherwise(F.concat(
            F.when(side(cut(j)) == "1", F.lit("l")).otherwise(F.lit("r")), F.substring(F.lower(F.hex(cut(j))), 3, 64)))))
    tops = subroots.select("t", _text(F.col("h")).alias("subroot"))
    out = rows.join(paths, ["t", "i"], "left").join(bounded_broadcast(tops, BROADCAST_ROWS), "t")
    return out.select(F.col("_key").alias(key), _text(F.col("h")).alias("leaf"), "subroot", F.lit(root).alias("root"), proof.alias("proof"),
                      *[F.col("_carry")[c].alias(c) for c in carry])
