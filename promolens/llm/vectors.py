"""Near-duplicate vectors by an exact range join in a metric space.

On the unit sphere, cosine >= t means a chord of at most r = sqrt(2 - 2t).  Vectors are
dealt to the cell of their nearest pivot and packed, cell after cell, into blocks of a
bounded size, of which each vector is in one.  A task reads two parts of the blocks and
joins every block of the one with those of the other, so vectors are never copied to other cells.

Within a pair of blocks, cells p and q are joined by what any x and y within r of each
other must fulfil.  Along the direction e from pivot q to pivot p, e.x - e.y <= r: both
sides are sorted by it, and a vector meets a prefix of the other side.  With P a projection
on a few axes and Q the rest, x.y <= Px.Py + |Qx| |Qy|: a product of short rows, in single
precision with a margin, leaves few pairs.  Of these every cosine is computed in double
precision.  Pivots and axes come from a sample of the vectors, and results do not depend
on them.  A pair of blocks returns per vector a count and, instead of all links, a
spanning set of them.

Equal vectors are one class before the join, so copies cost nothing.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null id, link with nothing; vectors of different
lengths do not link.  Every input row gives a row; repeated ids share a component.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import drop, give_back, keep_freed, pieces, stored
from promolens.llm.components import components

#: Vectors for each cell, most pivots (a bound for what is broadcast), most vectors and bytes of a block, and
#: rows and columns of a tile: so many of a block are compared with so many of the other one at a time.
CELL, PIVOTS, BLOCK, BYTES, TILE = 4096, 2048, 65536, 4 << 20, (256, 4096)
#: Blocks that a table is cut into at least, unless they had fewer vectors than LEAST; bytes of the
#: parts of which a task joins two (if the session reads no larger ones).
CUT, LEAST, PART = 16, 4096, 16 << 20
#: Vectors that axes are taken from at least, and links of a pair of blocks that are held before they are worked on.
SAMPLE, HELD = 512, 1 << 18
#: Allowance for rounding in single precision, on the safe side.
MARGIN = 1e-4
#: A row group ends with the block that fills it, else a writer and its readers hold a hundred blocks.
FORMAT = {"parquet.block.size": str(BYTES), "parquet.page.size.row.check.min": "1", "parquet.page.row.count.limit": "1",
          "parquet.enable.dictionary": "false"}


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    with np.errstate(all="ignore"):
        return x / np.sqrt((x * x).sum(1))[:, None]


def _single(values: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision, zero where there is none."""
    out = np.empty(values.shape, np.float32)
    step = max(1, (1 << 17) // values.shape[1])
    for lo in range(0, len(values), step):
        out[lo:lo + step] = np.nan_to_num(_unit(values[lo:lo + step]), nan=0, posinf=0, neginf=0)
    return out


def classes(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a class key (null: links with nothing), and the classes."""
    v = F.col(vector)
    usable = (F.col(key).isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(v, lambda x: x != 0))
    rows = df.select(F.col(key).alias("_id"), v.alias("_v"), F.coalesce(usable, F.lit(False)).alias("_ok"))
    digest = F.concat_ws(":", F.size("_v"), F.xxhash64("_v", F.lit(1)), F.xxhash64(F.lit(2), "_v"))
    rows = rows.select("_id", "_v", F.when(F.col("_ok"), digest).alias("_class"))
    groups = (rows.where("_class is not null").groupBy("_class")
              .agg(F.min("_id").alias("_id"), F.count("*").alias("_n"), F.first("_v").alias("_v")))
    return rows, groups


class Space:
    """What the tasks know of the vectors of one length."""

    def __init__(self, sample: np.ndarray, count: int, threshold: float):
        self.threshold, self.reach = threshold, float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        u = _single(sample)
        self.mean = u.mean(0)
        axes = np.linalg.svd((u - self.mean).astype(np.float64), full_matrices=False)[2].astype(np.float32)
        pivots = u[:min(PIVOTS, pieces(count, CELL))]
        self.pivots = pivots[np.argsort(pivots @ axes[0], kind="stable")]  # cells that share a block are beside each other
        self.axes = self._few(u[:256], axes)
        self.starts = self.counts = np.zeros(len(pivots), np.int64)
        self.each = 1

    def _few(self, u: np.ndarray, axes: np.ndarray) -> np.ndarray:
        """So many axes that a pair costs least: an axis 1, the rest of a short product 45, a cosine 20,000."""
        cost = {}
        for k in sorted({min(k, len(axes)) for k in (4, 8, 16, 24, 32, 48, 64, 96, 128, 192, 256)}):
            self.axes = axes[:k].T.copy()
            left, right = self.outline(u)
            cost[k] = k + 45 + 20_000 * (left @ right.T >= self.limit).mean()
        return axes[:min(cost, key=cost.get)].T.copy()

    @property
    def limit(self) -> float:
        return self.threshold - 1 - MARGIN

    def outline(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Short rows, whose product (left, right) is at least minus half the squared distance."""
        off = u - self.mean
        short = off @ self.axes
        whole = np.einsum("ij,ij->i", off, off)
        rest = np.sqrt(np.maximum(whole - np.einsum("ij,ij->i", short, short), 0) + np.float32(1e-5))
        one = np.ones_like(whole)
        return np.column_stack([short, rest, -whole / 2, one]), np.column_stack([short, rest, one, -whole / 2])

    def cells(self, values: np.ndarray) -> np.ndarray:
        """The nearest pivots."""
        u, out = _single(values), np.empty(len(values), np.int32)
        step = max(1, (1 << 19) // len(self.pivots))
        for lo in range(0, len(u), step):
            out[lo:lo + step] = (u[lo:lo + step] @ self.pivots.T).argmax(1)
        return out

    def place(self, counts: dict[int, int], width: int) -> None:
        """Lay the cells one after the other and cut them into blocks. width: bytes of a component."""
        self.counts = np.array([counts.get(c, 0) for c in range(len(self.pivots))], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        row = width * self.pivots.shape[1]
        self.each = max(1, min(BLOCK, BYTES // row, max(LEAST, pieces(self.counts.sum(), CUT))))

    def blocks(self, cells: np.ndarray, spread: np.ndarray) -> np.ndarray:
        return ((self.starts[cells] + spread % np.maximum(self.counts[cells], 1)) // self.each).astype(np.int32)


def _by_length(lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and a matrix for each length of the vectors of a batch."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        some = lists if len(rows) == len(lists) else lists.take(pa.array(rows))
        yield int(size), rows, some.flatten().to_numpy(zero_copy_only=False).reshape(-1, int(size))


def _count(spaces: dict[int, Space]) -> Callable:
    """Function batches of vectors -> ``_size, _cell, _n`` of the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            for size, _, values in _by_length(batch.column(0)):
                n = np.bincount(spaces[size].cells(values), minlength=len(spaces[size].pivots))
                found[size] = found.get(size, 0) + n
        for size, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), size), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                                             names=["_size", "_cell", "_n"])
        give_back()
    return run


def _deal(spaces: dict[int, Space]) -> Callable:
    """Function batches ``_id, _n, _spread, _v`` -> each vector once, with its block and cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, values in _by_length(batch.column(3)):
                at = pa.array(rows)
                cells = spaces[size].cells(values)
                blocks = spaces[size].blocks(cells, batch.column(2).to_numpy(zero_copy_only=False)[rows])
                ends = np.arange(0, (len(rows) + 1) * values[:1].nbytes, values[:1].nbytes, dtype=np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), size), pa.int32()), pa.array(blocks), pa.array(cells), batch.column(0).take(at),
                     batch.column(1).take(at), packed], names=["_size", "_no", "_cell", "_id", "_n", "_v"])
        give_back()
    return run


def _pack(rows: pa.Table) -> pa.Table:
    """The rows of a block, sorted by cell, as one row."""
    cells, ids, n = (rows[c].to_numpy() for c in ("_cell", "_id", "_n"))
    order = np.argsort(cells, kind="stable")
    values = np.frombuffer(b"".join(rows["_v"].to_pylist()), np.uint8).reshape(len(cells), -1)[order]
    column = lambda x: pa.array([x.tobytes()], pa.binary())
    return pa.table({"_size": rows["_size"][:1], "_no": rows["_no"][:1], "_cells": column(cells[order]), "_ids": column(ids[order]),
                     "_ns": column(n[order]), "_vs": column(values)})


class Block:
    """A packed block, with what is computed of it once for all of its cells."""

    def __init__(self, space: Space, kind: type, cells, ids, ns, vs):
        self.cells, self.ids, self.n = np.frombuffer(cells, np.int32), np.frombuffer(ids, np.int64), np.frombuffer(ns, np.int64)
        self.values = np.frombuffer(vs, kind).reshape(len(self.ids), -1)
        self.u = _single(self.values)
        self.left, self.right = space.outline(self.u)
        names, starts = np.unique(self.cells, return_index=True)
        self.parts = [(int(c), slice(int(lo), int(hi))) for c, lo, hi in zip(names, starts, [*starts[1:], len(self.ids)])]
        self.links = np.zeros(len(self.ids), np.int64)


class Pair:
    """Links of two blocks, or of one with itself."""

    def __init__(self, space: Space, one: Block, two: Block):
        self.space, self.one, self.two, self.same = space, one, two, one is two
        self.shift = 0 if self.same else len(one.ids)
        self.ids = one.ids if self.same else np.concatenate([one.ids, two.ids])
        self.edges, self.held, self.open, self.waiting = [], 0, [], 0

    def join(self) -> tuple[np.ndarray, np.ndarray]:
        """Links that connect the same vectors as all do, as two arrays of ids; counts are added to the blocks."""
        for p, x in self.one.parts:
            for q, y in self.two.parts:
                if not self.same or p <= q:
                    self._cells(p, x, q, y)
        self._decide()
        self._reduce()
        a, b = self.edges[0]
        return self.ids[a], self.ids[b]

    def _cells(self, p: int, x: slice, q: int, y: slice) -> None:
        xs, ys = np.arange(x.start, x.stop), np.arange(y.start, y.stop)
        fits = np.full(len(xs), len(ys))
        e = self.space.pivots[p] - self.space.pivots[q]
        apart = np.sqrt(e @ e)
        if apart > 1e-3:
            f, g = self.one.u[x] @ (e / apart), self.two.u[y] @ (e / apart)
            reach = self.space.reach + MARGIN
            f_most, g_least = g.max() + reach, f.min() - reach
            if f.min() > f_most:
                return
            f_in, g_in = np.flatnonzero(f <= f_most), np.flatnonzero(g >= g_least)
            f_in, g_in = f_in[np.argsort(f[f_in])], g_in[np.argsort(-g[g_in])]
            fits = np.searchsorted(-g[g_in], reach - f[f_in], "right")
            xs, ys = xs[f_in], ys[g_in]
        right, mine = self.two.right[ys], self.same and p == q
        for lo in range(0, len(xs), TILE[0]):
            for at in range(lo if mine else 0, int(fits[lo]), TILE[1]):
                self._tile(xs[lo:lo + TILE[0]], ys[at:min(at + TILE[1], int(fits[lo]))], right[at:min(at + TILE[1], int(fits[lo]))], mine)

    def _tile(self, i: np.ndarray, j: np.ndarray, right: np.ndarray, mine: bool) -> None:
        """mine: both sides are one cell, of which each pair is taken once."""
        one, two = self.one, self.two
        may = self.one.left[i] @ right.T >= self.space.limit
        hits = np.count_nonzero(may)
        if not hits:
            return
        if hits * 64 > may.size:
            linked = (_unit(one.values[i]) @ _unit(two.values[j]).T >= self.space.threshold) & (one.ids[i][:, None] != two.ids[j])
            if mine:
                linked &= i[:, None] < j
            one.links[i] += linked @ two.n[j]
            two.links[j] += one.n[i] @ linked
            edges = _spanning(linked)
            self._add(i[edges[:, 0]], j[edges[:, 1]])
            return
        at = _set(may)
        a, b = i[at // len(j)], j[at % len(j)]
        keep = one.ids[a] != two.ids[b]
        if mine:
            keep &= a < b
        self.open.append((a[keep], b[keep]))
        self.waiting += len(a)
        if self.waiting > HELD:
            self._decide()

    def _decide(self) -> None:
        """Cosines of the pairs that short products leave."""
        one, two = self.one, self.two
        a, b = (np.concatenate([x[k] for x in self.open] or [np.zeros(0, np.int64)]) for k in (0, 1))
        self.open, self.waiting = [], 0
        step = max(1, (1 << 17) // one.values.shape[1])
        near = [np.einsum("ij,ij->i", _unit(one.values[a[lo:lo + step]]), _unit(two.values[b[lo:lo + step]])) >= self.space.threshold
                for lo in range(0, len(a), step)]
        if near:
            a, b = a[near := np.concatenate(near)], b[near]
            np.add.at(one.links, a, two.n[b])
            np.add.at(two.links, b, one.n[a])
            self._add(a, b)

    def _add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.edges.append((a, b + self.shift))
            self.held += len(a)
            if self.held > HELD:
                self._reduce()

    def _reduce(self) -> None:
        """Instead of the links, one of each vector with the first of those that it is connected with."""
        a, b = (np.concatenate([x[k] for x in self.edges] or [np.zeros(0, np.int64)]) for k in (0, 1))
        first = np.arange(len(self.ids))
        while (first[a] != first[b]).any():
            least = np.minimum(first[a], first[b])
            np.minimum.at(first, first[a], least)
            np.minimum.at(first, first[b], least)
            while ((after := first[first]) != first).any():
                first = after
        at = np.flatnonzero(first != np.arange(len(first)))
        self.edges, self.held = [(at, first[at])], 0


def _join(spaces: dict[int, Space], kind: type) -> Callable:
    """Function batches of pairs of blocks -> ``_id, _links, _with``: counts, and links without one.  A task joins a
    part of each side.  A block comes with the first pair that has it, and is kept: of the left side the last one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        left, right = {}, {}
        for batch in batches:
            for k in range(batch.num_rows):
                size, one, two, wanted = (c[k].as_py() for c in batch.columns[:4])
                for held, name, at in ((left, one, 4), (right, two, 9)):
                    if batch.columns[at].is_valid()[k].as_py():
                        if held is left:
                            yield from _counts(left)
                            left.clear()
                        length, *packed = (c[k].as_py() for c in batch.columns[at:at + 5])
                        held[length, name] = Block(spaces[length], kind, *packed)
                if wanted:
                    x = left[size, one]
                    a, b = Pair(spaces[size], x, x if one == two else right[size, two]).join()
                    yield _links(a, np.zeros(len(a), np.int64), b)
        yield from _counts(left)
        yield from _counts(right)
        left.clear()
        right.clear()
        give_back()
    return run


def _counts(blocks: dict) -> Iterator[pa.RecordBatch]:
    for x in blocks.values():
        at = np.flatnonzero(x.links)
        yield _links(x.ids[at], x.links[at], None)


def _links(ids: np.ndarray, links: np.ndarray, others: np.ndarray | None) -> pa.RecordBatch:
    others = pa.nulls(len(ids), pa.int64()) if others is None else pa.array(others)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), others], names=["_id", "_links", "_with"])


def range_join(groups: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Classes ``(_id, _n, _v)`` -> ``(_id, n_links)`` of linked rows outside the
    class, and ``(a, b)``, links that connect the same classes as all links do."""
    id_type = groups.schema["_id"].dataType.simpleString()
    wide = groups.schema["_v"].dataType.simpleString() != "array<float>"
    kind = np.float64 if wide else np.float32
    groups = stored(groups.select("_id", "_n", F.col("_v").cast("array<double>" if wide else "array<float>").alias("_v")), "classes")
    spaces = {}
    for r in groups.groupBy(F.size("_v").alias("size")).agg(F.count("*").alias("n")).collect():
        picked = (groups.where(F.size("_v") == r["size"]).orderBy(F.xxhash64("_id", F.lit(9)), "_id")
                  .limit(max(SAMPLE, min(PIVOTS, pieces(r["n"], CELL)))).select("_v").collect())
        spaces[r["size"]] = Space(np.array([x["_v"] for x in picked], kind), r["n"], threshold)
    if not spaces:
        return groups.select("_id", F.lit(0).cast("long").alias("n_links")), groups.select(
            F.col("_id").alias("a"), F.col("_id").alias("b")).limit(0)
    counts = {size: {} for size in spaces}
    for r in (groups.select("_v").mapInArrow(_count(spaces), "_size int, _cell int, _n long")
              .groupBy("_size", "_cell").agg(F.sum("_n").alias("_n")).collect()):
        counts[r["_size"]][r["_cell"]] = r["_n"]
    for size, space in spaces.items():
        space.place(counts[size], np.dtype(kind).itemsize)
    spread = F.pmod(F.xxhash64("_v", F.lit(3)), F.lit(2**40))
    dealt = (groups.select(F.col("_id").cast("long").alias("_id"), "_n", spread.alias("_spread"), "_v")
             .mapInArrow(_deal(spaces), "_size int, _no int, _cell int, _id long, _n long, _v binary"))
    blocks = stored(dealt.groupBy("_size", "_no").applyInArrow(
        _pack, "_size int, _no int, _cells binary, _ids binary, _ns binary, _vs binary"), "blocks", **FORMAT)
    drop(groups)
    # each pair once, dealt to both sides in turn; a task goes through its part of the right side for each block of the left
    whole = sum(int(s.counts.sum()) * s.pivots.shape[1] for s in spaces.values()) * np.dtype(kind).itemsize
    first = (F.monotonically_increasing_id() % 2**33 == 0).alias("first")
    one, two = (blocks.coalesce(max(CUT, pieces(whole, PART))).select("*", first) for _ in range(2))
    one, two = (df.select([F.col(c).alias(side + c) for c in df.columns]) for side, df in (("a", one), ("b", two)))
    a, b = F.col("a_no"), F.col("b_no")
    wanted = (F.col("a_size") == F.col("b_size")) & ((a == b) | ((a < b) == ((a + b) % 2 == 0)))
    new = [F.when(F.col(other + "first"), F.col(side + c)).alias(side + c) for side, other in (("a", "b"), ("b", "a"))
           for c in ("_size", "_cells", "_ids", "_ns", "_vs")]
    pairs = (one.hint("shuffle_replicate_nl").join(two, wanted | F.col("afirst") | F.col("bfirst"))
             .select(F.col("a_size").alias("_size"), "a_no", "b_no", wanted.alias("_wanted"), *new))
    found = stored(pairs.mapInArrow(_join(spaces, kind), "_id long, _links long, _with long"), "found")
    drop(blocks)
    found = found.select(F.col("_id").cast(id_type).alias("_id"), "_links", F.col("_with").cast(id_type).alias("_with"))
    return (found.groupBy("_id").agg(F.sum("_links").alias("n_links")),
            found.where("_with is not null").select(F.col("_id").alias("a"), F.col("_with").alias("b")).distinct())


def _set(flags: np.ndarray) -> np.ndarray:
    """Places of the few set flags of an array, in the order of its rows: eight are looked at at once."""
    flat = flags.ravel()
    whole = len(flat) // 8 * 8
    at = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[flat[at]], whole + np.flatnonzero(flat[whole:])])


def _spanning(linked: np.ndarray) -> np.ndarray:
    """Links (row, column) of a forest that spans the components of a block."""
    rows_left = linked.any(1)
    cols_left = linked.any(0)
    out = []
    while rows_left.any():
        wave = np.array([rows_left.argmax()])
        rows_left[wave] = False
        while len(wave):
            reached = linked[wave] & cols_left
            cols = np.flatnonzero(reached.any(0))
            out.append(np.c_[wave[reached[:, cols].argmax(0)], cols])
            cols_left[cols] = False
            back = linked[:, cols] & rows_left[:, None]
            wave = np.flatnonzero(back.any(1))
            out.append(np.c_[wave, cols[back[wave].argmax(1)]] if len(wave) else np.empty((0, 2), int))
            rows_left[wave] = False
    return np.concatenate(out).astype(int) if out else np.empty((0, 2), int)


def near_duplicates(df: DataFrame, *, key="vec_id", vector="embedding", threshold: float = 0.95) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for every row."""
    rows, groups = classes(df, key, vector)
    links, edges = range_join(groups, threshold)
    found = components(edges)
    of_class = (groups.select("_class", F.col("_id").alias("_first"), F.col("_n"))
                .join(links.withColumnRenamed("_id", "_first"), "_first", "left")
                .join(found.select(F.col("id").alias("_first"), "component"), "_first", "left")
                .select("_class", (F.coalesce("n_links", F.lit(0)) + F.col("_n") - 1).alias("n_links"),
                        F.coalesce("component", "_first").alias("component_id")))
    out = rows.select("_id", "_class").join(of_class, "_class", "left").select(
        F.col("_id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
