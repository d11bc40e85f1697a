"""op9 at size: vectors are packed once, and a pair of blocks is joined in bounded memory."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import helpers as H
from promolens.llm import vectors
from promolens.llm.common import local_path


def _unit(x):
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _blocks(space, x, ids, n, *cuts):
    """Blocks of the rows between the cuts, sorted by cell."""
    cells, out = space.cells(x), []
    for lo, hi in zip(cuts, cuts[1:]):
        at = lo + np.argsort(cells[lo:hi], kind="stable")
        out.append(vectors.Block(space, x.dtype.type, *(np.ascontiguousarray(c[at]).tobytes() for c in (cells, ids, n, x))))
    return out


def _clusters(rng, count, size, kind=np.float32):
    centres = rng.standard_normal((count // 8, size)) + 0.4
    spread = rng.choice([0.02, 0.1, 0.3, 0.5], count)[:, None]
    return (centres[rng.integers(0, len(centres), count)] + rng.standard_normal((count, size)) * spread).astype(kind)


@pytest.mark.parametrize("size,kind,cell,tile,held", [(12, np.float32, 30, (16, 32), 50), (64, np.float64, 100, (256, 4096), 1 << 18),
                                                      (3, np.float32, 700, (7, 5), 10**6), (1, np.float32, 60, (256, 64), 1 << 18)])
def test_blocks_find_the_links_of_all_pairs(monkeypatch, size, kind, cell, tile, held):
    rng = np.random.default_rng(size)
    x = _clusters(rng, 600, size, kind)
    x[5:9] = x[1:5] * 2  # one direction, not one vector: pivots may be equal
    ids, n = rng.permutation(10**6)[:600], rng.integers(1, 9, 600)
    ids[10] = ids[11]
    for name, value in (("CELL", cell), ("TILE", tile), ("HELD", held)):
        monkeypatch.setattr(vectors, name, value)
    space = vectors.Space(x[rng.permutation(600)[:vectors.SAMPLE]], 600, 0.95)
    assert len(space.pivots) == -(-600 // cell)
    parts = _blocks(space, x, ids, n, 0, 250, 251, 600)
    edges = [vectors.Pair(space, parts[a], parts[b]).join() for a in range(3) for b in range(a + 1)]
    assert all(len(a) < 600 for a, _ in edges)
    got = dict.fromkeys(ids.tolist(), 0)
    for i, k in ((int(i), int(k)) for p in parts for i, k in zip(p.ids, p.links)):
        got[i] += k
    linked = (_unit(x) @ _unit(x).T >= 0.95) & (ids[:, None] != ids)
    want = dict.fromkeys(ids.tolist(), 0)
    for i, k in zip(ids.tolist(), (linked @ n).tolist()):
        want[i] += k
    assert got == want and linked.sum() > 600
    a, b = np.nonzero(linked)
    assert (H.smallest_reachable(ids.tolist(), [(int(p), int(q)) for x, y in edges for p, q in zip(x, y)])
            == H.smallest_reachable(ids.tolist(), list(zip(ids[a].tolist(), ids[b].tolist()))))


def test_a_pair_of_blocks_where_all_is_linked_is_joined_in_parts():
    """A table of 4,000 by 4,000 counts alone has 128 MB."""
    rng = np.random.default_rng(8)
    x = (rng.standard_normal(32) + 0.01 * rng.standard_normal((8000, 32))).astype(np.float32)
    space = vectors.Space(x[:512], 8000, 0.95)
    one, two = _blocks(space, x, np.arange(8000), np.ones(8000, np.int64), 0, 4000, 8000)
    tracemalloc.start()
    a, b = vectors.Pair(space, one, two).join()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert one.links.tolist() == two.links.tolist() == [4000] * 4000
    assert len(a) == 7999 and len(set(b.tolist())) == 1 and peak < 64e6


def test_a_task_deals_each_vector_once():
    """With 1,024 pivots among random vectors, a vector once went to most cells: a batch of 10,000 was 10 million rows."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 64)).astype(np.float32)
    space = vectors.Space(x[:1024], vectors.CELL * 1024, 0.95)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, 3001 * 64, 64, dtype=np.int32)), pa.array(x.ravel()))
    whole = pa.RecordBatch.from_arrays([lists], names=["_v"])
    counted = list(vectors._count({64: space})([whole.slice(0, 1000), whole.slice(1000)]))
    assert len(counted) == 1 and sum(counted[0]["_n"].to_pylist()) == 3000
    space.place(dict(zip(counted[0]["_cell"].to_pylist(), counted[0]["_n"].to_pylist())), 4)
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array([1] * 3000), pa.array(rng.integers(0, 2**40, 3000)), lists],
                                       names=["_id", "_n", "_spread", "_v"])
    tracemalloc.start()
    out = list(vectors._deal({64: space})([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in out) == 3000 and peak < 32e6
    packed = vectors._pack(pa.Table.from_batches(out))
    assert packed.num_rows == 1 and np.frombuffer(packed["_cells"][0].as_py(), np.int32).tolist() == sorted(out[0]["_cell"].to_pylist())
    back = np.frombuffer(packed["_vs"][0].as_py(), np.float32).reshape(-1, 64)
    assert (back == x[np.frombuffer(packed["_ids"][0].as_py(), np.int64)]).all()


def test_nothing_is_stored_more_often_than_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 24)).astype(np.float32)
    x[200:220] = x[:20] + np.float32(0.01)
    y = rng.standard_normal((60, 7)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate([*x, *y])]
    sizes, plain = {}, vectors.stored

    def stored(df, prefix, **options):
        out = plain(df, prefix, **options)
        sizes[prefix] = out.count()
        if prefix == "blocks":
            sizes["vectors"] = out.agg(F.sum(F.octet_length("_ids") / 8)).first()[0]
            files = [pq.ParquetFile(local_path(f)) for f in out.inputFiles()]
            assert all(f.metadata.row_group(k).num_rows == 1 for f in files for k in range(f.metadata.num_row_groups))
        return out

    monkeypatch.setattr(vectors, "stored", stored)
    monkeypatch.setattr(vectors, "CELL", 8)
    monkeypatch.setattr(vectors, "BLOCK", 64)
    monkeypatch.setitem(vectors.FORMAT, "parquet.block.size", "1")  # a row group ends with the block that fills it, not after a hundred
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert all(n <= 460 for n in sizes.values()) and sizes["vectors"] == 460
    linked = [np.argwhere(np.triu(_unit(v) @ _unit(v).T >= 0.95, 1)) + shift for v, shift in ((x, 0), (y, 400))]
    pairs = [(int(a), int(b)) for k in linked for a, b in k]
    near = H.smallest_reachable(list(range(460)), pairs)
    assert len(pairs) >= 20 and got == {i: (sum(i in p for p in pairs), near[i], near[i] == i) for i in range(460)}
