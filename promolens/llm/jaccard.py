"""Documents linked by the Jaccard similarity of their word shingles, exactly.

A document's set holds its distinct runs of ``N`` words.  Sets are ordered rarest
first; if two sets have similarity >= t, they share one of the first
n - ceil(t n) + 1 members of each (prefix filter).  How often a shingle occurs is
counted over all documents in a table of a bounded number of slots, one for every
``SLOT_BYTES`` bytes of text (shingles that share a slot count together; any order
that is the same for all sets gives the same links).

1. one pass counts shingles and keeps, for each document, the size of its set, a hash of
   128 bits of it, how many members fall in each of ``RANGES`` ranges of the hash, and
   whether that number is odd for each of ``64 * SKETCH`` slots; documents with equal sets
   are one class, and only its smallest id goes on;
2. one pass sends the prefixes to buckets of shingles; a shingle in one prefix only goes
   no further, and of shingles that the same documents have only one does, with their number;
3. in ``ROUNDS`` rounds every document proposes one partner, the one it shares most prefix
   shingles with among the leaders of its lists (first the documents that share most,
   then others); these pairs are verified and give components, so that a large group of copies is joined by as many pairs as it has
   members and not by all of its pairs;
4. for every shingle whose documents are still in several components, all pairs of
   documents from different components are compared that pass the length filter, the
   positional filter (what lies before and after the shared shingle) and, as suffix
   filters, the odd slots (a member that only one of both has changes one slot, so sets
   differ in as many members as in slots at least) and the members by range of the hash.
   Each pair is verified once on full sets.

All links between documents that step 3 has not joined are found in step 4, so the
components are those of all links.

Defined results: null and empty texts, and texts of white space, have an empty set
and link with nothing; with fewer than ``N`` words the whole run is the one member;
rows with a null id get their size and a null component; an empty table gives no rows and
other columns are not read; rows that repeat an id are one document whose text is the one with the largest set (of equally large ones the one
with the largest hash): they are one row before prefixes are sent.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import bounded_broadcast, drop, give_back, pieces, stored
from promolens.llm.components import components
from promolens.llm.hashing import batch_word_hashes, mix, shingles

N = 5
#: Bytes of text for a slot of the table of counts, fewest and most slots (2^bits; a byte each is
#: broadcast), parts it is merged in, ranges of the suffix filter.
SLOT_BYTES, LEAST_BITS, MOST_BITS, PARTS, RANGES = 128, 18, 25, 16, 256
#: Longs of a document's odd slots.
SKETCH = 16
#: Rounds in which documents propose partners.
ROUNDS = 5
#: Shingles of all sets for each bucket (a quarter of them are in prefixes), and postings that a task holds before
#: it sends them.
BUCKET, HELD = 3_000_000, 300_000
#: Similarity as a fraction, so that comparisons are exact.
OVER, UNDER = 75, 100
#: Most ids that are broadcast to pick out documents; beyond that they are joined.
BROADCAST_IDS = 2_000_000
_TEXTS = 256


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time: their texts are Python objects only while they are at hand."""
    for batch in batches:
        for lo in range(0, batch.num_rows, _TEXTS):
            yield batch.slice(lo, _TEXTS)


def _sets(part: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(id, set) of each row."""
    words = batch_word_hashes([(t or "").encode() for t in part.column("_text").to_pylist()])
    for key, w in zip(part.column("_id").to_pylist(), words):
        yield key, shingles(w, n)


def _ranges(s: np.ndarray) -> bytes:
    """Members in each range of the hash; empty (no filter) where a range holds too many to note."""
    count = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=RANGES)
    return count.astype(np.uint16).tobytes() if len(s) and count.max() < 1 << 16 else b""


def _odd(s: np.ndarray) -> np.ndarray:
    """One bit for each slot: whether an odd number of members falls in it."""
    count = np.bincount(((s >> np.uint64(40)) & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH)
    return np.packbits((count & 1).astype(np.uint8)).view(np.int64)


def _whole(s: np.ndarray) -> bytes:
    """A hash of 128 bits of a set."""
    return b"".join(int(mix(s ^ np.uint64(x)).sum(dtype=np.uint64)).to_bytes(8, "big") for x in (0x9E3779B97F4A7C15, 0x5851F42D4C957F2D))


def prefix_length(size: int) -> int:
    """n - ceil(t n) + 1"""
    return size - -(-OVER * size // UNDER) + 1


def _count(n: int, bits: int):
    slots, each = 1 << bits, (1 << bits) // PARTS

    def rows(*columns) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["part", "none", "id", "row", "n", "whole", "odd", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int32)
        seen = False
        pending, held = [], 0

        def add():
            at, times = np.unique(np.concatenate(pending), return_counts=True)
            total[at] += times.astype(np.int32)

        for batch in _parts(batches):
            sizes, ranges, wholes, odd = [], [], [], []
            for _, s in _sets(batch, n):
                sizes.append(len(s))
                ranges.append(_ranges(s))
                wholes.append(_whole(s))
                odd.append(_odd(s))
                pending.append((s & np.uint64(slots - 1)).astype(np.int64))
                held += len(s)
                if held > 1 << 20:
                    add()
                    pending, held = [], 0
            seen = True
            yield rows([None] * len(sizes), batch.column("_none"), batch.column("_id"), batch.column("_row"), sizes, wholes, odd, ranges)
        if held:
            add()
        pending.clear()
        if seen:
            yield rows(range(PARTS), [True] * PARTS, [0] * PARTS, [0] * PARTS, [0] * PARTS, [None] * PARTS, [None] * PARTS,
                       [zstandard.compress(total[i * each:(i + 1) * each].tobytes(), 1) for i in range(PARTS)])
        del total
        give_back()
    return run


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums the tables of a partition part by part; holds one sum for each.  Of the sum a
    byte remains: exact to 16, then its logarithm in steps of about a seventh."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, data in zip(batch["part"], batch["data"]):
            counts = np.frombuffer(zstandard.decompress(data), np.int32).astype(np.int64)
            total[part] = total[part] + counts if part in total else counts
    for part, counts in total.items():
        rank = np.where(counts <= 16, counts, np.minimum(255, 16 + 5 * np.log2(np.maximum(counts, 16) / 16)))
        yield pd.DataFrame({"part": [part], "data": [rank.astype(np.uint8).tobytes()]})


def _send_prefixes(order, n: int, buckets: int):
    """Packed postings for each bucket of shingles: 40 bits of the hash (with the bucket,
    as good as unique; the pairs are verified on whole hashes), the document, the size of its
    set and the place in its order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(order.value, np.uint8)
        h, doc, place, ids, sizes, held = [], [], [], [], [], 0

        def frame():
            keys, who, at = np.concatenate(h), np.concatenate(doc), np.concatenate(place)
            bucket = ((keys & np.uint64(0xFFFF)).astype(np.int64) * buckets) >> 16
            by = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[by], np.arange(buckets + 1))
            every, size = np.array(ids, np.int64), np.array(sizes, np.uint32)
            named, data = [], []
            for b in range(buckets):
                part = by[cut[b]:cut[b + 1]]
                if len(part):
                    there, which = np.unique(who[part], return_inverse=True)
                    short = (keys[part] >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                    step = np.diff(which, prepend=0).astype(np.uint16)
                    named.append(b)
                    data.append(zstandard.compress(pickle.dumps(
                        (short, step, at[part].astype(np.uint32), every[there], size[there]), protocol=5), 1))
            return pa.RecordBatch.from_arrays([pa.array(named, pa.int32()), pa.array(data, pa.binary())], names=["bucket", "data"])

        for batch in _parts(batches):
            for key, s in _sets(batch, n):
                if not len(s):
                    continue
                k = prefix_length(len(s))
                c = counts[(s & np.uint64(len(counts) - 1)).astype(np.int64)]
                # rarest first, ties by hash: s is in order of hash and the sort is stable
                h.append(s[np.argsort(c, kind="stable")[:k]])
                doc.append(np.full(k, len(ids), np.int64))
                place.append(np.arange(k))
                ids.append(key)
                sizes.append(len(s))
                held += k
                if held > HELD or len(ids) > 60_000:
                    yield frame()
                    h, doc, place, ids, sizes, held = [], [], [], [], [], 0
        if held:
            yield frame()
        h, doc, place, ids, sizes = [], [], [], [], []
        give_back()
    return run


def _lists(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket: postings of shingles that several documents have; of shingles with the
    same documents the first, and in ``weight`` how many there are."""
    sent = [pickle.loads(zstandard.decompress(x)) for x in rows["data"]]
    raw = np.zeros((sum(len(x[2]) for x in sent), 8), np.uint8)
    raw[:, :5] = np.frombuffer(b"".join([x[0] for x in sent]), np.uint8).reshape(-1, 5)
    key = raw.reshape(-1).view("<u8")
    which = [np.cumsum(x[1].astype(np.int64)) for x in sent]
    doc = np.concatenate([x[3][w] for x, w in zip(sent, which)])
    n = np.concatenate([x[4][w] for x, w in zip(sent, which)])
    place = np.concatenate([x[2] for x in sent])
    order = np.argsort(key, kind="stable")
    key, doc, n, place = key[order], doc[order], n[order], place[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
    one, two = mix(doc.view(np.uint64)), mix(doc.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    s1, s2 = (np.add.reduceat(x, first) for x in (one, two))  # sums: nothing cancels out
    s2 = mix(s2 + size.astype(np.uint64))
    kept = np.flatnonzero(several)
    _, at, weight = np.unique(s1[kept] ^ s2[kept], return_index=True, return_counts=True)
    kept = kept[at]
    member = np.repeat(first[kept] - (np.cumsum(size[kept]) - size[kept]), size[kept]) + np.arange(int(size[kept].sum()))
    run = np.repeat(np.arange(len(kept)), size[kept])
    h = mix(key + np.uint64(int(rows["bucket"].iat[0]) << 40))
    head = np.r_[True, run[1:] != run[:-1]] if len(run) else np.empty(0, bool)
    return pd.DataFrame({"h": h[member].view(np.int64), "doc": doc[member], "n": n[member].astype(np.int32),
                         "place": place[member].astype(np.int32), "weight": weight[run].astype(np.int64),
                         "s1": s1[kept][run].view(np.int64), "s2": s2[kept][run].view(np.int64), "head": head})


def _full_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            sets = [s.view(np.int64) for _, s in _sets(batch, n)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(sets, pa.list_(pa.int64()))], names=["doc", "members"])
        give_back()
    return run


def _alike(common, a, b):
    return UNDER * common >= OVER * (a + b - common)


def similar(docs: DataFrame, *, key="doc_id", text="text", n: int = N) -> DataFrame:
    """``(key, n_shingles, component_id)`` for every row."""
    spark = docs.sparkSession
    id_ = F.col(key).cast("long")
    # no nullable number goes to Python: pandas would turn its column into doubles and round large ids
    source = docs.select(id_.isNull().alias("_none"), F.coalesce(id_, F.lit(0)).cast("long").alias("_id"),
                         F.xxhash64(text).alias("_row"), F.col(text).alias("_text"))
    size = source.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (size // SLOT_BYTES).bit_length()))
    counted = stored(source.mapInArrow(_count(n, bits), "part int, none boolean, id long, row long, n long, whole binary, "
                                                       "odd array<long>, data binary"), "counted")
    info = counted.where("part is null").select(F.expr("if(none, null, id)").alias("id"), "row", "n", "whole", "odd", "data")
    source = source.where("NOT _none").drop("_none")
    merged = (counted.where("part is not null").select("part", "data").repartition("part")
              .mapInPandas(_merge, "part int, data binary").collect())  # one table of fixed size
    order = b"".join(bytes(r["data"]) for r in sorted(merged, key=lambda r: r["part"])) or b"\0"
    buckets = pieces(info.agg(F.sum("n")).first()[0] or 0, BUCKET)
    each = stored(info.where("id is not null and n > 0").groupBy(F.col("id").alias("doc"))
                  .agg(F.max(F.struct("n", "row", "whole", "odd", "data")).alias("_s"), F.count("*").alias("rows")).select("doc", "_s.*", "rows"), "documents")
    classes = each.groupBy("n", "whole").agg(F.min("doc").alias("class"), F.count("*").alias("k")).where("k > 1").drop("k")
    copies = stored(each.join(classes, ["n", "whole"]).where("doc <> class").select("doc", "class"), "copies")
    source = _one_row_each(source, each, copies)
    sent = source.mapInArrow(_send_prefixes(spark.sparkContext.broadcast(order), n, buckets), "bucket int, data binary")
    found = stored(sent.groupBy("bucket").applyInPandas(
        _lists, "h long, doc long, n int, place int, weight long, s1 long, s2 long, head boolean"), "postings")
    # shingles of the same documents in other buckets
    heads = found.where("head").groupBy("s1", "s2").agg(F.min("h").alias("h"), F.sum("weight").alias("weight")).select("h", "weight")
    lists = stored(found.select("h", "doc", "n", "place").join(heads, "h"), "lists")
    drop(found)
    sizes = each.join(bounded_broadcast(copies, BROADCAST_IDS), "doc", "left_anti").select("doc", "n", "odd", "data")

    links, joined = None, None
    lists, plain = _with_share(lists), lists
    drop(plain)
    for turn in range(ROUNDS):
        pairs = stored(_suffix_filter(_proposals(lists, joined, turn), sizes), "pairs")
        found = _verified(source, pairs, n)
        drop(pairs)
        links = found if links is None else links.unionByName(found)
        joined = components(links)
    left = _remaining(lists, joined, sizes)
    rest = stored(_suffix_filter(left, sizes), "pairs")
    drop(left.mixed, lists)
    if not rest.isEmpty():
        joined = components(links.unionByName(_verified(source, rest, n)))
    drop(rest)
    # a class has the component of its smallest id
    class_ = F.coalesce("class", "id")
    out = info.select("id", F.col("n").alias("n_shingles")).join(copies.withColumnRenamed("doc", "id"), "id", "left")
    out = out.select("id", "n_shingles", class_.alias("class"))
    smallest = joined.select(F.col("id").alias("class"), "component")
    return out.join(smallest, "class", "left").select(F.col("id").alias(key), "n_shingles", F.coalesce("component", "class").alias("component_id"))


def _one_row_each(source: DataFrame, each: DataFrame, copies: DataFrame) -> DataFrame:
    """``source`` without ``copies`` and with the chosen row of each id that several rows have;
    only rows of such ids are moved."""
    again = stored(each.where("rows > 1").select("doc", "row"), "again")
    gone = stored(copies.select("doc").union(again.select("doc")).distinct(), "gone")
    rest = source.join(bounded_broadcast(gone, BROADCAST_IDS), F.col("_id") == F.col("doc"), "left_anti")
    if again.isEmpty():
        return rest
    # rows of one id and one hash have one text
    ids = stored(again.join(copies, "doc", "left_anti"), "ids")
    chosen = (source.join(bounded_broadcast(ids, BROADCAST_IDS), (F.col("_id") == F.col("doc")) & (F.col("_row") == F.col("row")), "left_semi")
              .groupBy("_id", "_row").agg(F.max("_text").alias("_text")))
    return rest.unionByName(stored(chosen, "chosen"))


def _with_share(lists: DataFrame) -> DataFrame:
    """Postings with how many shared shingles their document has.  Of a group of near
    copies the text they come from has most: all of its prefix is shared."""
    share = lists.groupBy("doc").agg(F.sum("weight").alias("share"))
    return stored(lists.join(share, "doc"), "lists")


def _labels(lists: DataFrame, joined: DataFrame | None) -> DataFrame:
    if joined is None:
        return lists.withColumn("c", F.col("doc"))
    return lists.join(joined.select(F.col("id").alias("doc"), "component"), "doc", "left").withColumn(
        "c", F.coalesce("component", "doc")).drop("component")


def _proposals(lists: DataFrame, joined: DataFrame | None, turn: int) -> DataFrame:
    """A pair for each document at most: with the leader that heads most of its lists."""
    rows = _labels(lists, joined)
    rank = -F.col("share") if turn == 0 else F.xxhash64("doc", F.lit(turn))
    leaders = rows.groupBy("h").agg(F.min(F.struct(rank.alias("r"), F.col("doc").alias("doc"), "n", "c")).alias("lead"))
    near = (rows.join(leaders, "h")
            .where((F.col("c") != F.col("lead.c")) & _lengths_fit(F.col("n"), F.col("lead.n"))))
    votes = near.groupBy("doc", F.col("lead.doc").alias("partner")).agg(F.sum("weight").alias("votes"))
    best = votes.groupBy("doc").agg(F.max(F.struct("votes", "partner")).alias("best"))
    return best.select(F.least("doc", "best.partner").alias("a"), F.greatest("doc", "best.partner").alias("b")).distinct()


def _lengths_fit(a, b):
    return (UNDER * F.least(a, b).cast("long")) >= OVER * F.greatest(a, b).cast("long")


def _remaining(lists: DataFrame, joined: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs of documents from different components that share a prefix shingle and
    pass the length and positional filters and that of the odd slots.  The largest component of a shingle is
    only paired with the others, never with itself."""
    labelled = rows = stored(_labels(lists, joined), "labelled")
    by = rows.groupBy("h", "c").agg(F.count("*").alias("k"))
    mixed = by.groupBy("h").agg(F.max(F.struct("k", "c")).alias("top"), F.count("*").alias("m")).where("m > 1").select(
        "h", F.col("top.c").alias("top"))
    rows = stored(rows.join(mixed, "h").join(sizes.select("doc", "odd"), "doc"), "mixed")
    drop(labelled)
    few = rows.where("c <> top").select("h", *[F.col(x).alias(f"{x}1") for x in ("doc", "n", "place", "c", "odd")])
    all_ = rows.select("h", *[F.col(x).alias(f"{x}2") for x in ("doc", "n", "place", "c", "odd")])
    need = F.ceil((OVER * (F.col("n1") + F.col("n2")).cast("long")) / (UNDER + OVER))
    most = (F.least("place1", "place2") + 1 + F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) - 1)
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.col("odd1")[k].bitwiseXOR(F.col("odd2")[k])) for k in range(SKETCH)])
    near = few.join(all_, "h").where((F.col("c1") != F.col("c2")) & _lengths_fit(F.col("n1"), F.col("n2")) & (most >= need)
                                     & (differ <= F.col("n1") + F.col("n2") - 2 * need))
    near = near.select(F.least("doc1", "doc2").alias("a"), F.greatest("doc1", "doc2").alias("b")).distinct()
    near.mixed = rows
    return near


def _suffix_filter(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members in the same range of the hash bound the members in common."""
    a = sizes.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("data").alias("da"))
    b = sizes.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("data").alias("db"))
    both = pairs.join(a, "a").join(b, "b")

    @F.pandas_udf("long")
    def bound(x: pd.Series, y: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        known = ((x.str.len() > 0) & (y.str.len() > 0)).to_numpy()
        out = np.minimum(na.to_numpy(), nb.to_numpy()).astype(np.int64)
        if known.any():
            left, right = (np.frombuffer(b"".join(v[known]), np.uint16).reshape(-1, RANGES) for v in (x, y))
            out[known] = np.minimum(left, right).sum(1, dtype=np.int64)
        return pd.Series(out)

    return both.withColumn("most", bound("da", "db", "na", "nb")).where(_alike(F.col("most"), F.col("na"), F.col("nb"))).select("a", "b")


def _verified(source: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """The pairs whose full sets are similar enough; each document's set is made once."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct(), "ids")
    wanted = source.join(bounded_broadcast(ids, BROADCAST_IDS), "_id", "left_semi")
    sets = wanted.mapInArrow(_full_sets(n), "doc long, members array<long>")
    # one row for each document; the aggregate makes one exchange that is read twice
    one = sets.groupBy("doc").agg(F.first("members").alias("members"))
    a = one.select(F.col("doc").alias("a"), F.col("members").alias("ma"))
    b = one.select(F.col("doc").alias("b"), F.col("members").alias("mb"))
    common = F.size(F.array_intersect("ma", "mb"))
    found = stored(pairs.join(a, "a").join(b, "b").where(_alike(common, F.size("ma"), F.size("mb"))).select("a", "b"), "links")
    drop(ids)
    return found
