"""Repeated byte strings across documents, by sorted suffixes.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a document
with a smaller id is removed.  Strings are judged on the input.

Which suffixes are compared.  A string of ``LENGTH`` bytes contains an anchor: of its
runs of ``GRAM`` bytes the one with the smallest hash, the first at a tie.  Equal
strings have equal anchors, so the neighbouring strings with one anchor travel
together as a piece of text, and pieces with the same anchor meet in one cell.  A
piece is only sent if its anchor occurs in more than one document:

1. one pass counts anchors in a table of fixed size, which shows the very frequent ones;
2. one pass sends anchors, once for each batch of documents, to buckets that tell which occur again;
3. one pass cuts the pieces of these anchors; pieces of very frequent anchors are cut
   into single strings, which are dealt by their own hash, so that no cell gets all of them;
4. each cell sorts the suffixes of its pieces in two stages: the suffixes that are
   smaller than the suffix after them are sorted directly, to ``LENGTH`` bytes; the
   others are put in place by scanning the buckets of first bytes in order.  Common
   prefixes of neighbours then give the strings that are equal, and each such group
   its smallest document;
5. documents get their ranges back and are cut.

Steps 1 to 3 only choose what to sort; equality is decided on the bytes in step 4.

Defined results: null texts are empty; texts shorter than ``LENGTH`` stay whole; rows
with equal ids are one document and do not cut each other; rows with a null id come
after all others and do not cut each other; rows may repeat; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.llm.common import give_back, pieces, stored
from promolens.llm.hashing import _BASE, _power, mix, running

LENGTH, GRAM = 50, 18
#: Slots of the table of anchors (2^bits), parts it is merged in; an anchor is very frequent from
#: HOT documents on and HOT_TIMES the mean of all slots.
SLOT_BITS, PARTS, HOT, HOT_TIMES = 20, 16, 20_000, 16
#: Bytes of text for each bucket of anchors, and for each cell of pieces and home of documents.
BUCKET_BYTES, CELL_BYTES = 40 << 20, 8 << 20
#: Parts a cell is sorted in, one after the other (a part has all pieces of its anchors).
SUB = 32
#: Bytes looked at together inside a task.
BLOCK = 1 << 18
_PLACE_BITS = np.uint64(28)
_PLACES = np.uint64((1 << 28) - 1)
_LAST_ID = (1 << 63) - 1
_END = 0xFF  # never a byte of UTF-8
#: Bytes of a sent anchor, documents cut into pieces together, and compression of what is sent.
KEY, TOGETHER, LEVEL = 5, 4096, 3


# --- anchors ------------------------------------------------------------------

def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Runs of strings with one anchor: (text, first start, last start + 1, hash of
    the anchor), in the order of texts and starts."""
    out, group, size = [], [], 0

    def flush():
        if group:
            found = _block_anchors([texts[i] for i in group], length, gram)
            out.append((np.array(group)[found[0]], *found[1:]))

    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        if len(t) > BLOCK:  # in stretches that overlap by a string less a byte
            for at in range(0, len(t) - length + 1, BLOCK):
                _, a, b, h = _block_anchors([t[at:at + BLOCK + length - 1]], length, gram)
                out.append((np.full(len(a), i), a + at, b + at, h))
            continue
        if size + len(t) > BLOCK:
            flush()
            group, size = [], 0
        group.append(i)
        size += len(t)
    flush()
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    text, a, b, h = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((a, text))
    return text[order], a[order], b[order], h[order]


def _block_anchors(texts: list[bytes], length: int, gram: int):
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sums = running(raw)
    n = len(raw) - gram + 1
    grams = mix((sums[gram:] - sums[:-gram]) * _power(_BASE, len(sums))[:n])
    # hash first, then place: the least is the first of the smallest hash
    least = (grams & ~_PLACES) | np.arange(n, dtype=np.uint64)
    width, have = length - gram + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[:have - width], least[width - have:])
    size = np.array([len(t) for t in texts])
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(texts)), size)[:len(least)]
    start = np.flatnonzero(np.arange(len(least)) + length <= end[owner])
    place = (least[start] & _PLACES).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[start[1:]] != owner[start[:-1]])])
    last = np.r_[first[1:], len(start)] - 1
    text = owner[start[first]]
    base = (end - size)[text]
    return text, start[first] - base, start[last] + 1 - base, grams[place[first]]


# --- two-stage suffix sorting ---------------------------------------------------

def _eight(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number (zeros after the end)."""
    padded = np.r_[raw, np.zeros(64, np.uint8)]
    out = np.zeros(len(raw) + 56, np.uint64)
    for k in range(8):
        out |= padded[k:k + len(out)].astype(np.uint64) << np.uint64(8 * (7 - k))
    return out


def suffix_array(raw: np.ndarray, depth: int = LENGTH, eight: np.ndarray | None = None) -> np.ndarray:
    """Starts of all suffixes of ``raw`` in the order of their first ``depth`` bytes
    or more (suffixes that are equal so far stay next to each other)."""
    n = len(raw)
    if n == 0:
        return np.empty(0, np.int64)
    eight = _eight(raw) if eight is None else eight
    # first stage: suffixes smaller than their successor.  In a run of equal bytes the byte after it decides
    step = np.empty(n, np.int8)
    step[-1] = -1  # the last suffix is greater than the empty one
    step[:-1] = np.sign(raw[1:].astype(np.int16) - raw[:-1])
    decided = np.flatnonzero(step)
    smaller = step[decided[np.searchsorted(decided, np.arange(n))]] > 0
    direct = np.flatnonzero(smaller)
    order = direct[np.argsort(eight[direct], kind="stable")]
    tied = _sort_ties(order, eight, depth)
    order = tied
    # second stage: bucket scans, in order of first bytes
    heads = np.searchsorted(raw[order], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[raw[-1]].append(np.array([n - 1]) if not smaller[-1] else np.empty(0, np.int64))
    out = []
    for c in range(256):
        parts = waiting[c]
        wave = np.concatenate(parts) if parts else np.empty(0, np.int64)
        induced = [wave]
        while len(wave):  # runs of the byte c itself
            before = wave[wave > 0] - 1
            wave = before[(raw[before] == c) & ~smaller[before]]
            induced.append(wave)
        bucket = np.concatenate([*induced, order[heads[c]:heads[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        byte = raw[before]
        later = byte > c
        before, byte = before[later], byte[later]
        by_byte = np.argsort(byte, kind="stable")
        before, byte = before[by_byte], byte[by_byte]
        cut = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]]) if len(byte) else []
        for a, b in zip(cut, [*cut[1:], len(byte)]):
            waiting[byte[a]].append(before[a:b])
    return np.concatenate(out)


def _sort_ties(order: np.ndarray, eight: np.ndarray, depth: int) -> np.ndarray:
    """Order of suffixes sorted by eight bytes -> by ``depth`` bytes, eight more in each round."""
    if not len(order):
        return order
    key = eight[order]
    group = np.cumsum(np.r_[False, key[1:] != key[:-1]])
    for at in range(8, depth, 8):
        same = np.r_[False, group[1:] == group[:-1]]
        tied = np.flatnonzero(same | np.r_[same[1:], False])
        if not len(tied):
            break
        who, which = order[tied], group[tied]
        key = eight[np.minimum(who + at, len(eight) - 1)]
        sub = np.argsort(key, kind="stable")
        sub = sub[np.argsort(which[sub], kind="stable")]
        order[tied], key, which = who[sub], key[sub], which[sub]
        fresh = np.zeros(len(order), bool)
        fresh[tied] = np.r_[False, (key[1:] != key[:-1])]
        group = np.cumsum(np.r_[False, group[1:] != group[:-1]] | fresh)
    return order


def smallest_owner(texts: list[bytes], owner: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For every string of ``length`` bytes in ``texts``, the smallest owner of a text
    that holds it; strings in the order of texts and starts, and their number per text."""
    raw = np.frombuffer(b"".join([t + b"\xff" for t in texts]), np.uint8)
    eight = _eight(raw)
    size = np.array([len(t) for t in texts], np.int64)
    count = np.maximum(size - length + 1, 0)
    begin = np.cumsum(size + 1) - size - 1
    text = np.repeat(np.arange(len(texts)), count)
    start = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(len(text))
    number = np.full(len(raw), -1, np.int64)
    number[start] = np.arange(len(start))
    ranked = number[suffix_array(raw, length, eight)]
    ranked = ranked[ranked >= 0]  # in order, only suffixes that hold a whole string
    if not len(ranked):
        return np.empty(0, np.int64), count
    # adjacent common prefixes: of at least ``length`` bytes or not
    at = start[ranked]
    alike = np.ones(len(at) - 1, bool)
    for k in [*range(0, length - 8, 8), length - 8]:
        word = eight[at + k]
        alike &= word[1:] == word[:-1]
    first = np.flatnonzero(np.r_[True, ~alike])
    least = np.minimum.reduceat(owner[text[ranked]], first)
    out = np.empty(len(ranked), owner.dtype)
    out[ranked] = np.repeat(least, np.diff(np.r_[first, len(ranked)]))
    return out, count


# --- passes over documents ------------------------------------------------------

def _slot(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(16)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _bytes_of(column) -> list[bytes]:
    return [bytes(t) if t is not None else b"" for t in column]


def _once_per_text(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (h[1:] != h[:-1])] if len(h) else np.empty(0, bool)
    return text[new], h[new]


def _count_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, size = np.zeros(1 << SLOT_BITS, np.int64), 0
    for batch in batches:
        texts = _bytes_of(batch["_t"])
        size += sum(map(len, texts))
        text, _, _, h = anchors(texts)
        np.add(total, np.bincount(_slot(_once_per_text(text, h)[1]), minlength=len(total)), out=total)
    each = len(total) // PARTS
    yield pd.DataFrame({"part": range(PARTS), "size": [size] + [0] * (PARTS - 1),
                        "data": [zstandard.compress(total[i * each:(i + 1) * each].tobytes(), 1) for i in range(PARTS)]})
    give_back()


def _merge_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, list] = {}
    for batch in batches:
        for part, size, data in zip(batch["part"], batch["size"], batch["data"]):
            counts = np.frombuffer(zstandard.decompress(data), np.int64)
            have = total.setdefault(part, [0, 0])
            have[0], have[1] = have[0] + size, have[1] + counts
    yield pd.DataFrame({"part": list(total), "size": [x[0] for x in total.values()], "data": [x[1].tobytes() for x in total.values()]})


def _short(h: np.ndarray) -> bytes:
    """The upper 40 bits of hashes in five bytes each.  With the lower 16 bits, which
    choose the bucket, they are as good as unique there; anchors that are taken for
    equal by mistake only cost a comparison."""
    return np.ascontiguousarray((h >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY]).tobytes()


def _of_short(raw: bytes) -> np.ndarray:
    """Hashes of which only the upper 40 bits are known."""
    out = np.zeros((len(raw) // KEY, 8), np.uint8)
    out[:, :KEY] = np.frombuffer(raw, np.uint8).reshape(-1, KEY)
    return out.reshape(-1).view("<u8").astype(np.uint64) << np.uint64(24)


def _send_anchors(hot, buckets: int, homes: int):
    """Rows for buckets (bucket >= 0: anchors, each once for a batch) and rows for
    documents (bucket < 0: anchors that another document of the batch has, or very
    frequent ones; packed by the home of the documents)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        is_hot = np.unpackbits(np.frombuffer(hot.value, np.uint8)).astype(bool)
        for batch in batches:
            text, _, _, h = anchors(_bytes_of(batch["_t"]))
            text, h = _once_per_text(text, h)
            if not len(h):
                continue
            k, o = batch["_k"].to_numpy(), batch["_o"].to_numpy()
            order = np.argsort(h, kind="stable")
            sorted_h = h[order]
            new = np.r_[True, sorted_h[1:] != sorted_h[:-1]]
            run_of = np.cumsum(new) - 1
            many = np.bincount(run_of) > 1
            first = order[np.flatnonzero(new)]
            again = np.empty(len(h), bool)
            again[order] = many[run_of]
            frequent = is_hot[_slot(h)]
            known = again | frequent
            rows = [(-1 - int(home), 0, 0, data, b"", b"", b"")
                    for home, data in _by_home(text[known], h[known], k, o, homes)]
            send = np.zeros(len(h), bool)
            send[first] = True
            send &= ~frequent
            st, sh, sk = text[send], h[send], again[send]
            bucket = ((sh & np.uint64(0xFFFF)).astype(np.int64) * buckets) >> 16
            by = np.argsort(bucket, kind="stable")  # documents stay in order within a bucket
            for b_id, a, b in _runs(bucket[by]):
                part = by[a:b]
                docs, index = np.unique(st[part], return_inverse=True)
                rows.append((int(b_id), 0, 0, _short(sh[part]),
                             np.diff(index, prepend=0).astype(np.uint32).tobytes() if len(index) else b"",
                             np.packbits(sk[part]).tobytes(), np.stack([k[docs], o[docs]]).tobytes()))
            yield pd.DataFrame(rows, columns=["bucket", "_k", "_o", "keys", "index", "known", "docs"])
        give_back()
    return run


def _runs(values: np.ndarray) -> Iterator[tuple]:
    """(value, start, end) of runs of equal values."""
    if not len(values):
        return
    cut = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    for a, b in zip(cut, np.r_[cut[1:], len(values)]):
        yield values[a], a, b


def _by_home(doc: np.ndarray, keys: np.ndarray, k: np.ndarray, o: np.ndarray, homes: int):
    """(home, packed keys of its documents); ``doc`` counts up and points into ``k`` and ``o``."""
    if not len(doc):
        return
    which, first, size = np.unique(doc, return_index=True, return_counts=True)
    home = k[which] % homes
    for h, part in _places_of(home):
        at = np.concatenate([np.arange(first[i], first[i] + size[i]) for i in part])
        yield h, pickle.dumps((k[which[part]], o[which[part]], size[part].astype(np.uint32), _short(keys[at])), protocol=5)


def _places_of(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each distinct value and its places."""
    order = np.argsort(values, kind="stable")
    for v, a, b in _runs(values[order]):
        yield int(v), order[a:b]


def _anchors_again(rows: pd.DataFrame, homes: int) -> pd.DataFrame:
    """A bucket: for the documents of each home their anchors that another batch, or
    another document of a batch, has too.  Rows for documents pass."""
    if rows["bucket"].iat[0] < 0:
        return pd.DataFrame({"home": -1 - rows["bucket"], "data": rows["keys"]})
    keys = [_of_short(x) for x in rows["keys"]]
    size = [len(x) for x in keys]
    known = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(rows["known"], size)])
    docs = [np.frombuffer(x, np.int64).reshape(2, -1) for x in rows["docs"]]
    base = np.cumsum([0, *(d.shape[1] for d in docs[:-1])])
    doc = np.concatenate([np.cumsum(np.frombuffer(x, np.uint32).astype(np.int64)) + b for x, b in zip(rows["index"], base)])
    k, o = np.concatenate(docs, 1)
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    run_of = np.cumsum(np.r_[False, sorted_keys[1:] != sorted_keys[:-1]])
    many = (np.bincount(run_of) > 1) | (np.bincount(run_of, weights=known[order]) > 0)
    tell = np.zeros(len(keys), bool)
    tell[order] = many[run_of]
    tell &= ~known  # the others have been told in their batch
    at = np.flatnonzero(tell)
    at = at[np.argsort(doc[at], kind="stable")]
    return pd.DataFrame(list(_by_home(doc[at], keys[at], k, o, homes)), columns=["home", "data"])


def _told_documents(rows: pd.DataFrame) -> pd.DataFrame:
    """A home: all told anchors of each of its documents, in one row."""
    return _one_row_each([pickle.loads(x) for x in rows["data"]], KEY, "keys")


def _one_row_each(parts: list, width: int, name: str) -> pd.DataFrame:
    """[(k, o, sizes, packed values)] -> one row for each (k, o) with all its values."""
    k, o = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    size = [p[2].astype(np.int64) * width for p in parts]
    found: dict[tuple[int, int], list[bytes]] = {}
    at = 0
    for p, n in zip(parts, size):
        ends = np.cumsum(n)
        for i, (a, b) in enumerate(zip(ends - n, ends)):
            found.setdefault((k[at + i], o[at + i]), []).append(p[3][a:b])
        at += len(n)
    return pd.DataFrame({"_k": [x for x, _ in found], "_o": [x for _, x in found], name: [b"".join(v) for v in found.values()]})


def _cut_pieces(hot, cells: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        is_hot = np.unpackbits(np.frombuffer(hot.value, np.uint8)).astype(bool)
        for whole in batches:
            for lo in range(0, len(whole), TOGETHER):
                batch = whole.iloc[lo:lo + TOGETHER]
                rows = _pieces_of(_bytes_of(batch["_t"]), batch["keys"], batch["_k"].to_numpy(), batch["_o"].to_numpy(), is_hot, cells)
                if rows:
                    yield pd.DataFrame(rows, columns=["cell", "data"])
        give_back()
    return run


def _pieces_of(texts, keys, k, o, is_hot, cells):
    text, a, b, h = anchors(texts)
    if not len(h):
        return []
    wanted = np.zeros(len(h), bool)
    for d, lo, hi in _runs(text):
        told = np.unique(_of_short(bytes(keys.iat[d])))
        wanted[lo:hi] = np.isin(h[lo:hi] & ~np.uint64((1 << 24) - 1), told)
    text, a, b, h = text[wanted], a[wanted], b[wanted], h[wanted]
    cell = (mix(h) % np.uint64(cells * SUB)).astype(np.int64)
    frequent = is_hot[_slot(h)]
    found: dict[int, tuple[dict, bytearray, array, array, array]] = {}

    def add(where, piece, d, start):
        names, sub, which, doc, at = found.setdefault(where % cells, ({}, bytearray(), array("I"), array("I"), array("I")))
        n = names.setdefault(piece, len(names))
        if n == len(sub):
            sub.append(where // cells)
        which.append(n)
        doc.append(d)
        at.append(start)

    for d, start, end, c, split in zip(text.tolist(), a.tolist(), b.tolist(), cell.tolist(), frequent.tolist()):
        t = texts[d]
        if not split:
            add(c, t[start:end + LENGTH - 1], d, start)
            continue
        for i in range(start, end):
            one = t[i:i + LENGTH]
            add(int.from_bytes(mix(np.frombuffer(one[:48], np.uint64).sum(keepdims=True)).tobytes(), "little") % (cells * SUB), one, d, i)
    rows = []
    while found:
        c, (names, sub, which, doc, at) = found.popitem()
        doc, which, at = (np.frombuffer(x, np.uint32) for x in (doc, which, at))
        # a document that holds a piece many times: fine, each is a place to cut
        data = (list(names), bytes(sub), which, k[doc], o[doc], at)
        rows.append((c, zstandard.compress(pickle.dumps(data, protocol=5), LEVEL)))
    return rows


def _sort_cell(rows: pd.DataFrame, homes: int) -> pd.DataFrame:
    """Ranges to remove, found in one cell, packed by the home of the documents."""
    names: dict[bytes, int] = {}
    part = bytearray()  # equal pieces are in the same one
    which, k, o, at = [], [], [], []
    for data in rows["data"]:
        own, sub, w, dk, do, start = pickle.loads(zstandard.decompress(data))
        index = np.empty(len(own), np.uint32)
        for i, (x, s) in enumerate(zip(own, sub)):
            index[i] = n = names.setdefault(x, len(names))
            if n == len(part):
                part.append(s)
        which.append(index[w])
        k.append(dk)
        o.append(do)
        at.append(start)
    which, k, o, at = (np.concatenate(x) for x in (which, k, o, at))
    texts = list(names)
    del names
    part = np.frombuffer(part, np.uint8)
    found, part_of = [], part[which]
    for s in range(SUB):
        own, here = np.flatnonzero(part == s), np.flatnonzero(part_of == s)
        if len(own):
            found += _gone([texts[i] for i in own], np.searchsorted(own, which[here]), k[here], o[here], at[here].astype(np.int64))
    del texts, part_of, which
    give_back()
    if not found:
        return pd.DataFrame({"home": [], "data": []}).astype({"home": "int64"})
    out_k, out_o, a, b = (np.concatenate(x) for x in zip(*found))
    home = out_k % homes
    out = []
    for h, part in _places_of(home):
        order = part[np.lexsort((a[part], out_o[part], out_k[part]))]
        k, o = out_k[order], out_o[order]
        cut = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (o[1:] != o[:-1])])
        both = np.stack([a[order], b[order]], 1).astype(np.uint32)
        size = np.diff(np.r_[cut, len(k)]).astype(np.uint32)
        out.append((h, zstandard.compress(pickle.dumps((k[cut], o[cut], size, both.tobytes()), protocol=5), 1)))
    return pd.DataFrame(out, columns=["home", "data"])


def _gone(names: list[bytes], which: np.ndarray, k: np.ndarray, o: np.ndarray, at: np.ndarray) -> list[tuple]:
    """For every place of every piece the strings that a smaller document holds: (k, o, starts, ends)."""
    owner = np.full(len(names), _LAST_ID, np.int64)
    np.minimum.at(owner, which, o)
    least, count = smallest_owner(names, owner)
    first = np.cumsum(count) - count
    out = []
    for lo in range(0, len(which), 20_000):
        w = which[lo:lo + 20_000]
        size = count[w]
        row = np.repeat(np.arange(len(w)), size)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        gone = least[first[w][row] + nth] < o[lo + row]
        edge = gone.astype(np.int8)
        starts = np.flatnonzero((edge == 1) & np.r_[True, (edge[:-1] == 0) | (row[1:] != row[:-1])]) if len(row) else []
        ends = np.flatnonzero((edge == 1) & np.r_[(edge[1:] == 0) | (row[1:] != row[:-1]), True]) if len(row) else []
        if len(starts):
            r = lo + row[starts]
            out.append((k[r], o[r], at[r] + nth[starts], at[r] + nth[ends] + LENGTH))
    return out


def _ranges_of_documents(rows: pd.DataFrame) -> pd.DataFrame:
    return _one_row_each([pickle.loads(zstandard.decompress(x)) for x in rows["data"]], 8, "ranges")


def cut_ranges(text: bytes, ranges: np.ndarray) -> tuple[bytes, np.ndarray]:
    """What is left of ``text``, and the maximal removed ranges (start, end)."""
    if not len(ranges):
        return text, ranges
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    first = np.flatnonzero(np.r_[True, ranges[1:, 0] > reach[:-1]])
    merged = np.stack([ranges[first, 0], reach[np.r_[first[1:], len(ranges)] - 1]], 1)
    kept, at = [], 0
    for a, b in merged.tolist():
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), merged


def _cut_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 2048):
            part = whole.slice(lo, 2048)
            batch = part.select(["_t", "ranges"]).to_pandas()
            texts, kept, removed, spans = _bytes_of(batch["_t"]), [], [], []
            for t, ranges in zip(texts, batch["ranges"]):
                raw = bytes(ranges) if ranges is not None else b""
                left, gone = cut_ranges(t, np.frombuffer(raw, np.uint32).astype(np.int64).reshape(-1, 2))
                kept.append(left)
                removed.append(len(t) - len(left))
                spans.append(gone.reshape(-1))
            through = [c for c in part.schema.names if c not in ("_o", "_t", "ranges")]
            made = {"n_bytes": pa.array([len(t) for t in texts], pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array([len(x) // 2 for x in spans], pa.int64()), "kept": pa.array(kept, pa.binary()),
                    "spans": pa.array(spans, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in through), *made.values()], names=[*through, *made])
    give_back()


def deduplicate(docs: DataFrame, *, key="doc_id", text="text", carry: list[str] = ()) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept binary, spans array<long>)`` and the
    columns of ``carry`` for every row; spans holds start and end of each removed range.
    Other columns are not read, and a carried one may not have the name of a result."""
    if {key, "n_bytes", "n_removed", "n_spans", "kept", "spans"} & set(carry):
        raise ValueError("a carried column has the name of a result")
    spark = docs.sparkSession
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    number = F.col(key).cast("long")
    source = docs.select(number.alias("_id"), F.xxhash64(number, text).alias("_k"),
                         F.coalesce(number, F.lit(_LAST_ID)).alias("_o"), data.alias("_t"),
                         *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    counted = stored(source.select("_t").mapInPandas(_count_anchors, "part int, size long, data binary"), "anchors")
    merged = sorted(counted.repartition("part").mapInPandas(_merge_counts, "part int, size long, data binary").collect(),
                    key=lambda r: r["part"])  # one table of fixed size
    total = sum(r["size"] for r in merged)
    counts = np.concatenate([np.frombuffer(r["data"], np.int64) for r in merged]) if merged else np.zeros(1 << SLOT_BITS, np.int64)
    frequent = counts >= max(HOT, HOT_TIMES * counts.mean())
    hot = spark.sparkContext.broadcast(np.packbits(frequent).tobytes())

    homes = pieces(total, CELL_BYTES)
    sent = source.select("_k", "_o", "_t").mapInPandas(
        _send_anchors(hot, pieces(total, BUCKET_BYTES), homes),
        "bucket int, _k long, _o long, keys binary, index binary, known binary, docs binary")
    told = sent.groupBy("bucket").applyInPandas(lambda rows: _anchors_again(rows, homes), "home long, data binary")
    told = told.groupBy("home").applyInPandas(_told_documents, "_k long, _o long, keys binary")
    # both joins take the same columns of the documents, so that Spark moves the texts once
    own = source.columns
    found = source.join(told, ["_k", "_o"]).select(*own, "keys")
    cells = found.mapInPandas(_cut_pieces(hot, pieces(total, CELL_BYTES)), "cell int, data binary")
    ranges = cells.groupBy("cell").applyInPandas(lambda rows: _sort_cell(rows, homes), "home long, data binary")
    ranges = ranges.groupBy("home").applyInPandas(_ranges_of_documents, "_k long, _o long, ranges binary")
    joined = source.join(ranges, ["_k", "_o"], "left").select(*own, "ranges")
    through = [f for f in joined.schema.fields if f.name not in ("_o", "_t", "ranges")]
    made = T._parse_datatype_string("n_bytes long, n_removed long, n_spans long, kept binary, spans array<long>")
    out = joined.mapInArrow(_cut_documents, T.StructType([*through, *made.fields]))
    return out.select(F.col("_id").alias(key), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
                      *made.names)
