"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL, HOT = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def fold(doc_id, k):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % k


def words(text):
    return WORD.findall((text or "").translate(LOW))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def shingle_set(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def smallest_reachable(ids, links):
    """ids, pairs -> id -> smallest id reachable."""
    near = {i: {i} for i in ids}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for i in sorted(near):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = i
                todo.extend(near[x])
    return out


def cut_repeats(docs, length=50):
    """[(id, bytes)] -> per row (kept, removed, spans); a null id comes last."""
    last = 1 << 62
    first = {}
    for i, t in docs:
        for k in range(len(t) - length + 1):
            g = t[k:k + length]
            first[g] = min(first.get(g, last), last if i is None else i)
    out = []
    for i, t in docs:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if first[t[k:k + length]] < (last if i is None else i):
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((bytes(b for b, g in zip(t, gone) if not g), sum(gone), spans))
    return out


def documents(spark, rows, extra=True):
    """[(doc_id, text)] with the other columns of documents, and extra ones whose names clash."""
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(i, t, "en" if t else None, "src0", len(t or "")) for i, t in rows]
    if extra:
        kind += ", score double, ids array<int>, n_shingles long, row long, h long, kept boolean, component string, _id string"
        data = [(*r, 0.5, [1], 7, 8, 9, True, "x", "y") for r in data]
    return spark.createDataFrame(data, kind)
