"""SentencePiece encoding and decoding with a public BPE model.

In such a model no piece goes on after a white-space marker has followed another letter,
so no merge crosses the place in front of a run of markers.  A text is therefore a row of
chunks, each a run of markers and the letters up to the next one, that are segmented on
their own.  For each block of rows a table of the distinct chunks is made; each chunk that
is new to it is segmented once, by merging the best-scored neighbours first, and the ids
are joined back to the text by position.  A worker keeps its table for the next blocks, as
two halves of bounded size of which the older one goes when the newer one is full.

Pieces of one letter that the model lacks become ids of their bytes.  Decoding looks up the
bytes of each id in one buffer by an offset table.

A model of another kind (not BPE, a normaliser that changes letters, pieces across markers,
pieces of the user's own or unused ones) is refused.

Defined results: null texts encode as empty ones to no ids; a null list of ids decodes to
empty text; control ids decode to nothing, the unknown id to its surface; bytes that are no
UTF-8 decode to replacement letters, one each; whole texts are encoded however long they are;
repeated rows and ids are rows of their own; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The white-space marker.
MARK = "▁"
#: Chunks in each half of a worker's table, and the longest chunk (in letters) that is kept there.
HALF, KEEP = 200_000, 64
#: Letters of a chunk up to which all pairs are looked through for each merge, instead of a queue.
SHORT = 64
#: Rows and bytes of a block.
ROWS, BYTES = 512, 4_000_000
#: Kinds of pieces, as the model file numbers them.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class Model:
    """The pieces of a model file and the tables made from them."""

    def __init__(self, raw: bytes):
        from sentencepiece import sentencepiece_model_pb2
        spec = sentencepiece_model_pb2.ModelProto.FromString(raw)
        kinds = {p.type for p in spec.pieces}
        normal, how = spec.normalizer_spec, spec.trainer_spec
        if (how.model_type != 2 or not how.byte_fallback or normal.precompiled_charsmap or normal.remove_extra_whitespaces
                or not normal.add_dummy_prefix or not normal.escape_whitespaces or how.treat_whitespace_as_suffix
                or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("the model is not of the byte-fallback BPE kind without a normaliser")
        if any(MARK in p.piece.lstrip(MARK) or p.piece.startswith(MARK * 2) and p.piece.strip(MARK)
               for p in spec.pieces if p.type == NORMAL):
            raise ValueError("a piece of the model crosses a white-space marker")
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in spec.pieces if p.type == NORMAL}
        self.byte_ids = [0] * 256
        self.kind = np.array([p.type for p in spec.pieces], np.int8)
        out = []
        for i, p in enumerate(spec.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                out.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == UNKNOWN:
                out.append(how.unk_surface.encode())
            else:
                out.append(b"" if p.type == CONTROL else p.piece.replace(MARK, " ").encode())
        #: The bytes of id i are buffer[offset[i]:offset[i + 1]].
        self.offset = np.zeros(len(out) + 1, np.int64)
        np.cumsum([len(t) for t in out], out=self.offset[1:])
        self.buffer = np.frombuffer(b"".join(out), np.uint8)
        self.marked = np.array([p.type == NORMAL and p.piece.startswith(MARK) for p in spec.pieces])
        self.is_byte = self.kind == BYTE

    def segment(self, chunk: str) -> list[int]:
        """Ids of one chunk: of all neighbours that make a piece, the best-scored merge first,
        of equals the one furthest left."""
        part = list(chunk)
        if len(part) <= SHORT:
            get, none = self.score.get, -math.inf
            rank = [get(a + b, none) for a, b in zip(part, part[1:])]  # of each pair of neighbours
            while rank and (best := max(rank)) != none:
                k = rank.index(best)
                part[k:k + 2] = [part[k] + part[k + 1]]
                del rank[k]
                if k:
                    rank[k - 1] = get(part[k - 1] + part[k], none)
                if k < len(rank):
                    rank[k] = get(part[k] + part[k + 1], none)
        else:
            part = self._merge_long(part)
        out = []
        for p in part:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            else:
                out.extend(self.byte_ids[b] for b in p.encode("utf-8"))
        return out

    def _merge_long(self, part: list[str]) -> list[str]:
        """The same merges from a queue, in n log n time."""
        score, n = self.score, len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(-s, k, len(part[k]) + len(part[k + 1])) for k in range(n - 1)
                 if (s := score.get(part[k] + part[k + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            _, k, size = heapq.heappop(queue)
            j = after[k]
            # merged meanwhile with another neighbour, or gone
            if not part[k] or j >= n or len(part[k]) + len(part[j]) != size:
                continue
            part[k] += part[j]
            part[j] = ""
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (s := score.get(part[a] + part[b])) is not None:
                    heapq.heappush(queue, (-s, a, len(part[a]) + len(part[b])))
        return [p for p in part if p]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, without the space of the marker that opens every text."""
        if len(ids) and ((ids < 0).any() or (ids >= len(self.kind)).any()):
            raise ValueError("an id is not of the model")
        if not len(ids):
            return ""
        start = self.offset[ids]
        size = self.offset[ids + 1] - start
        end = np.cumsum(size)
        at = np.arange(end[-1], dtype=np.int64) + np.repeat(start - (end - size), size)
        raw = self.buffer[at].tobytes()
        first = np.flatnonzero(self.kind[ids] != CONTROL)[:1]
        if len(first) and self.marked[ids[first[0]]]:
            raw = raw[1:]
            size[first[0]] -= 1
        if (self.kind[ids] != CONTROL).all():  # a control id parts the bytes on its sides
            try:
                return raw.decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(ids, raw, size)

    def _decode_runs(self, ids: np.ndarray, raw: bytes, size: np.ndarray) -> str:
        """Bytes join to letters only within a run of byte ids; each other byte is a replacement letter."""
        out, at = [], 0
        cuts = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(ids)]):
            more = int(size[a:b].sum())
            piece, at = raw[at:at + more], at + more
            while piece:
                try:
                    out.append(piece.decode())
                    break
                except UnicodeDecodeError as wrong:
                    out.append(piece[:wrong.start].decode() + "\ufffd")
                    piece = piece[wrong.start + 1:]
        return "".join(out)


_RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def chunks(text: str) -> list[str]:
    """The chunks of a text, which join to the text with its markers."""
    if not text:
        return []
    text = MARK + text.replace(" ", MARK)
    if MARK * 2 not in text and not text.endswith(MARK):
        return [MARK + word for word in text[1:].split(MARK)]
    return _RUNS.findall(text)


class ChunkTable:
    """Distinct chunks and their ids (int32, packed), in two halves of bounded size."""

    def __init__(self, model: Model, half: int = HALF):
        self.segment, self.half = model.segment, half
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, wanted: set[str]) -> dict[str, bytes]:
        """The table's rows for the distinct chunks of a block; each that it lacks is segmented, once."""
        new, old, segment = self.new, self.old, self.segment
        found = {}
        for chunk in wanted:
            ids = new.get(chunk)
            if ids is None:
                ids = old.get(chunk)
                if ids is None:
                    ids = array("i", segment(chunk)).tobytes()
                if len(chunk) <= KEEP:
                    new[chunk] = ids
            found[chunk] = ids
        if len(new) > self.half:
            self.old, self.new = new, {}
        return found


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many rows and, but for single rows, so many bytes."""
    a, held = 0, 0
    for k, size in enumerate(pc.binary_length(texts).to_pylist()):
        if k > a and (k - a >= ROWS or held + size > BYTES):
            yield a, k
            a, held = k, 0
        held += int(size)
    if a < len(texts):
        yield a, len(texts)


def encode(df: DataFrame, path: str, *, key="doc_id", text="text") -> DataFrame:
    """``(key, ids array<int>)`` for each row of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(_model_bytes(path))
    source = df.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    out = T.StructType([source.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    kind = pa.list_(pa.field("element", pa.int32(), nullable=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(Model(shared.value))
        for batch in batches:
            for a, b in _blocks(batch.column(1)):
                part = batch.slice(a, b - a)
                rows = [chunks(t) for t in part.column(1).to_pylist()]
                ids = table.of(set().union(*rows)).__getitem__
                packed = [b"".join(map(ids, row)) for row in rows]
                offsets = np.zeros(len(packed) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in packed], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(packed), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(offsets), values).cast(kind)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "ids"])

    return source.mapInArrow(run, out)


def decode(df: DataFrame, path: str, *, ids="ids", out="decoded") -> DataFrame:
    """``df`` with the decoded text of its ids column added as ``out``."""
    shared = df.sparkSession.sparkContext.broadcast(_model_bytes(path))
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.StringType())])
    names = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                column = part.column(part.schema.get_field_index(ids))
                flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
                texts = [model.decode(flat[a:b]) if ok else ""
                         for a, b, ok in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist())]
                columns = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*names, out])

    return df.mapInArrow(run, schema)
