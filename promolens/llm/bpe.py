"""Byte-pair encoding and decoding with a public vocabulary.

The merges of a word are found without running them.  An Aho-Corasick automaton
over all tokens gives the longest token that starts at each place; the encoder
walks from left to right with these, and steps back to the next shorter token
where two neighbours could not stand side by side after all merges.  Whether they
can is kept in a table of token pairs, filled as pairs occur.  Every place is
left at most once, so a word takes linear time.  Decoding looks up each id's
bytes in one buffer by an offset table.

Texts are prepared as the vocabulary file says (NFC, white space to one space,
lower case, the file's split pattern, bytes as printable letters, a mark at the
end of a word).  A vocabulary of another kind is refused.

Defined results: null texts encode as empty ones to no ids and decode to empty
text; a null list of ids decodes to empty text; strings of special tokens become
their ids; whole texts are encoded however long they are.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.llm.common import give_back

#: Entries after which the caches of a worker start anew.
CACHE = 400_000


def _printable_bytes() -> list[str]:
    """The letter that stands for each byte: itself if it is printable Latin-1,
    else the next free letter from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens, their merges and the tables made from them."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError("the vocabulary file is not of the word-end kind")
        self.suffix = model["end_of_word_suffix"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        white = r"\p{White_Space}"
        self.words = regex.compile(split.replace(r"[^\s", "[^" + white)).findall
        self.white = regex.compile(white + "+")
        self.odd_white = regex.compile(r"[\x1c-\x1f]").search  # white to str.split, not to the file
        vocab: dict[str, int] = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None
        end = "\0"  # the word end as one letter; no printable letter is \0

        def letters(token: str) -> str:
            return token[:-len(self.suffix)] + end if token.endswith(self.suffix) and token != self.suffix else token

        self.end = end
        self.ids = {letters(t): i for t, i in vocab.items()}
        size = max([*vocab.values(), *special.values()]) + 1
        self.length = [0] * size
        for t, i in self.ids.items():
            self.length[i] = len(t)
        #: id -> (left, right) of the merge that makes it; (left, right) -> (rank, id)
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = [-1] * size  # of the merge; single letters come before all merges
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ia, ib, im = self.ids[letters(a)], self.ids[letters(b)], self.ids[letters(a + b)]
            self.merge[ia, ib] = (rank, im)
            if im not in self.parts:
                self.parts[im], self.rank[im] = (ia, ib), rank
        self.shorter: list[int] = [-1] * size
        for t, i in self.ids.items():
            self.shorter[i] = next((k for n in range(len(t) - 1, 0, -1) if (k := self.ids.get(t[:n])) is not None), -1)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for t, i in self.ids.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.byte_letters = _printable_bytes()
        #: Decoding: the bytes of token i, with a space after it, are buffer[offset[i]:offset[i + 1]].
        text = [""] * size
        for t, i in [*vocab.items(), *special.items()]:
            text[i] = t
        raw_tokens = [t.encode() + b" " for t in text]
        self.offset = np.zeros(size + 1, np.int64)
        np.cumsum([len(t) for t in raw_tokens], out=self.offset[1:])
        self.buffer = np.frombuffer(b"".join(raw_tokens), np.uint8)
        self._pairs: dict[tuple[int, int], bool] = {}

    def may_stand(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` can be neighbours after all merges: no
        merge across their border would have come before the merges that made them."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) > CACHE:
                self._pairs.clear()
            known = self._pairs[left, right] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        """Undo merges on both sides of the border, latest first.  Of a pair that
        merges, the border only holds if one side was used up by a merge before."""
        rank, parts = self.rank, self.parts
        until = len(self.merge) + 1  # merges of this rank and later cannot happen between the two at hand
        inclusive = False  # equal ranks are applied from left to right
        while True:
            joined = self.merge.get((left, right))
            if joined is not None and (joined[0] < until or inclusive and joined[0] == until):
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            if rank[left] > rank[right]:  # the left side was made later
                until, inclusive = rank[left], False
                left = parts[left][1]
            else:  # the same merge further left goes first
                until, inclusive = rank[right], True
                right = parts[right][0]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word, given in printable letters without the end mark."""
        text = word + self.end
        longest = [-1] * (len(text) + 1)
        length, shorter, pairs, may_stand = self.length, self.shorter, self._pairs, self.may_stand
        for last, token in self.automaton.iter(text):
            start = last - length[token] + 1
            # of the tokens from one start the longest ends last
            longest[start] = token
        closed: set[int] = set()  # places from which no way leads to the end
        out: list[int] = []
        at, stop, token, before = 0, len(text), longest[0], -1
        while at < stop:
            while token >= 0:
                if at + length[token] not in closed:
                    if before < 0:
                        break
                    fits = pairs.get((before, token))
                    if fits if fits is not None else may_stand(before, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                before, token = token, longest[at]
            else:
                closed.add(at)
                if not out:
                    raise ValueError(f"no tokens for {word!r}")
                token = out.pop()
                at -= length[token]
                before = out[-1] if out else -1
        return out

    def prepared(self, text: str) -> list[str]:
        """Runs without white space of the prepared text.  No word crosses one."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # letter by letter: the capital sigma has one small form whatever follows
            text = text.replace("Σ", "σ")
        if self.odd_white(text):
            return [run for run in self.white.split(text.lower()) if run]
        return text.lower().split()

    def encoder(self):
        """Function text -> ids as int32 bytes, with caches of runs and words."""
        letters, encode_word = self.byte_letters, self.encode_word

        def pack(ids: list[int]) -> bytes:
            return array("i", ids).tobytes()

        def word_ids(word: str) -> bytes:
            if word.isascii() and word.isalnum():
                return pack(encode_word(word))
            return pack(encode_word("".join([letters[b] for b in word.encode("utf-8", "surrogatepass")])))

        class Cache(dict):
            def __init__(self, make):
                self.make = make

            def __missing__(self, text: str) -> bytes:
                found = self.make(text)
                if len(text) <= 64:
                    if len(self) > CACHE:
                        self.clear()
                    self[text] = found
                return found

        words = Cache(word_ids).__getitem__
        runs = Cache(lambda run: b"".join(map(words, self.words(run)))).__getitem__

        def encode(text: str | None) -> bytes:
            if not text:
                return b""
            out: list[bytes] = []
            for part in self.at_special(text) if self.at_special else [text]:
                if part in self.special:
                    out.append(pack([self.special[part]]))
                elif part:
                    out.extend(map(runs, self.prepared(part)))
            return b"".join(out)

        return encode

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of the ids: their tokens joined by one space."""
        if not len(ids):
            return b""
        start = self.offset[ids]
        size = self.offset[ids + 1] - start
        end = np.cumsum(size)
        at = np.arange(end[-1], dtype=np.int64) + np.repeat(start - (end - size), size)
        return self.buffer[at[:-1]].tobytes()


def _vocabulary_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, path: str, *, key="doc_id", text="text") -> DataFrame:
    """``(key, ids array<int>)`` for each row of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(_vocabulary_bytes(path))
    source = df.select(F.col(key).alias(key), F.col(text).alias("_text"))
    out = T.StructType([source.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Vocabulary(shared.value).encoder()
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                ids = [one(t) for t in part.column(1).to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                kind = pa.list_(pa.field("element", pa.int32(), nullable=False))
                lists = pa.ListArray.from_arrays(pa.array(offsets), values).cast(kind)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "ids"])
        del one
        give_back()

    return source.mapInArrow(run, out)


def decode(df: DataFrame, path: str, *, ids="ids", out="decoded") -> DataFrame:
    """``df`` with the decoded text of its ids column added as ``out``."""
    shared = df.sparkSession.sparkContext.broadcast(_vocabulary_bytes(path))
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.StringType())])
    names = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                column = part.column(part.schema.get_field_index(ids))
                flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
                valid = column.is_valid().to_pylist()
                texts = [vocabulary.decode(flat[a:b]).decode() if ok else ""
                         for a, b, ok in zip(offsets[:-1], offsets[1:], valid)]
                columns = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*names, out])
        del vocabulary
        give_back()

    return df.mapInArrow(run, schema)
