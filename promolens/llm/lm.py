"""Probability of texts by logistic mixing of hashed-context bit predictors.

A text is a sequence of bytes and an end mark.  After each byte the next one is
coded by binary decisions along a Huffman tree that belongs to the byte before (so
that likely bytes take few decisions).  A-Z count as small letters.  For every decision
several predictors look up, each by a hash of its own context (the last 3 or 5 bytes, or
the word so far and the byte before it) and of the tree node, how often the decision was
taken in all training texts; one more points to the byte that followed the same six bytes
when the text last held them.  Their log-odds are added with weights chosen by a gate (how
often the two longer contexts were seen, and whether there is such a byte); the sum gives
the probability.  While a text is read the weights follow the gradient of its coding cost,
from common first weights on, in steps that grow with the text: the weights of a step
depend only on what was read before it, so the result is the probability of the text
under one model.

Training is two Spark passes over all training texts: pairs of bytes for the trees,
then decisions for the predictors, counted by slot.  The tables have a slot of each
predictor for every ``SLOT_BYTES`` bytes of training text (2^``SLOT_BITS`` at least); a task
sends sorted counts by range of slots and each range is added up on its own, so that no
task of the counting holds all slots.  The first weights are learned on one of
``WEIGHT_EACH`` training texts (``WEIGHT_TEXTS`` at least), left out of the tables.  Scoring a text needs nothing but the tables.

The plain model beside it counts words; see ``word_scores``.

Defined results: a null text is an empty one and has the probability of the end mark;
without training texts all decisions are even and words are unseen; equal texts have
equal scores.  Rows with null ids are scored; repeated rows each count.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import give_back, keep_freed, pieces, stored
from promolens.llm.hashing import batch_word_hashes, mix, running, spans_to

#: Fewest slots of a predictor's table (2^bits), bytes of training text for a slot, most slots (the
#: hashes have 32 bits, of which a count takes one for the outcome), slots of a range (2^bits).
SLOT_BITS, SLOT_BYTES, MOST_BITS, RANGE_BITS = 21, 128, 31, 17
#: Counts of eight bytes that a task holds before it sends them: those that occur again are sent once.
HELD = 8_000_000
#: Most times a symbol is counted in one number.
MANY = 0xFFFF
#: Texts the first weights are learned on, at least, and one of how many; they are not in the tables.
WEIGHT_TEXTS, WEIGHT_EACH = 64, 1024
#: Hashed predictors, inputs of a sum (with the pointer and a constant), classes of counts.
PREDICTORS, INPUTS, SEEN = 3, 5, 4
GATES = SEEN * SEEN * 2
#: Step of the weights for each decision, and the decisions a step counts for at most.
RATE, MOST = 0.016, 64
SPREAD = np.uint32(0x85EBCA6B)
END = 0xFF  # never a byte of UTF-8
HISTORY = 8  # zero bytes before each text
#: Bytes counted together, and bytes hashed for that, and scored, side by side; steps of a text between new weights.
CHUNK, SIDE = 3 << 19, 1 << 18
#: Bytes whose contexts are made at a time: what that needs stays in a processor's cache.
PART = 1 << 15
STEPS = [*[128] * 4, *[256] * 4, *[512] * 4, *[1024] * 4]
LAST_STEP = 4096
#: Log-odds are kept as whole numbers of 1 / SCALE.
SCALE = 14.0
#: Bytes of text for each bucket of words.
WORD_BUCKET = 40 << 20

_OTHER = np.ones(256, np.int64)
_OTHER[[*range(97, 123), *range(128, 255)]] = 0  # letters

@dataclass
class Trees:
    """For (last byte, byte): number of decisions, and of each the node (as a multiple
    that spreads over 32 bits) and its outcome."""
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    def __post_init__(self):
        # the outcomes as one number, the first in its highest bit
        high = np.uint32(1) << np.arange(31, 31 - len(self.bit), -1, dtype=np.uint32)  # depths are bounded, see ``trees``
        self.route = (self.bit.T * high).sum(1, dtype=np.uint32)

    def levels(self, length: np.ndarray) -> list[tuple[int, int]]:
        """For symbols with so many decisions, falling: how many of them have a decision at each
        level, and how many decisions there are before it, level after level."""
        deep = int(length[0]) if len(length) else 0
        there = np.searchsorted(-length, -np.arange(deep), side="left")
        return list(zip(there.tolist(), (np.cumsum(there) - there).tolist()))

    def common(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many first decisions two bytes after the same byte share; 127 for the same byte."""
        apart = self.route.take(one) ^ self.route.take(other)
        highest = (apart.astype(np.float64).view(np.int64) >> 52) - 1023  # the exponent of a double
        return np.where(apart == 0, 127, 31 - highest).astype(np.int8)


def trees(pairs: np.ndarray) -> Trees:
    """Huffman trees from counts (256, 256) of pairs of bytes."""
    codes: list[list[list[tuple[int, int]]]] = []
    for last in range(256):
        # no count is below a 2^-16 share, which bounds the depth
        least = max(1, int(pairs[last].sum()) >> 16)
        heap = [(int(max(c, least)), s, [s]) for s, c in enumerate(pairs[last])]
        heapq.heapify(heap)
        code: list[list[tuple[int, int]]] = [[] for _ in range(256)]
        node = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for bit, side in ((0, a), (1, b)):
                for s in side[2]:
                    code[s].append((node, bit))
            heapq.heappush(heap, (a[0] + b[0], 256 + node, a[2] + b[2]))
            node += 1
        codes.append([c[::-1] for c in code])
    length = np.array([len(c) for row in codes for c in row], np.int64)
    deep = int(length.max())
    node, bit = np.zeros((deep, 65536), np.uint32), np.zeros((deep, 65536), np.int8)
    for i, c in enumerate(x for row in codes for x in row):
        for d, (n, b) in enumerate(c):
            node[d, i], bit[d, i] = n, b
    return Trees(length, node * np.uint32(0x9E3779B1), bit)


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, each after zeros and before its end mark; first place and number of symbols."""
    gap = bytes(HISTORY)
    raw = np.frombuffer(b"".join([gap + t + b"\xff" for t in texts]).lower(), np.uint8)  # A-Z only
    size = np.array([len(t) + 1 for t in texts], np.int64)
    return raw, np.cumsum(size + HISTORY) - size, size


def _places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _in_order(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Places by ``first``, and where that is equal by the high bits of ``then`` (32 bits), as many as one number has room for."""
    places = np.uint64(max(1, int(len(first) - 1).bit_length()))
    free = np.uint64(64 - int(first.max(initial=0)).bit_length())
    key = then.astype(np.uint64)
    key <<= np.uint64(32)
    key >>= np.uint64(64) - free
    key >>= places
    key <<= places
    key |= first.view(np.uint64) << free
    key |= np.arange(len(first), dtype=np.uint64)
    key.sort()
    key &= (np.uint64(1) << places) - np.uint64(1)
    return key.view(np.int64)


def _eight(raw: np.ndarray, kind: str) -> np.ndarray:
    """The eight bytes before each place from ``HISTORY`` on as one number."""
    return np.ndarray(len(raw) - HISTORY, kind, raw, strides=(1,)).astype(np.uint64)


def _hash(context: np.ndarray) -> np.ndarray:
    context *= np.uint64(0x9E3779B97F4A7C15)
    context >>= np.uint64(32)
    return context


def _short(before: np.ndarray, size: int) -> np.ndarray:
    """Hash of the last ``size`` (3 or 5) of the bytes ``before``."""
    context = before & np.uint64((1 << 8 * size) - 1)
    context += np.uint64(1 << (50 if size == 3 else 51))
    return _hash(context)


def _word(raw: np.ndarray) -> np.ndarray:
    """Hash of the word so far and the byte before it, at each place from ``HISTORY`` on."""
    begin = np.arange(1, len(raw) + 1)
    begin *= _OTHER.take(raw)
    start = np.maximum.accumulate(begin, out=begin)[HISTORY - 1:-1]  # after the last other byte
    context = spans_to(running(raw), start, HISTORY)
    context += raw.take(start - 1)
    return _hash(context)


def _contexts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes (PREDICTORS, len(at)) of what comes before each place."""
    before = _eight(raw, ">u8")
    out = np.empty((PREDICTORS, len(before)), np.uint32)
    out[0], out[1], out[2] = _short(before, 3), _short(before, 5), _word(raw)
    return out.take(at - HISTORY, 1)


def slot_bits(size: int) -> int:
    """Bits of a slot for ``size`` bytes of training text."""
    return min(MOST_BITS, max(SLOT_BITS, (size // SLOT_BYTES).bit_length()))


def _slots(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """``node`` comes multiplied (see ``Trees``)."""
    mixed = context + node
    mixed *= SPREAD
    mixed >>= np.uint32(32 - bits)
    return mixed


def count_pairs(texts: list[bytes]) -> np.ndarray:
    raw, first, size = _laid_out(texts)
    return np.bincount(_codes(raw).take(_places(first, size)), minlength=65536)


def count_decisions(texts: list[bytes], tree: Trees, total: np.ndarray) -> None:
    """Adds to ``total`` (PREDICTORS, 2 * slots): decisions by slot and outcome."""
    for k, symbols in enumerate(_predicted(*map(_symbols, decisions(texts)))):
        counts = _decided(symbols, tree, total.shape[1].bit_length() - 2)
        total[k][(counts >> np.uint64(32)).astype(np.int64)] += (counts & np.uint64(0xFFFFFFFF)).astype(np.int64)


def decisions(texts: list[bytes]) -> np.ndarray:
    """(2, symbols): what all decisions of a symbol follow from, the five bytes before it and itself; the context of
    its word and, below, its byte and the one before."""
    out = []
    for part in _runs(texts, PART):
        raw, first, size = _laid_out(part)
        at = _places(first, size)
        found = np.empty((2, len(at)), np.uint64)
        grams, words = found
        _eight(raw, ">u8").take(at - HISTORY, out=grams)
        grams &= np.uint64((1 << 40) - 1)
        grams <<= np.uint64(8)
        grams |= raw.take(at)
        _word(raw).take(at - HISTORY, out=words)
        words <<= np.uint64(16)
        words |= _codes(raw).take(at)
        out.append(found)
    return np.concatenate(out, 1) if out else np.empty((2, 0), np.uint64)


def _predicted(grams: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """Counted symbols of each predictor (its context, the byte before, the byte, how often), of those of ``decisions``:
    what follows three bytes is added up from what follows five."""
    out = []
    for size in (3, 5):
        last = grams if size == 5 else _symbols(grams & np.uint64((1 << 48) - 1), counted=True)
        symbols = _short(last >> np.uint64(24), size)
        symbols <<= np.uint64(32)
        symbols |= last & np.uint64(0xFFFFFFFF)
        out.append(symbols)
    return [*out, words]


def _read(texts: list[bytes], tree: Trees) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all symbols of the texts (last byte, byte), the level up to which the byte pointed to agrees with what is known
    of the byte (where they part; -1 without such a byte) and the contexts; how many each text has."""
    out = []
    for part in _runs(texts, PART):
        raw, first, size = _laid_out(part)
        at = _places(first, size)
        code = _codes(raw).take(at)
        guess = _pointed(raw, at, np.repeat(np.arange(len(part)), size))
        agreed = tree.common(code, (code & np.uint16(0xFF00)) | np.maximum(guess, 0).view(np.uint16))
        agreed[guess < 0] = -1
        out.append((code, agreed, _contexts(raw, at), size))
    return tuple(np.concatenate(x, -1) for x in zip(*out))


def _codes(raw: np.ndarray) -> np.ndarray:
    """(last byte, byte) of each place but the first."""
    code = raw.astype(np.uint16)
    code[1:] |= code[:-1] << np.uint16(8)
    return code


def _symbols(found: np.ndarray, counted: bool = False, kind: str | None = None) -> np.ndarray:
    """Sorted symbols (see ``decisions``), each once with how often it is there in the low 16 bits;
    once more for every ``MANY`` times.  ``counted``: they come with such counts.  ``kind``: how to sort them."""
    if not len(found):
        return found
    found.sort(kind=kind)
    code = found >> np.uint64(16) if counted else found
    last = np.append(np.flatnonzero(code[1:] != code[:-1]), len(code) - 1)
    code = code.take(last)
    if counted:
        found &= np.uint64(MANY)
        last = np.cumsum(found, out=found).take(last).view(np.int64) - 1
    times = np.diff(last, prepend=-1)
    if len(times) and times.max() > MANY:
        more = (times - 1) // MANY
        code, times = np.append(code, np.repeat(code, more)), np.append(times - more * MANY, np.full(more.sum(), MANY))
    return code << np.uint64(16) | times.astype(np.uint64)


def _decided(symbols: np.ndarray, tree: Trees, bits: int) -> np.ndarray:
    """Counted decisions (see ``_added``), as 2 * slot + outcome, of counted symbols."""
    if not len(symbols):
        return symbols
    code = (symbols >> np.uint64(16)).astype(np.uint16)
    length = tree.length.take(code)
    order = np.argsort((-length).astype(np.int8), kind="stable")
    code, length, symbols = code[order].astype(np.int64), length[order], symbols[order]
    context, times = (symbols >> np.uint64(32)).astype(np.uint32), symbols & np.uint64(MANY)
    out = np.empty(int(length.sum()), np.uint64)
    for d, (k, before) in enumerate(tree.levels(length)):
        found = _slots(context[:k], tree.node[d].take(code[:k]), bits).astype(np.uint64)
        found <<= np.uint64(1)
        found |= tree.bit[d].take(code[:k]).view(np.uint8)
        found <<= np.uint64(32)
        np.add(found, times[:k], out=out[before:before + k])
    return _added([out])


def _added(runs: list[np.ndarray]) -> np.ndarray:
    """Counts (the decision in the high 32 bits, how often in the low ones), sorted and added up; several runs
    come sorted.  A task sends far fewer than 2^32 decisions."""
    packed = np.concatenate(runs)
    packed.sort(kind="stable" if len(runs) > 1 else None)  # "stable" merges sorted runs
    code = packed >> np.uint64(32)
    last = np.append(np.flatnonzero(code[1:] != code[:-1]), len(code) - 1)
    code = code.take(last)
    code <<= np.uint64(32)
    packed &= np.uint64(0xFFFFFFFF)
    code |= np.diff(np.cumsum(packed, out=packed).take(last), prepend=np.uint64(0))
    return code


def _hold(runs: list[np.ndarray], new: np.ndarray, added=_added) -> None:
    """Adds a run of counts to those held; a run is added to the one before once it is half as long."""
    runs.append(new)
    while len(runs) > 1 and len(runs[-2]) < 2 * len(runs[-1]):
        runs[-2:] = [added(runs[-2:])]


def _added_symbols(runs: list[np.ndarray]) -> np.ndarray:
    return _symbols(np.concatenate(runs), counted=True, kind="stable")  # merges sorted runs


def _counted(found: np.ndarray) -> np.ndarray:
    found = np.sort(found)
    first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    return (found[first].astype(np.uint64) << np.uint64(32)) | np.diff(np.r_[first, len(found)]).astype(np.uint64)


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Counts by slot and outcome -> int16: log-odds of the outcome 1 in the high byte,
    a class of the count in the low one."""
    zero, one = counts[..., 0::2], counts[..., 1::2]
    odds = np.clip(np.rint(np.log((one + 0.4) / (zero + 0.4)) * SCALE), -127, 127).astype(np.int16)
    return (odds << 8) | np.searchsorted([1, 3, 12], zero + one, side="right").astype(np.int16)


def _pointed(raw: np.ndarray, at: np.ndarray, who: np.ndarray) -> np.ndarray:
    """For each place the byte after the last earlier stand of the same six bytes in
    the same text, or -1."""
    key = _eight(raw, "<u8").take(at - HISTORY)
    key >>= np.uint64(16)
    places = np.uint64(max(1, int(len(at) - 1).bit_length()))
    hashed = (key + (who.astype(np.uint64) << np.uint64(48))) * np.uint64(0x9E3779B97F4A7C15)
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    packed = np.sort(((hashed >> places) << places) | np.arange(len(at), dtype=np.uint64))
    nth = (packed & ((np.uint64(1) << places) - np.uint64(1))).astype(np.int64)
    same = (packed[1:] >> places) == (packed[:-1] >> places)
    again = np.flatnonzero(same)
    out = np.full(len(at), -1, np.int16)
    out[nth.take(again + 1)] = raw.take(at.take(nth.take(again)))
    return out


@dataclass
class MixModel:
    tree: Trees
    tables: np.ndarray  # (PREDICTORS, slots) int16, see ``log_odds``
    weights: np.ndarray  # (INPUTS, GATES)

    def costs(self, texts: list[bytes], keep: bool = False) -> np.ndarray:
        """Cost of each text in bits.  ``keep``: the first weights follow the mean of
        what the texts end with."""
        out = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        group, held = [], 0
        for i in order:
            if group and held + len(texts[i]) > SIDE:
                out[group] = self._side_by_side([texts[j] for j in group], keep)
                group, held = [], 0
            group.append(i)
            held += len(texts[i]) + HISTORY
        if group:
            out[group] = self._side_by_side([texts[j] for j in group], keep)
        return out

    def _side_by_side(self, texts: list[bytes], keep: bool) -> np.ndarray:
        """Texts from long to short."""
        n = len(texts)
        code, agreed, contexts, size = _read(texts, self.tree)
        who = np.repeat(np.arange(n), size)
        length = self.tree.length.take(code)
        # step after step, and in a step the symbols with most decisions first, those of one context side by side: they
        # look up the same places, and are of several texts (sums of one text wait for each other)
        steps = np.append(np.repeat(np.arange(len(STEPS)), STEPS), np.arange(len(STEPS), len(STEPS) + size[0] // LAST_STEP + 1).repeat(LAST_STEP))
        step = np.concatenate([steps[:k] for k in size])
        order = _in_order((step << 5) + (31 - length), contexts[1])
        bounds = np.cumsum(np.bincount(step)).tolist()
        code, agreed, length, who = code.take(order).astype(np.int64), agreed.take(order), length.take(order), who.take(order)
        contexts = contexts.take(order, 1)
        weights = np.repeat(self.weights[:, None, :], n, 1).reshape(INPUTS, n * GATES).astype(np.float32)
        cost = np.zeros(len(code))
        for lo, hi in zip([0, *bounds], bounds):
            here = slice(lo, hi)
            cost[here] = self._step(code[here], agreed[here], length[here], contexts[:, here], who[here], weights)
        if keep:
            self.weights = weights.reshape(INPUTS, n, GATES).mean(1)
        return np.bincount(who, weights=cost, minlength=n)

    def _step(self, code, agreed, length, contexts, who, weights) -> np.ndarray:
        """Cost in bits of each symbol of a step.  Those with most decisions come first, and all decisions
        are made together, level after level."""
        levels, count = self.tree.levels(length), int(length.sum())
        slots, g = np.empty((PREDICTORS, count), np.uint32), np.empty(count, np.int64)
        bit, follows, says = (np.empty(count, np.float32), *np.empty((2, count), np.int8))
        whose = who * GATES
        for d, (k, before) in enumerate(levels):
            at = slice(before, before + k)
            np.add(contexts[:, :k], self.tree.node[d].take(code[:k], mode="clip"), out=slots[:, at])
            one = self.tree.bit[d].take(code[:k], mode="clip")
            bit[at] = one
            np.less_equal(d, agreed[:k], out=follows[at].view(bool))
            np.bitwise_xor(one, (agreed[:k] == d).view(np.int8), out=says[at])
            g[at] = whose[:k]
        slots *= SPREAD  # as in ``_slots``
        slots >>= np.uint32(32 - (self.tables.shape[1].bit_length() - 1))
        looked = [self.tables[k].take(slots[k], mode="clip") for k in range(PREDICTORS)]  # no place is outside: "clip" is faster
        gate = looked[-2] & np.int16(3)
        gate *= np.int16(SEEN)
        gate += looked[-1] & np.int16(3)
        gate *= np.int16(2)
        gate += follows
        g += gate
        inputs = [np.right_shift(x, 8, out=x).astype(np.float32) for x in looked]
        for x in inputs:
            x *= np.float32(1 / SCALE)
        says += says
        says -= np.int8(1)
        says *= follows
        inputs.append(says * (np.float32(2 * SCALE) * np.float32(1 / SCALE)))
        total = weights[INPUTS - 1].take(g, mode="clip")
        for k in range(INPUTS - 1):
            part = weights[k].take(g, mode="clip")
            part *= inputs[k]
            total += part
        np.clip(total, -14, 14, out=total)
        np.negative(total, out=total)
        np.exp(total, out=total)
        total += 1
        np.reciprocal(total, out=total)  # the probability of the outcome 1
        error = np.subtract(bit, total, out=bit)
        np.abs(error, out=total)
        np.subtract(1, total, out=total)  # the probability of what came
        np.log2(total, out=total)
        cost = np.zeros(len(code))
        for k, before in levels:
            cost[:k] -= total[before:before + k]
        gates = (int(who.max()) + 1) * GATES
        sums, change = np.empty((INPUTS, gates)), np.empty(count)
        for k in range(INPUTS - 1):
            sums[k] = np.bincount(g, weights=np.multiply(inputs[k], error, out=change), minlength=gates)
        sums[-1] = np.bincount(g, weights=error, minlength=gates)
        seen = np.bincount(g, minlength=gates)
        share = RATE * np.minimum(1, MOST / np.maximum(seen, 1))
        weights[:, :gates] += sums * share
        return cost


def first_weights() -> np.ndarray:
    w = np.full((INPUTS, GATES), 0.4)
    w[INPUTS - 1] = 0
    return w


# --- Spark passes -----------------------------------------------------------------

def _texts(column) -> list[bytes]:
    return [(t or "").encode() for t in column]


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[list[bytes]]:
    return _runs(((t or "").encode() for batch in batches for t in batch["_t"]), CHUNK)


def _runs(texts: Iterable[bytes], most: int) -> Iterator[list[bytes]]:
    """Lists of texts, each ending with the text that reaches so many bytes."""
    chunk, held = [], 0
    for t in texts:
        chunk.append(t)
        held += len(t)
        if held >= most:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def _pass_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keep_freed()
    total, size = np.zeros(65536, np.int64), 0
    for chunk in _chunks(batches):
        total += count_pairs(chunk)
        size += sum(map(len, chunk))
    yield pd.DataFrame({"part": [0], "size": [size], "data": [zstandard.compress(total.tobytes(), 1)]})
    give_back()


def _pass_decisions(tree, bits: int):
    ranges = 1 << max(0, bits - RANGE_BITS)
    shift = np.uint64(32 + bits + 1 - (ranges.bit_length() - 1))

    def frame(held) -> pd.DataFrame:
        parts, data = [], []
        for k, counts in enumerate(held):
            cut = np.searchsorted(counts >> shift, np.arange(ranges + 1, dtype=np.uint64))
            for r in np.flatnonzero(np.diff(cut)):
                part = counts[cut[r]:cut[r + 1]]
                code = (part >> np.uint64(32)).astype(np.uint32)
                parts.append(k * ranges + int(r))
                data.append(zstandard.compress(pickle.dumps((code[0], np.diff(code), part.astype(np.uint32)), protocol=5), 1))
        return pd.DataFrame({"part": parts, "size": 0, "data": data})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_freed()
        t = pickle.loads(tree.value)
        made: list[list[np.ndarray]] = [[], []]  # symbols, see ``decisions``
        held: list[list[np.ndarray]] = [[] for _ in range(PREDICTORS)]  # their decisions

        def decide() -> None:
            if made[0]:
                whole = [runs[0] if len(runs) == 1 else _added_symbols(runs) for runs in made]
                for runs in made:
                    runs.clear()
                for k, symbols in enumerate(_predicted(*whole)):
                    _hold(held[k], _decided(symbols, t, bits))

        for chunk in _chunks(batches):
            # what the hashes need is several times the text, so they are made of a part at a time
            found = [decisions(part) for part in _runs(chunk, SIDE)]
            for k in range(len(made)):
                _hold(made[k], _symbols(np.concatenate([x[k] for x in found])), _added_symbols)
            del found
            if sum(len(x) for runs in made for x in runs) > HELD // 4:
                decide()
            if sum(len(x) for runs in held for x in runs) > HELD:
                held = [[_added(runs)] for runs in held]
                if sum(len(x[0]) for x in held) > HELD // 2:
                    yield frame([x[0] for x in held])
                    held = [[] for _ in range(PREDICTORS)]
        decide()
        if held[0]:
            yield frame([_added(runs) for runs in held])
        held.clear()
        give_back()
    return run


def _merged_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, size, any_ = np.zeros(65536, np.int64), 0, False
    for batch in batches:
        for more, data in zip(batch["size"], batch["data"]):
            total, size, any_ = total + np.frombuffer(zstandard.decompress(data), np.int64), size + more, True
    if any_:
        yield pd.DataFrame({"part": [0], "size": [size], "data": [total.tobytes()]})


def _merged_decisions(bits: int):
    """Adds counts range by range; a task holds one sum for each of its ranges."""
    each = 2 << min(bits, RANGE_BITS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch["part"], batch["data"]):
                first, step, counts = pickle.loads(zstandard.decompress(data))
                code = np.cumsum(np.r_[np.int64(first), step.astype(np.int64)])
                if part not in total:
                    total[part] = np.zeros(each, np.int64)
                total[part][code & (each - 1)] += counts  # a decision is there once
        for part, counts in total.items():
            yield pd.DataFrame({"part": [part], "size": [0], "data": [log_odds(counts).tobytes()]})
        total.clear()
        give_back()
    return run


_TABLE = "part int, size long, data binary"


def train(docs: DataFrame, *, key="doc_id", text="text", weight_texts: int = WEIGHT_TEXTS) -> tuple[MixModel, int]:
    """The model learned from all rows of ``docs``, and their bytes."""
    spark = docs.sparkSession
    source = docs.select(F.xxhash64(F.lit(5), key, text).alias("_h"), F.col(text).alias("_t"))
    wanted = max(weight_texts, source.count() // WEIGHT_EACH)
    sample = source.orderBy("_h").limit(wanted).collect()
    aside = max((r["_h"] for r in sample), default=0)
    pairs = source.select("_t").mapInPandas(_pass_pairs, _TABLE).repartition("part").mapInPandas(_merged_pairs, _TABLE).collect()
    total = np.frombuffer(pairs[0]["data"], np.int64) if pairs else np.zeros(65536, np.int64)
    tree = trees(total.reshape(256, 256))
    shared = spark.sparkContext.broadcast(pickle.dumps(tree))
    # with fewer texts than the sample they serve for both
    rest = source.where(F.col("_h") > aside) if len(sample) == wanted else source
    bits = slot_bits(pairs[0]["size"] if pairs else 0)
    rows = stored(rest.select("_t").mapInPandas(_pass_decisions(shared, bits), _TABLE).repartition("part")
                  .mapInPandas(_merged_decisions(bits), _TABLE), "tables").toLocalIterator()
    tables = np.zeros((PREDICTORS, 1 << bits), np.int16)  # grows with the text, 2 bytes a slot
    for r in rows:
        found = np.frombuffer(r["data"], np.int16)
        tables.reshape(-1)[r["part"] * len(found):][:len(found)] = found
    model = MixModel(tree, tables, first_weights())
    texts = _texts([r["_t"] for r in sample])
    for lo in range(0, len(texts), 32):
        model.costs(texts[lo:lo + 32], keep=True)
    return model, pairs[0]["size"] if pairs else 0


def bits(docs: DataFrame, model: MixModel, *, text="text"):
    """A column with the cost in bits of the text column under the model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def cost(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keep_freed()
        m = shared.value
        for batch in batches:
            yield pd.Series(m.costs(_texts(batch)))
        give_back()

    return cost(F.col(text))


# --- words ------------------------------------------------------------------------

#: Documents whose words are sent together and whose answers meet again.
TOGETHER = 2048


def _send_words(buckets: int):
    """For each bucket of words: distinct words of some documents with their training count, and
    which documents hold them how often.  ``home`` names the documents that were sent together; one
    message of each home (``own``, in any bucket) holds their keys and numbers of words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_freed()
        for whole in batches:
            for lo in range(0, len(whole), TOGETHER):
                batch = whole.iloc[lo:lo + TOGETHER]
                words = batch_word_hashes(_texts(batch["_t"]))
                keys, learned = batch[["_k", "_k2"]].to_numpy(np.int64), batch["_learn"].to_numpy(bool)
                size = np.array([len(w) for w in words])
                # all keys of the rows, in order, and their place: no two groups of rows have one name
                home = int(mix(keys.reshape(-1).view(np.uint64) + np.arange(2 * len(keys), dtype=np.uint64)).sum(dtype=np.uint64).view(np.int64))
                rows = [(home % buckets, home, True, pickle.dumps((keys, size)))]
                h = np.concatenate(words)
                if len(h):
                    rows += [(b, home, False, data) for b, data in _packed_words(h, np.repeat(np.arange(len(words)), size), learned, buckets)]
                yield pd.DataFrame(rows, columns=["bucket", "home", "own", "data"])
        give_back()
    return run


def _packed_words(h, doc, learned, buckets):
    order = np.argsort(h)
    ranked = h[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    names = ranked[new]
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    pairs, times = np.unique(doc * len(names) + which, return_counts=True)
    doc, which = np.divmod(pairs, len(names))
    count = np.bincount(which, weights=times * learned[doc], minlength=len(names)).astype(np.int64)
    # names and pairs by bucket; 16-bit keys sort in linear time
    bucket = (((names & np.uint64(0xFFFF)).astype(np.int64) * buckets) >> 16).astype(np.uint16)
    by_name = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[by_name], np.arange(buckets + 1))
    local = np.empty(len(names), np.int64)
    local[by_name] = np.arange(len(names)) - cut[:-1][bucket[by_name]]
    of_pair = bucket[which]
    by_pair = np.argsort(of_pair, kind="stable")
    cut_pair = np.searchsorted(of_pair[by_pair], np.arange(buckets + 1))
    out = []
    for b in range(buckets):
        n, p = by_name[cut[b]:cut[b + 1]], by_pair[cut_pair[b]:cut_pair[b + 1]]
        if len(p):
            data = (names[n], count[n].astype(np.uint32), np.diff(local[which[p]], prepend=0).astype(np.int32),
                    np.diff(doc[p], prepend=0).astype(np.uint16), times[p].astype(np.uint32))
            out.append((b, zstandard.compress(pickle.dumps(data, protocol=5), 1)))
    return out


_ANSWER = ["all", "home", "own", "known", "words", "data"]


def _sum_words(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket: one answer for each message, with the sum of log10(c + 1) and the known words of its
    documents; and one row (``all``) with the bucket's training words and distinct training words."""
    own = rows["own"].to_numpy(bool)
    through = [(False, home, True, 0, 0, data) for home, data in zip(rows["home"][own], rows["data"][own])]
    rows = rows[~own]
    if not len(rows):
        return pd.DataFrame(through, columns=_ANSWER)
    sent = [pickle.loads(zstandard.decompress(x)) for x in rows["data"]]
    names, at = np.unique(np.concatenate([x[0] for x in sent]), return_inverse=True)
    count = np.bincount(at, weights=np.concatenate([x[1] for x in sent]), minlength=len(names)).astype(np.int64)
    logs = np.log10(count + 1.0)
    out, lo = [], 0
    for own, _, which, step, times in sent:
        place = at[lo:lo + len(own)][np.cumsum(which.astype(np.int64))]
        lo += len(own)
        doc = np.cumsum(step.astype(np.int64))
        some = np.flatnonzero(np.bincount(doc))
        out.append(zstandard.compress(pickle.dumps((
            some.astype(np.uint16), np.bincount(doc, weights=times * logs[place])[some],
            np.bincount(doc, weights=times * (count[place] > 0))[some].astype(np.uint32)), protocol=5), 1))
    return pd.DataFrame([*through, *((False, home, False, 0, 0, data) for home, data in zip(rows["home"], out)),
                         (True, 0, False, int((count > 0).sum()), int(count.sum()), None)], columns=_ANSWER)


def _answers(rows: pd.DataFrame) -> pd.DataFrame:
    """Documents that were sent together: what all buckets have answered, added up by place."""
    first = [pickle.loads(x) for x, own in zip(rows["data"], rows["own"]) if own]
    keys, size = first[0]
    logs, known = np.zeros(len(keys)), np.zeros(len(keys), np.int64)
    for data, own in zip(rows["data"], rows["own"]):
        if not own:
            at, some, words = pickle.loads(zstandard.decompress(data))
            logs[at] += some
            known[at] += words
    # the same rows sent several times have the same name, and as many times the answers
    return pd.DataFrame({"_k": keys[:, 0], "_k2": keys[:, 1], "logs": logs / len(first), "known": known // len(first), "n": size})


def word_scores(docs: DataFrame, learn, total_bytes: int, *, key="doc_id", text="text") -> DataFrame:
    """Add-one word model: for each row ``_k`` (a hash of id and text) n_tokens, n_known,
    train_tokens and base_score.  Tokens are words in small letters and one end."""
    one, two = _keys(key, text)
    source = docs.select(one.alias("_k"), two.alias("_k2"), F.coalesce(learn, F.lit(False)).alias("_learn"), F.col(text).alias("_t"))
    sent = source.mapInPandas(_send_words(pieces(total_bytes, WORD_BUCKET)), "bucket int, home long, own boolean, data binary")
    parts = stored(sent.groupBy("bucket").applyInPandas(
        _sum_words, "all boolean, home long, own boolean, known long, words long, data binary"), "words")
    totals = parts.where("all").agg(F.sum("known").alias("v"), F.sum("words").alias("n")).first()
    ends = source.where("_learn").count()
    v, n = (totals["v"] or 0) + (ends > 0), (totals["n"] or 0) + ends
    floor = float(np.log10(n + v + 1))
    told = parts.where("not all").select("home", "own", "data")
    each = told.groupBy("home").applyInPandas(_answers, "_k long, _k2 long, logs double, known long, n long")
    # rows that repeat id and text have the same answer
    per = each.groupBy("_k", "_k2").agg(F.max("logs").alias("logs"), F.max("known").alias("known"), F.max("n").alias("n"))
    tokens = F.col("n") + 1
    return per.select(
        "_k", "_k2", tokens.alias("n_tokens"), (F.col("known") + int(ends > 0)).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("logs") + float(np.log10(ends + 1)) - tokens * floor).alias("base_score"))


def _keys(key: str, text: str) -> tuple[Column, Column]:
    """Two hashes of a row, which together tell any number of rows apart."""
    return F.xxhash64(key, text), F.xxhash64(F.lit(2), key, text)


def score(docs: DataFrame, learn, *, key="doc_id", text="text") -> DataFrame:
    """For every row: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10
    of the text's probability) and bits_per_byte; learned from rows where ``learn`` holds."""
    learn = F.coalesce(learn, F.lit(False))
    model, size = train(docs.where(learn), key=key, text=text)
    words = word_scores(docs, learn, 2 * size, key=key, text=text)
    one, two = _keys(key, text)
    rows = docs.select(F.col(key).alias("_id"), one.alias("_k"), two.alias("_k2"), (~learn).alias("held_out"),
                       F.octet_length(F.coalesce(F.col(text), F.lit(""))).alias("_size"), bits(docs, model, text=text).alias("_bits"))
    return rows.join(words, ["_k", "_k2"]).select(
        F.col("_id").alias(key), "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
        (-F.col("_bits") * float(np.log10(2))).alias("score"), (F.col("_bits") / F.greatest("_size", F.lit(1))).alias("bits_per_byte"))
