"""Language of texts by a bidirectional gated recurrent network over bytes.

A forward and a backward recurrent layer with update and reset gates read the
UTF-8 bytes of a text in stretches of ``STRETCH`` bytes; every position gets a
probability for each language, and the document's probabilities are the mean over
all its positions (whole texts, however long).  The network is trained in numpy by
backpropagation through time on a bounded sample of labelled texts.

Defined results: ``und`` with score 0 for null texts and texts without a letter;
rows with equal texts have equal results; rows with a null language are not
learned from; without any labelled text every answer is ``und``.  Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import give_back

UNKNOWN = "und"
HIDDEN = 8
STRETCH = 128
#: Stretches that run side by side.
LANES = 1024
#: Labelled texts read per language, and stretches of each used in training.
PER_LANGUAGE = 400
STEPS, BATCH, TRAIN_STRETCH = 400, 128, 48
_TYPE = np.float32


@dataclass
class LanguageModel:
    languages: list[str]
    #: per direction: byte -> gate inputs (256, 3H); state -> gates (H, 3H); state -> languages (H, L)
    inputs: list[np.ndarray] = field(default_factory=list)
    states: list[np.ndarray] = field(default_factory=list)
    outputs: list[np.ndarray] = field(default_factory=list)
    bias: np.ndarray | None = None

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, *self.outputs, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def new_model(languages: list[str], seed: int = 7, hidden: int = HIDDEN) -> LanguageModel:
    rng, n = np.random.default_rng(seed), len(languages)
    normal = lambda *shape, by: (rng.standard_normal(shape) * by).astype(_TYPE)
    return LanguageModel(languages, [normal(256, 3 * hidden, by=0.3) for _ in range(2)],
                         [normal(hidden, 3 * hidden, by=hidden ** -0.5) for _ in range(2)],
                         [normal(hidden, n, by=hidden ** -0.5) for _ in range(2)], np.zeros(n, _TYPE))


def gradients(m: LanguageModel, text: np.ndarray, answer: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions of ``text`` (B, T) bytes, and its gradients by
    backpropagation through time, in the order of ``parameters()``."""
    b, t = text.shape
    h = m.states[0].shape[0]
    runs, logits = [], np.broadcast_to(m.bias, (t, b, len(m.bias))).copy()
    for d in range(2):
        order = range(t) if d == 0 else range(t - 1, -1, -1)
        state, kept = np.zeros((b, h), _TYPE), {}
        for i in order:
            x = m.inputs[d][text[:, i]]
            zr = _sigmoid(x[:, :2 * h] + state @ m.states[d][:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            u = state @ m.states[d][:, 2 * h:]
            n = np.tanh(x[:, 2 * h:] + r * u)
            after = n + z * (state - n)
            kept[i] = (state, z, r, u, n, after)
            state = after
            logits[i] += after @ m.outputs[d]
        runs.append((order, kept))
    p = _softmax(logits)
    rows = np.arange(b)
    loss = -float(np.log(p[:, rows, answer] + 1e-9).mean())
    p[:, rows, answer] -= 1
    p /= b * t
    grads = [np.zeros_like(x) for x in m.parameters()]
    grads[6] += p.sum((0, 1))
    for d, (order, kept) in enumerate(runs):
        g_in, g_state, g_out = grads[d], grads[2 + d], grads[4 + d]
        back = np.zeros((b, h), _TYPE)
        for i in reversed(order):
            before, z, r, u, n, after = kept[i]
            g_out += after.T @ p[i]
            dh = back + p[i] @ m.outputs[d].T
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * u * r * (1 - r)
            du = dn * r
            gates = np.concatenate([dz, dr, du], 1)
            g_state += before.T @ gates
            np.add.at(g_in, text[:, i], np.concatenate([dz, dr, dn], 1))
            back = dh * z + gates @ m.states[d].T
    return loss, grads


def train(texts: list[bytes], answers: list[str], *, seed: int = 7, steps: int = STEPS) -> LanguageModel:
    """Adam on stretches drawn evenly over languages."""
    languages = sorted(set(answers))
    m = new_model(languages, seed)
    if not languages:
        return m
    rng = np.random.default_rng(seed + 1)
    by = [[np.frombuffer(t, np.uint8) for t, a in zip(texts, answers) if a == k and len(t)] for k in languages]
    usable = [k for k, x in enumerate(by) if x]
    if not usable:
        return m
    first = [np.zeros_like(x) for x in m.parameters()]
    second = [np.zeros_like(x) for x in m.parameters()]
    for step in range(1, steps + 1):
        batch, answer = np.full((BATCH, TRAIN_STRETCH), 32, np.uint8), np.empty(BATCH, np.int64)
        for i in range(BATCH):
            k = usable[rng.integers(len(usable))]
            t = by[k][rng.integers(len(by[k]))]
            at = rng.integers(max(1, len(t) - TRAIN_STRETCH + 1))
            part = t[at:at + TRAIN_STRETCH]
            batch[i, :len(part)], answer[i] = part, k
        _, grads = gradients(m, batch, answer)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * min(1, 2 * (1 - step / (steps + 1)))
        for x, g, a, v in zip(m.parameters(), grads, first, second):
            g = g * min(1, 1 / (norm + 1e-9))
            a += 0.1 * (g - a)
            v += 0.01 * (g * g - v)
            x -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return m


def document_probabilities(m: LanguageModel, texts: list[bytes]) -> np.ndarray:
    """Mean over all positions of each text's language probabilities, (n, L)."""
    n_lang, h = len(m.languages), m.states[0].shape[0]
    total = np.zeros((len(texts), n_lang))
    size = np.array([len(t) for t in texts], np.int64)
    if not len(texts) or not size.sum() or not n_lang:
        return total
    everything = np.frombuffer(b"".join(texts), np.uint8)
    start_of = np.cumsum(size) - size
    count = -(-size // STRETCH)
    owner = np.repeat(np.arange(len(texts)), count)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * STRETCH
    start, length = start_of[owner] + offset, np.minimum(STRETCH, size[owner] - offset)
    by_length = np.argsort(-length, kind="stable")
    for lo in range(0, len(by_length), LANES):
        lanes = by_length[lo:lo + LANES]
        total_of = _lane_sums(m, everything, start[lanes], length[lanes], h)
        np.add.at(total, owner[lanes], total_of)
    return total / np.maximum(size, 1)[:, None]


def _lane_sums(m: LanguageModel, everything: np.ndarray, start: np.ndarray, length: np.ndarray, h: int) -> np.ndarray:
    """Sums over positions for stretches of falling length.  Arrays hold a lane per
    column, so that the gates are contiguous rows."""
    steps, lanes, n_lang = int(length[0]), len(start), len(m.languages)
    alive = np.searchsorted(-length, -np.arange(steps), side="left")  # lanes longer than i
    logits = np.zeros((2, steps, n_lang, lanes), _TYPE)
    for d in range(2):
        w_in, w_state, w_out = (np.ascontiguousarray(x[d].T) for x in (m.inputs, m.states, m.outputs))
        state = np.zeros((h, lanes), _TYPE)
        for i in range(steps):
            k = alive[i]
            s = state[:, :k]
            x = w_in.take(everything.take(start[:k] + i if d == 0 else start[:k] + length[:k] - (1 + i)), 1)
            u = w_state @ s
            zr = u[:2 * h]
            zr += x[:2 * h]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            n = u[2 * h:]
            n *= zr[h:]
            n += x[2 * h:]
            np.tanh(n, out=n)
            s -= n
            s *= zr[:h]
            s += n
            np.matmul(w_out, s, out=logits[d, i, :, :k])
    out = np.zeros((n_lang, lanes))
    columns = np.arange(lanes)
    for i in range(steps):
        k = alive[i]
        # the backward layer reached position i at its step length - 1 - i
        p = logits[0, i, :, :k] + m.bias[:, None]
        p += logits[1, length[0] - 1 - i, :, :k] if length[k - 1] == length[0] else logits[1, length[:k] - 1 - i, :, columns[:k]].T
        p -= p.max(0)
        np.exp(p, out=p)
        p /= p.sum(0)
        out[:, :k] += p
    return out.T


def fit(docs: DataFrame, *, key="doc_id", text="text", lang="lang", per_language: int = PER_LANGUAGE,
        seed: int = 7) -> LanguageModel:
    """Train on at most ``per_language`` labelled texts of each language, those
    first by a hash of id and text.  Languages are taken from all rows."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(lang).alias("_l"))
    found = sorted(r["_l"] for r in rows.select("_l").distinct().collect())
    # the ids first, so that no text is sorted; then their texts, a bounded number
    order = F.xxhash64("_k", F.lit(seed))
    bound = len(found) * per_language
    ids = None
    for name in found:
        part = rows.where(F.col("_l") == name).select("_k", order.alias("_o")).orderBy("_o", "_k").limit(per_language)
        ids = part if ids is None else ids.unionByName(part)
    if ids is None:
        return train([], [])
    got = (rows.join(F.broadcast(ids.select("_k").distinct()), "_k").select("_t", "_l", order.alias("_o"), "_k")
           .orderBy("_o", "_k", "_l", "_t").limit(bound).collect())
    return train([r["_t"].encode() for r in got], [r["_l"] for r in got], seed=seed)


def predict(docs: DataFrame, model: LanguageModel, *, text="text") -> Column:
    """A column ``struct<lang_pred string, score double>`` for the text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in batches:
            answer, score = np.full(len(batch), len(m.languages)), np.zeros(len(batch))
            if m.languages:
                for lo in range(0, len(batch), 256):
                    p = document_probabilities(m, [(t or "").encode() for t in batch[lo:lo + 256]])
                    best = p.argmax(1)
                    answer[lo:lo + 256], score[lo:lo + 256] = best, p[np.arange(len(p)), best]
            yield pd.DataFrame({"lang_pred": names[answer], "score": np.clip(score, 0, 1)})
        give_back()

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return F.when(has_letter, language(F.col(text))).otherwise(unknown)
