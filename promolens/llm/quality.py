"""Quality score of texts by compression.

Two zstandard dictionaries are trained, one from texts labelled good and one
from texts labelled bad.  A text is cut into pieces of ``PIECE`` bytes (all of
it; nothing is left out), each piece is compressed with either dictionary, and

    x = (bytes with the bad dictionary - bytes with the good one) / bytes of the text

summed over the pieces, is turned into a probability by a logistic curve fitted
on labelled texts that neither dictionary has seen.

Defined results: null and empty texts have x = 0 and so the curve's value there;
rows with equal texts have equal scores; other columns are not read, so their
names cannot clash.  Labels that are null are skipped; a document with several
labels counts once with the smallest.  When a class has no labelled text, every
score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes compressed at a time: short enough that the dictionary, not the text's own past, decides.
PIECE = 512
LEVEL = 3
DICT_BYTES = 32_768
#: Labelled texts read per class: half for the dictionary, half for the curve.
PER_CLASS = 1500


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    scale: float
    shift: float

    def measure(self) -> "_Measure":
        return _Measure(self.good, self.bad)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.scale * x + self.shift, -500, 500)))


class _Measure:
    def __init__(self, good: bytes, bad: bytes):
        def compressor(raw):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False,
                                            write_dict_id=False)
        self._good = compressor(good) if good and bad else None
        self._bad = compressor(bad) if good and bad else None

    def __call__(self, text: str | None) -> float:
        raw = (text or "").encode()
        if not raw or self._good is None:
            return 0.0
        good, bad, diff = self._good.compress, self._bad.compress, 0
        for i in range(0, len(raw), PIECE):
            piece = raw[i:i + PIECE]
            diff += len(bad(piece)) - len(good(piece))
        return diff / len(raw)


def _dictionary(texts: list[str]) -> bytes:
    samples = [s for t in texts for raw in [t.encode()] for i in range(0, len(raw), PIECE) if (s := raw[i:i + PIECE])]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the samples themselves serve as a raw dictionary
        return b"".join(samples)[-DICT_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift by Newton steps, with a small penalty on the slope."""
    mean, spread = float(x.mean()), float(x.std()) or 1.0
    a = np.c_[(x - mean) / spread, np.ones(len(x))]
    w, ridge = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weight * (p - y)) + ridge @ w
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge + 1e-9 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def sample(docs: DataFrame, labels: DataFrame, *, key="doc_id", text="text", label="quality",
           per_class: int = PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` labelled texts of each class, those first by a hash of
    the id, and the number of labelled documents of each class."""
    lab = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
           .groupBy(F.col(key).alias("_k")).agg((F.min(label) > 0).cast("int").alias("_y")))
    count = {r["_y"]: r["n"] for r in lab.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("_k", F.lit(17)), F.col("_k")]
    picked = None
    for y in (0, 1):
        part = lab.where(F.col("_y") == y).orderBy(*order).limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * per_class ids, so the broadcast is bounded by the parameter
    texts = (docs.select(F.col(key).alias("_k"), F.col(text).alias("_text"))
             .join(F.broadcast(picked), "_k")
             .groupBy("_k", "_y").agg(F.max("_text").alias("_text")))
    return texts, count


def fit(docs: DataFrame, labels: DataFrame, *, key="doc_id", text="text", label="quality",
        per_class: int = PER_CLASS) -> QualityModel:
    texts, count = sample(docs, labels, key=key, text=text, label=label, per_class=per_class)
    rows = sorted(((r["_y"], hash_order(r["_k"]), r["_text"]) for r in texts.collect() if r["_text"]),
                  key=lambda r: r[:2])
    by = {y: [t for c, _, t in rows if c == y] for y in (0, 1)}
    total = sum(count.values())
    if min(len(by[0]), len(by[1])) < 2:
        share = count.get(1, 0) / total if total else 0.5
        return QualityModel(b"", b"", 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    halves = {y: (t[::2], t[1::2]) for y, t in by.items()}
    model = QualityModel(_dictionary(halves[1][0]), _dictionary(halves[0][0]), 1.0, 0.0)
    measure = model.measure()
    x = {y: np.array([measure(t) for t in halves[y][1]]) for y in (0, 1)}
    # each class weighs as often as it occurs among all labels, not in the sample
    weight = np.r_[np.full(len(x[0]), count[0] / len(x[0])), np.full(len(x[1]), count[1] / len(x[1]))]
    weight *= (len(x[0]) + len(x[1])) / weight.sum()
    model.scale, model.shift = _logistic(np.r_[x[0], x[1]], np.r_[np.zeros(len(x[0])), np.ones(len(x[1]))], weight)
    return model


def hash_order(key) -> int:
    import zlib
    return zlib.crc32(f"q{key}".encode())


def score(docs: DataFrame, model: QualityModel, *, text="text") -> "F.Column":
    """A column with the score (0 to 1) of the text column of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        measure = m.measure()
        for batch in batches:
            yield pd.Series(m.probability(np.array([measure(t) for t in batch], dtype=float)))

    return quality(F.col(text))
