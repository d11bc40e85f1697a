"""Language model, language ID, quality score: exact parts, gradients, held-out accuracy."""

import math
import pickle
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import helpers as H
from promolens.llm import langid, lm, quality
from promolens.llm.queries import QUERIES


def base_by_hand(rows):
    count = Counter(w for i, t in rows if H.fold(i, 7) != 2 for w in [*H.words(t), "\0"])
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        w = [*H.words(t), "\0"]
        out.append((i, H.fold(i, 7) == 2, len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)))
    return out


def test_lm_word_model_and_gain(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{H.HOT}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in QUERIES["op1_lm"](spark, H.HOT).collect()}
    assert len(got) == len(rows)
    for i, held, n, known, total, base in base_by_hand(rows):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_nulls_repeats_and_little_text(spark):
    rows = [(None, None), (1, None), (2, ""), (2, ""), (3, "the the THE"), (3, "the the THE"), (4, "the cat"), (5, "x" * 30_000), (6, "\0\x01 é")]
    from promolens.llm.common import fold
    docs = H.documents(spark, rows)
    got = sorted(([r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 9)], r["score"])
                 for r in lm.score(docs, fold("doc_id", 7) != 2).collect())
    want = sorted([-1 if i is None else i, n, k, t, round(b, 9)] for i, _, n, k, t, b in base_by_hand(rows))
    assert [g for g, _ in got] == want
    assert all(math.isfinite(s) and s < 0 for _, s in got)
    assert lm.score(H.documents(spark, []), fold("doc_id", 7) != 2).collect() == []


def test_lm_answers_meet_by_the_documents_sent_together(spark, monkeypatch):
    """Several messages, buckets and homes, rows that repeat in blocks of equal keys, and few tokens."""
    from promolens.llm.common import fold
    monkeypatch.setattr(lm, "TOGETHER", 3)
    monkeypatch.setattr(lm, "WORD_BUCKET", 40)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefghij") * rng.randint(1, 2) for _ in range(rng.randint(0, 9)))) for i in range(30)]
    rows = (rows[:3] * 4) + rows
    docs = H.documents(spark, rows).coalesce(1)
    got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 8))
                 for r in lm.score(docs, fold("doc_id", 7) != 2).collect())
    assert got == sorted((i, n, k, t, round(b, 8)) for i, _, n, k, t, b in base_by_hand(rows))


def test_lm_is_a_distribution_over_the_next_byte():
    """The probabilities of all bytes that can come next add up to one."""
    texts = [b"the cat sat on the mat", b"the dog sat"] * 20
    pairs = lm.count_pairs(texts).reshape(256, 256)
    tree = lm.trees(pairs)
    total = np.zeros((lm.PREDICTORS, 2 << lm.SLOT_BITS), np.int32)
    lm.count_decisions(texts, tree, total)
    m = lm.MixModel(tree, lm.log_odds(total), lm.first_weights())
    before = m.costs([b"the c"])[0]
    # cost(text) ends with the end mark: compare texts that differ in the next byte by chains of end marks
    ends = np.array([m.costs([b"the c" + bytes([b])])[0] for b in range(255)])
    assert before > 0 and (ends > 0).all()
    one = m.costs([b"the cat", b"the cat", b"qzxj", b""])
    assert one[0] == one[1] and one[0] < one[2] and one[3] > 0
    assert m.costs([b"THE cat"])[0] == one[0]
    together = m.costs([b"a" * 5000, b"the cat", b"the dog sat on it"])
    assert together[1] == pytest.approx(one[0], rel=1e-6)  # whatever is scored beside it


def test_lm_tables_and_weight_texts_grow_with_the_training_text(spark, monkeypatch):
    """Counts of all ranges of slots are those of one table."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "mat", "é"]) for _ in range(30))) for i in range(120)]
    monkeypatch.setattr(lm, "SLOT_BITS", 10)
    for name, value in {"SLOT_BYTES": 2, "RANGE_BITS": 6, "WEIGHT_EACH": 10, "HELD": 500, "CHUNK": 900}.items():
        monkeypatch.setattr(lm, name, value, raising=False)
    used = []
    costs = lm.MixModel.costs
    monkeypatch.setattr(lm.MixModel, "costs", lambda m, texts, keep=False: used.extend(texts) or costs(m, texts, keep))
    for n, bits in ((len(rows) // 8, 10), (len(rows), 13)):
        used.clear()
        model, size = lm.train(H.documents(spark, rows[:n]), weight_texts=5)
        assert model.tables.shape == (lm.PREDICTORS, 1 << bits) and len(used) == max(5, n // 10)
        rest = [t.encode() for _, t in rows[:n]]
        assert size == sum(map(len, rest))
        for t in used:
            rest.remove(t)
        total = np.zeros((lm.PREDICTORS, 2 << bits), np.int32)
        lm.count_decisions(rest, model.tree, total)
        assert (model.tables == lm.log_odds(total)).all()
    # several chunks and several sendings of one task
    held = type("Shared", (), {"value": pickle.dumps(model.tree)})
    sent = list(lm._pass_decisions(held, bits)([pd.DataFrame({"_t": [t.decode() for t in rest]})]))
    assert len(sent) > 2
    for r in lm._merged_decisions(bits)(iter(sent)):
        part, found = r["part"].iat[0], np.frombuffer(r["data"].iat[0], np.int16)
        assert (model.tables.reshape(-1)[part * len(found):][:len(found)] == found).all()


def test_lm_weights_follow_certain_decisions_too():
    texts = [b"abcd" * 5] * 4000
    tree = lm.trees(lm.count_pairs(texts).reshape(256, 256))
    total = np.zeros((lm.PREDICTORS, 2 << lm.SLOT_BITS), np.int32)
    lm.count_decisions(texts, tree, total)
    m = lm.MixModel(tree, lm.log_odds(total), lm.first_weights() * 2)
    before = m.weights.copy()
    first = m.costs(texts[:1], keep=True)[0]
    moved = m.weights - before
    assert first < 1 and (moved != 0).any()  # no decision was missed by 0.03
    assert m.costs(texts[:1])[0] < first


def test_lm_trees_code_every_byte():
    tree = lm.trees(np.zeros((256, 256), np.int64))
    assert (tree.length == 8).all()


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    m = langid.new_model(["a", "b", "c"], hidden=4)
    m.inputs, m.states, m.outputs = ([x.astype(np.float64) for x in part] for part in (m.inputs, m.states, m.outputs))
    m.bias = m.bias.astype(np.float64)
    text, answer = rng.integers(97, 100, (3, 5)).astype(np.uint8), np.array([0, 1, 2])
    _, grads = langid.gradients(m, text, answer)
    for x, g in zip(m.parameters(), grads):
        for at in zip(*[rng.integers(0, s, 4) for s in x.shape]) if x.ndim > 1 else [(0,), (2,)]:
            if x.shape[0] == 256:
                at = (97 + at[0] % 3, *at[1:])
            old = x[at]
            x[at] = old + 1e-3
            up, _ = langid.gradients(m, text, answer)
            x[at] = old - 1e-3
            down, _ = langid.gradients(m, text, answer)
            x[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-3, abs=2e-4)


def test_language_lanes_agree_with_one_by_one():
    m = langid.new_model(["a", "b"], seed=3)
    texts = [b"", b"x", b"hello there " * 40, b"y" * 128, b"z" * 129]
    many = langid.document_probabilities(m, texts)
    for t, p in zip(texts, many):
        assert np.allclose(p, langid.document_probabilities(m, [t])[0], atol=1e-6)
    assert many[0].sum() == 0 and np.allclose(many[1:].sum(1), 1, atol=1e-5)


def test_language_held_out(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{H.HOT}/documents.parquet").collect()}
    got = QUERIES["op10_language"](spark, H.HOT).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(docs) and all(r["held_out"] == (H.fold(r["doc_id"], 3) == 1) for r in got)
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_texts(spark):
    docs = H.documents(spark, [(1, "the cat sat on the mat " * 9), (2, None), (3, ""), (4, "123 !? 5"), (None, "and the dog"), (1, "the cat")])
    model = langid.fit(docs)
    got = docs.select("doc_id", langid.predict(docs, model).alias("p")).collect()
    assert [r["p"]["lang_pred"] for r in got] == ["en", "und", "und", "und", "en", "en"]
    nothing = langid.fit(docs.limit(0))
    assert {r["p"]["lang_pred"] for r in docs.select(langid.predict(docs, nothing).alias("p")).collect()} == {"und"}


def test_quality_held_out(spark):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{H.HOT}/labels.parquet").collect()}
    got = QUERIES["op8_quality"](spark, H.HOT).collect()
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [(r["score"], label[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in label]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_quality_of_odd_texts_and_labels(spark):
    rng = random.Random(1)
    good = [(i, " ".join(rng.choices(["the", "cat", "sat", "on", "mat", "and", "ran"], k=60))) for i in range(40)]
    bad = [(100 + i, " | ".join(rng.choices(["###", "$$$", "%%%", "&&&"], k=60))) for i in range(40)]
    docs = H.documents(spark, [*good, *bad, (500, None), (501, ""), (None, "the cat")])
    labels = spark.createDataFrame([*[(i, 1) for i, _ in good], *[(i, 0) for i, _ in bad], (None, 1), (3, None), (4, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", quality.score(docs, model).alias("s")).collect()}
    assert min(got[i] for i, _ in good) > max(got[i] for i, _ in bad)
    assert got[500] == got[501] and 0 <= got[500] <= 1
    one_class = quality.fit(docs, labels.where("quality = 1"))
    assert {round(r["s"], 3) for r in docs.select(quality.score(docs, one_class).alias("s")).collect()} == {1.0}
    assert quality.fit(docs, labels.limit(0)).probability(np.zeros(1))[0] == pytest.approx(0.5)


def _language_by_hand(m, text):
    """Mean over all bytes of a text's language probabilities: each stretch on its own, forwards and backwards, a byte
    at a time, from the model's weights."""
    total = np.zeros(len(m.languages))
    for lo in range(0, len(text), langid.STRETCH):
        part = text[lo:lo + langid.STRETCH]
        logits = np.tile(m.bias.astype(np.float64), (len(part), 1))
        for d in range(2):
            h = m.states[d].shape[0]
            state = np.zeros(h)
            for i in (range(len(part)) if d == 0 else range(len(part) - 1, -1, -1)):
                x, u = m.inputs[d][part[i]].astype(np.float64), state @ m.states[d].astype(np.float64)
                keep, reset = (1 / (1 + np.exp(-(x[a:b] + u[a:b]))) for a, b in ((0, h), (h, 2 * h)))
                new = np.tanh(x[2 * h:] + reset * u[2 * h:])
                state = keep * state + (1 - keep) * new
                logits[i] += state @ m.outputs[d].astype(np.float64)
        p = np.exp(logits - logits.max(1, keepdims=True))
        total += (p / p.sum(1, keepdims=True)).sum(0)
    return total / max(len(text), 1)


def test_language_scores_by_hand(spark):
    docs = spark.read.parquet(f"{H.SMALL}/documents.parquet").where("doc_id % 5 = 0")
    model = langid.fit(spark.read.parquet(f"{H.SMALL}/documents.parquet"), per_language=40)
    got = {r["doc_id"]: (r["text"], r["p"]) for r in docs.select("doc_id", "text", langid.predict(docs, model).alias("p")).collect()}
    assert len(got) > 20
    for text, p in got.values():
        raw = (text or "").encode()
        if p["lang_pred"] == langid.UNKNOWN:
            assert not any(c.isalpha() for c in text or "")
            continue
        want = _language_by_hand(model, raw)
        assert p["score"] == pytest.approx(want.max(), abs=1e-4)
        top = sorted(want)[-2:]
        assert p["lang_pred"] == model.languages[want.argmax()] or top[1] - top[0] < 1e-4


def test_quality_scores_by_hand(spark):
    """Every score from the two dictionaries, a new compressor for each piece."""
    import zstandard
    docs, labels = (spark.read.parquet(f"{H.SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    assert model.good and model.bad

    def size(raw, dictionary):
        d = zstandard.ZstdCompressionDict(dictionary)
        return len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=d, write_checksum=False, write_content_size=False,
                                            write_dict_id=False).compress(raw))
    got = docs.select("doc_id", "text", quality.score(docs, model).alias("s")).collect()
    for r in got:
        raw = (r["text"] or "").encode()
        parts = [raw[i:i + quality.PIECE] for i in range(0, len(raw), quality.PIECE)]
        x = sum(size(p, model.bad) - size(p, model.good) for p in parts) / max(len(raw), 1)
        assert r["s"] == pytest.approx(1 / (1 + math.exp(-(model.scale * x + model.shift))), rel=1e-9)
    assert len({r["s"] for r in got}) > 50


def test_quality_of_empty_tables(spark):
    docs, labels = (spark.read.parquet(f"{H.SMALL}/{t}.parquet") for t in ("documents", "labels"))
    nothing = quality.fit(docs.limit(0), labels)
    assert docs.limit(0).select(quality.score(docs, nothing)).collect() == []
    plain = {r[0] for r in docs.select(quality.score(docs, quality.fit(docs, labels.limit(0)))).collect()}
    assert plain == {0.5}
