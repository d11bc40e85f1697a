"""What Python workers hold: passes in bounded parts, freed memory returned when a task ends."""

import pickle

import numpy as np
import pandas as pd

from promolens.llm import common, hashing, lm


def _texts():
    rng = np.random.default_rng(3)
    return ["".join(chr(97 + c) for c in rng.integers(0, 6, n)) for n in [*rng.integers(0, 400, 60), 5000]] + [None, ""]


def test_decisions_are_made_of_parts_and_counted_together(monkeypatch):
    texts = _texts()
    tree = lm.trees(lm.count_pairs(lm._texts(texts)).reshape(256, 256))
    monkeypatch.setattr(lm, "SIDE", 1000)
    made, returned, plain = [], [], lm.decisions
    monkeypatch.setattr(lm, "decisions", lambda part, *a: (made.append(part), plain(part, *a))[1])
    monkeypatch.setattr(lm, "give_back", lambda: returned.append(1))

    class Shared:
        value = pickle.dumps(tree)

    bits = 12
    sent = list(lm._pass_decisions(Shared, bits)([pd.DataFrame({"_t": texts[:30]}), pd.DataFrame({"_t": texts[30:]})]))
    assert all(sum(map(len, part[:-1])) < 1000 for part in made) and len(made) > 5 and returned
    merged = pd.concat(lm._merged_decisions(bits)(sent)).set_index("part")
    total = np.zeros((lm.PREDICTORS, 2 << bits), np.int64)
    lm.count_decisions(lm._texts(texts), tree, total)
    for k in range(lm.PREDICTORS):
        assert merged.loc[k]["data"] == lm.log_odds(total[k]).tobytes()


def test_tasks_of_the_model_give_memory_back(monkeypatch):
    returned = []
    monkeypatch.setattr(lm, "give_back", lambda: returned.append(1))
    list(lm._pass_pairs([pd.DataFrame({"_t": ["a b", None]})]))
    list(lm._send_words(2)([pd.DataFrame({"_k": [1], "_k2": [2], "_learn": [True], "_t": ["a b"]})]))
    assert len(returned) == 2
    common.give_back()


def test_word_hashes_do_not_depend_on_the_block(monkeypatch):
    texts = [t.encode() for t in ["one two  three", "x" * 700 + " y " + "z" * 900, "", " a", "b " * 800]]
    whole = [h.tolist() for h in hashing.batch_word_hashes(texts)]
    monkeypatch.setattr(hashing, "BLOCK", 64)
    assert [h.tolist() for h in hashing.batch_word_hashes(texts)] == whole
    assert hashing.BLOCK < 1 << 20


def test_a_decision_is_sent_once_while_its_counts_fit(monkeypatch):
    """Runs of counts are added up as they grow, and again before anything is sent."""
    texts = _texts() * 6
    tree = lm.trees(lm.count_pairs(lm._texts(texts)).reshape(256, 256))
    monkeypatch.setattr(lm, "CHUNK", 500)
    bits, batch = 10, [pd.DataFrame({"_t": texts})]

    class Shared:
        value = pickle.dumps(tree)

    total = np.zeros((lm.PREDICTORS, 2 << bits), np.int64)
    lm.count_decisions(lm._texts(texts), tree, total)
    distinct = int((total > 0).sum())
    monkeypatch.setattr(lm, "HELD", 2 * distinct)
    assert len(list(lm._pass_decisions(Shared, bits)(batch))) == 1
    monkeypatch.setattr(lm, "HELD", distinct // 2)
    sent = list(lm._pass_decisions(Shared, bits)(batch))
    assert len(sent) > 1
    merged = pd.concat(lm._merged_decisions(bits)(sent)).set_index("part")
    assert all(merged.loc[k]["data"] == lm.log_odds(total[k]).tobytes() for k in range(lm.PREDICTORS))
    runs = []
    for n in (900, 300, 200, 100):
        lm._hold(runs, lm._counted(np.arange(n, dtype=np.uint32)))
    assert [len(r) for r in runs] == [900, 300, 100] and lm._added(runs)[0] & np.uint64(0xFFFFFFFF) == 4


def test_a_step_scores_all_levels_of_its_symbols_together():
    """Against decisions made one by one; a step looks each table up once."""
    texts = [b"the cat the cat the cat", b"aaaa the caaaat", b"q", b""]
    tree = lm.trees(lm.count_pairs(texts).reshape(256, 256))
    bits = 10
    total = np.zeros((lm.PREDICTORS, 2 << bits), np.int64)
    lm.count_decisions(texts[:2], tree, total)
    looks = []

    class Table(np.ndarray):
        def take(self, *a, **k):
            looks.append(1)
            return np.asarray(self).take(*a, **k)

    m = lm.MixModel(tree, lm.log_odds(total).view(Table), lm.first_weights())
    got = m.costs(texts)
    assert len(looks) == lm.PREDICTORS
    for text, cost in zip(texts, got):
        raw, first, size = lm._laid_out([text])
        at = lm._places(first, size)
        context, pointed, want = lm._contexts(raw, at), lm._pointed(raw, at, np.zeros(len(at), int)), 0.0
        for i, place in enumerate(at):
            code = int(raw[place - 1]) << 8 | int(raw[place])
            follows, guess = pointed[i] >= 0, (code & 0xFF00) | max(0, int(pointed[i]))
            for d in range(tree.length[code]):
                node, bit, says = tree.node[d, code:code + 1], tree.bit[d, code], tree.bit[d, guess]
                look = [int(m.tables[k][lm._slots(context[k, i:i + 1], node, bits)[0]]) for k in range(lm.PREDICTORS)]
                gate = ((look[-2] & 3) * lm.SEEN + (look[-1] & 3)) * 2 + follows
                inputs = [*((x >> 8) / lm.SCALE for x in look), (4.0 * says - 2) * follows, 1.0]
                one = 1 / (1 + np.exp(-np.clip(inputs @ m.weights[:, gate], -14, 14)))
                want -= np.log2(one if bit else 1 - one)
                follows = follows and says == bit
        assert abs(want - cost) < 1e-4 * max(1, want)


def test_decisions_of_a_repeated_symbol_are_made_once(monkeypatch):
    """A symbol in the same context is counted before its decisions are made, however often it comes."""
    texts = ["the cat sat on the mat " * 40] * 60 + _texts()
    raw, first, size = lm._laid_out(lm._texts(texts))
    at, bits = lm._places(first, size), 12
    tree = lm.trees(lm.count_pairs(lm._texts(texts)).reshape(256, 256))
    code = (raw[at - 1].astype(np.int64) << 8) | raw[at]
    length = tree.length[code]
    want = np.zeros((lm.PREDICTORS, 2 << bits), np.int64)
    for k, context in enumerate(lm._contexts(raw, at)):
        for d in range(int(length.max())):
            some = length > d
            slot = lm._slots(context[some], tree.node[d, code[some]], bits).astype(np.int64)
            np.add.at(want[k], 2 * slot + tree.bit[d, code[some]], 1)
    made, plain = [], lm._slots
    monkeypatch.setattr(lm, "_slots", lambda context, *a: (made.append(len(context)), plain(context, *a))[1])

    class Shared:
        value = pickle.dumps(tree)

    for many in (lm.MANY, 3):
        monkeypatch.setattr(lm, "MANY", many)
        sent = list(lm._pass_decisions(Shared, bits)([pd.DataFrame({"_t": texts})]))
        merged = pd.concat(lm._merged_decisions(bits)(sent)).set_index("part")
        assert all(merged.loc[k]["data"] == lm.log_odds(want[k]).tobytes() for k in range(lm.PREDICTORS))
        if many == lm.MANY and many > 3:
            assert sum(made) < lm.PREDICTORS * int(length.sum()) / 2
    assert len(lm._symbols(np.empty(0, np.uint64))) == 0


def test_symbols_after_three_bytes_come_from_those_after_five(monkeypatch):
    """All symbols are sorted for two predictors only; the third adds up what is left of one of them."""
    texts = ["the cat sat on the mat " * 40] * 60 + _texts()
    raw, first, size = lm._laid_out(lm._texts(texts))
    at = lm._places(first, size)
    found, made, plain = lm.decisions(lm._texts(texts)), [], lm._symbols
    monkeypatch.setattr(lm, "_symbols", lambda x, *a, **k: (made.append(len(x)), plain(x, *a, **k))[1])
    for many in (lm.MANY, 3):
        monkeypatch.setattr(lm, "MANY", many)
        got = lm._predicted(*(lm._symbols(x.copy()) for x in found))
        for symbols, context in zip(got, lm._contexts(raw, at)):
            want = np.unique(context.astype(np.uint64) << np.uint64(16) | lm._codes(raw).take(at), return_counts=True)
            code, which = np.unique(symbols >> np.uint64(16), return_inverse=True)
            assert code.tolist() == want[0].tolist()
            assert np.bincount(which, weights=symbols & np.uint64(0xFFFF)).tolist() == want[1].tolist()
        if many > 3:
            assert made[:2] == [len(at), len(at)] and made[2] < len(at) / 4 and len(made) == 3


def test_symbols_of_a_context_are_side_by_side_in_a_step():
    rng = np.random.default_rng(5)
    first, then = rng.integers(0, 90, 3000), rng.integers(0, 1 << 32, 40).astype(np.uint32)[rng.integers(0, 40, 3000)]
    order = lm._in_order(first, then)
    assert np.array_equal(order, np.lexsort((np.arange(3000), then, first)))
    assert lm._in_order(first[:0], then[:0]).tolist() == []
    # no room for ``then``: still every place once, by ``first``
    far = first << 45
    assert (np.diff(far[lm._in_order(far, then)]) >= 0).all()


def test_tasks_of_the_model_use_freed_memory_again(monkeypatch):
    """Arrays of some MB were given to the system and taken back page by page."""
    kept = []
    monkeypatch.setattr(lm, "keep_freed", lambda: kept.append(1))
    texts = _texts()
    tree = lm.trees(lm.count_pairs(lm._texts(texts)).reshape(256, 256))

    class Shared:
        value = pickle.dumps(tree)

    list(lm._pass_pairs([pd.DataFrame({"_t": texts})]))
    list(lm._pass_decisions(Shared, 10)([pd.DataFrame({"_t": texts})]))
    assert len(kept) == 2
    common.keep_freed()
