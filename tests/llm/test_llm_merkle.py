"""The Merkle manifest against a plain tree built by hand."""

import pytest
from pyspark.sql import functions as F

import helpers as H
from promolens.llm import merkle

KIND = "doc_id long, source string, lang string, n_chars long, text string, leaf string, t long, i long, root int"


def plain(rows):
    """[(doc_id, source, lang, n_chars, text)] -> sorted [(leaf, subroot, root, proof)]."""
    leaf = lambda r: H.sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def tree(level, paths):
        """paths: per leaf its steps so far; -> root"""
        below = [[k] for k in range(len(level))]
        while len(level) > 1:
            for k, who in enumerate(below):
                step = "l" + level[k - 1] if k % 2 else "r" + level[k + 1] if k + 1 < len(level) else "-"
                for w in who:
                    paths[w].append(step)
            level = [H.sha("".join(level[k:k + 2])) for k in range(0, len(level), 2)]
            below = [sum(below[k:k + 2], []) for k in range(0, len(below), 2)]
        return level[0]

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    out, tops, paths = [], [], []
    for g in order:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        steps = [[] for _ in mine]
        tops.append(tree([leaf(r) for r in mine], steps))
        paths.append((mine, steps))
    above = [[] for _ in tops]
    root = tree(tops, above) if tops else None
    for (mine, steps), top, more in zip(paths, tops, above):
        out += [(r[0], leaf(r), top, root, tuple(s + more)) for r, s in zip(mine, steps)]
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], KIND)
    got = merkle.manifest(df, [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof"]
    return got, sorted(((r[0], r[1], r[2], r[3], tuple(r[4])) for r in got.collect()), key=repr)


def row(i, lang="en", text="some text"):
    return (i, "src0", lang, len(text or ""), text)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [1, 1], [1, 5, 2], [257, 1, 3], [700, 2, 256, 1, 33, 4, 7]])
def test_sizes(spark, sizes):
    rows = [row(1000 * g + 3 * i, f"l{g}", f"text {i % 5}") for g, n in enumerate(sizes) for i in range(n)]
    got, have = run(spark, rows)
    assert have == plain(rows)
    folded = got.select((merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok")).distinct().collect()
    assert [r.ok for r in folded] == [True]


def test_odd_rows(spark):
    rows = [row(None), row(None, None, None), row(1, None), row(2, ""), row(2, "é", ""), row(3, "z", "long " * 50_000), (None,) * 5,
            row(-5), row(7), row(7), row(7, "en", "other"), (8, None, "en", 2**63 - 1, "é"), (9, "", "\U0001f600", -1, "-"), row(2**60 + 1)]
    assert run(spark, rows * 2)[1] == plain(rows * 2)


def test_empty_table(spark):
    assert run(spark, [])[1] == []


def test_changed_leaf_is_found(spark):
    got, _ = run(spark, [row(i, "en" if i % 3 else "de") for i in range(40)])
    wrong = merkle.fold(F.sha2(F.lit("other"), 256), F.col("proof"))
    assert got.where(wrong == F.col("root")).count() == 0


def test_all_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_ROWS", 0)
    rows = [row(i, f"l{i % 3}") for i in range(300)]
    assert run(spark, rows)[1] == plain(rows)


def test_carried_name_is_refused(spark):
    with pytest.raises(ValueError):
        merkle.manifest(spark.createDataFrame([], KIND), [F.col("doc_id")], carry=["root"])
