"""Registered queries against SQL, and the pipeline against a stage-by-stage version."""

import pytest

import corpus_pipeline
import helpers as H
from oracle_compare import compare, duck
from promolens.llm import registry
from promolens.llm.common import table


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    got = registry.queries()[name](spark, H.SMALL).toPandas()
    want = duck(H.SMALL).sql(registry.oracle_sql()[name]).df()
    status, detail = compare(got, want)
    assert status != "MISMATCH", detail


def test_registry():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in registry.queries()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_pipeline_stages_by_hand(spark):
    docs = table(spark, H.SMALL, "documents")
    columns = docs.columns
    one = corpus_pipeline.language(spark, docs, H.SMALL)
    assert one.columns == columns and one.count() >= 0.97 * docs.count()
    kept = [(r["doc_id"], r["text"]) for r in one.collect()]

    sets = {i: H.shingle_set(t) for i, t in kept}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    near = H.smallest_reachable(sets, links)
    two = corpus_pipeline.near_duplicates(spark, one, H.SMALL)
    left = sorted((r["doc_id"], r["text"]) for r in two.collect())
    assert two.columns == columns and left == sorted((i, t) for i, t in kept if near[i] == i)

    three = corpus_pipeline.repeated_strings(spark, two, H.SMALL)
    got = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in three.collect())
    plain = H.cut_repeats([(i, t.encode()) for i, t in left])
    want = [(i, k.decode(errors="ignore"), len(k.decode(errors="ignore"))) for (i, _), (k, _, _) in zip(left, plain)]
    assert three.columns == columns and [(i, t) for i, t, _ in got] == [(i, t) for i, t, _ in want]
    changed = {i for (i, _), (_, n, _) in zip(left, plain) if n}
    assert [x for x in got if x[0] in changed] == [x for x in want if x[0] in changed] and changed

    four = corpus_pipeline.benchmark_free(spark, three, H.SMALL)
    items = [[w.strip(".,") for w in r["text"].lower().split()] for r in table(spark, H.SMALL, "benchmark").collect()]
    held = set()
    for i, t, _ in got:
        w = [x.strip(".,") for x in t.lower().split()]
        runs = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        if any(sum(tuple(x[k:k + 5]) in runs for k in range(len(x) - 4)) >= 0.6 * (len(x) - 4) for x in items):
            held.add(i)
    assert four.columns == columns and {i for i, _, _ in got} - {r["doc_id"] for r in four.collect()} == held


def test_pipeline_odd_rows(spark):
    rows = [(None, None), (None, "the house and the river"), (1, None), (2, ""), (3, "the house and the river and the wood " * 30),
            (4, "the house and the river and the wood " * 30), (4, "the old mill"), (5, "12 34"), (6, "the " * 3000)]
    docs = H.documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, H.SMALL)
        got = out.collect()
        assert stage(spark, docs.limit(0), H.SMALL).collect() == [], name
        docs = spark.createDataFrame(got, out.schema)
    assert {r["doc_id"] for r in got} >= {None, 3, 6} and len(got) < len(rows)


def test_pipeline_run_is_its_stages(spark):
    """``run`` against the stages called one by one and the tokenizers library."""
    from tokenizers import Tokenizer
    from promolens.llm.queries import tokenizer_path
    docs = table(spark, H.SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, H.SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    t = Tokenizer.from_file(tokenizer_path())
    want = []
    for r in docs.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), H.sha(" ".join(map(str, ids))), H.sha(t.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in corpus_pipeline.run(spark, H.SMALL).collect()]
    assert sorted(got) == sorted(want) and len(got) > 100
