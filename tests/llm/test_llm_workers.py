"""What a stage asks of Python workers: one for each task, texts a few rows at a time."""

import numpy as np
import pyarrow as pa

import corpus_pipeline
from promolens.llm import jaccard



def test_a_task_of_the_tokens_has_one_python_worker(spark):
    rows = [(1, "one two", "en", "a", 7), (2, None, None, None, None), (3, "", "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.tokens(spark, docs, "")
    assert str(out._jdf.queryExecution().optimizedPlan()).count("MapInArrow") == 1
    got = {r["doc_id"]: (r["n_tokens"], len(r["ids"])) for r in out.collect()}
    assert got[2] == got[3] == (0, 0) and got[1][0] == got[1][1] >= 2


def test_sets_are_made_of_a_few_texts_at_a_time(monkeypatch):
    monkeypatch.setattr(jaccard, "_TEXTS", 4)
    texts = [" ".join(f"w{(i * j) % 17}" for j in range(i)) for i in range(19)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array([False] * 20), pa.array(range(20), pa.int64()), pa.array([2**62 + i for i in range(20)]),
                                        pa.array(texts)], names=["_none", "_id", "_row", "_text"])
    seen, plain = [], jaccard.batch_word_hashes
    monkeypatch.setattr(jaccard, "batch_word_hashes", lambda t: (seen.append(len(t)), plain(t))[1])
    out = pa.Table.from_batches(jaccard._count(5, 18)([batch])).to_pydict()
    assert seen == [4] * 5
    assert out["id"][:20] == list(range(20)) and out["row"][:20] == [2**62 + i for i in range(20)]
    sets = [pa.Table.from_batches(jaccard._full_sets(5)([batch])).column("members").to_pylist()][0]
    assert out["n"][:20] == [len(s) for s in sets] and out["part"][20:] == list(range(jaccard.PARTS))
    total = np.concatenate([np.frombuffer(jaccard.zstandard.decompress(x), np.int32) for x in out["data"][20:]])
    assert total.sum() == sum(map(len, sets))
