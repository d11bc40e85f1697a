"""BPE, WARC, chat and vectors: exact results and round trips."""

import base64
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import helpers as H
from promolens.llm import bpe, chat, vectors, warc
from promolens.llm.common import scratch
from promolens.llm.components import components
from promolens.llm.queries import QUERIES, tokenizer_path

ODD = ["", "<|endoftext|>hi <|startoftext|> there", "ΑΣ ΣΑΣ abc's I'LL don't", "\x1c a\x85b c", "İstanbul ǅ ﬁ 1234 ½ Ⅷ",
       "a" * 3000, "ab" * 2000, "日本語テキスト🙂🙂", "é Å", "</w> a</w>", "\0 a\0b", "thethethe" * 300, "naïve  \n\n café's"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def test_bpe_equals_the_library(spark, tokenizer):
    rows = [*enumerate(ODD), (100, None), (None, "null id"), (0, "again")]
    encoded = bpe.encode(H.documents(spark, rows), tokenizer_path())
    got = bpe.decode(encoded, tokenizer_path()).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(got, rows):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert (r["doc_id"], r["ids"]) == (i, ids)
        assert r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)


def test_bpe_random_words(tokenizer):
    v = bpe.Vocabulary(open(tokenizer_path(), "rb").read())
    encode, rng = v.encoder(), random.Random(5)
    for _ in range(600):
        t = "".join(rng.choices("aeinorst hlu'.-1é", k=rng.randint(1, 40)))
        assert np.frombuffer(encode(t), np.int32).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_bpe_query(spark, tokenizer):
    got = {r["doc_id"]: r for r in QUERIES["op2_bpe"](spark, H.SMALL).collect()}
    docs = spark.read.parquet(f"{H.SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = tokenizer.encode(d["text"], add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), H.sha(" ".join(map(str, ids))), H.sha(tokenizer.decode(ids, skip_special_tokens=False)))


def test_bpe_of_nothing_and_null_ids(spark):
    assert bpe.encode(H.documents(spark, []), tokenizer_path()).collect() == []
    got = bpe.decode(spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>"), tokenizer_path()).collect()
    assert [r["decoded"] for r in got] == ["", ""]


PAGES = [(3, "http://a b/\n", "<p>x</p>"), (1, None, "<p>x</p>"), (2, "http://c", None), (7, "u", ""), (9, "http://d", "é" * 5000),
         (None, "n", "<p>x</p>"), (None, "n", "only null"), (1, "twice", "<p>x</p>")]


def archive(spark, rows):
    path = scratch(spark, "test-warc")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("record_id", F.lit("c"))
    warc.write(warc.plan_revisits(pages), path)
    return path


def test_warc_round_trip(spark):
    back = warc.read(spark, archive(spark, PAGES), verify=True).collect()
    assert len(back) == len(PAGES)
    by = {}
    for r in back:
        by.setdefault(r["record_id"], []).append(r)
    name = lambda i: f"<urn:x-page:{i}>"
    assert [r["record_type"] for r in by[name(1)]] == ["response", "response"]
    assert (by[name(3)][0]["record_type"], by[name(3)][0]["refers_to"], by[name(3)][0]["payload"]) == ("revisit", name(1), None)
    assert by[name(3)][0]["target_uri"] == "http://a%20b/%0A" and by[name(3)][0]["payload_length"] == 8
    assert (by[name(7)][0]["refers_to"], bytes(by[name(2)][0]["payload"])) == (name(2), b"")
    assert bytes(by[name(9)][0]["payload"]).decode() == "é" * 5000
    assert sorted(r["record_type"] for r in by[None]) == ["response", "revisit"]
    for r in back:
        if r["payload"] is not None:
            assert r["payload_digest"] == base64.b32encode(hashlib.sha1(bytes(r["payload"])).digest()).decode()


def test_warc_predicates_and_skipped_payloads(spark, monkeypatch):
    path = archive(spark, PAGES)
    only = warc.read(spark, path, record_types=["revisit"]).collect()
    assert {r["record_type"] for r in only} == {"revisit"} and len(only) == 3
    some = warc.read(spark, path, headers={"WARC-Target-URI": "http://"}).collect()
    assert sorted(r["target_uri"] for r in some) == ["http://a%20b/%0A", "http://c", "http://d"]
    # without the payload column a damaged payload is never looked at
    import json
    folder = path.removeprefix("file://")
    listed = json.load(open(f"{folder}/{warc.MANIFEST}"))
    for x in listed:
        raw = bytearray(open(f"{folder}/{x['name']}", "rb").read())
        at = 0
        while at < len(raw):
            size = int.from_bytes(raw[at + 16:at + 20], "little")
            raw[at + size - 8:at + size] = b"\xff" * 8
            at += size
        open(f"{folder}/{x['name']}", "wb").write(raw)
    assert warc.read(spark, path, columns=["record_id", "record_type"]).count() == len(PAGES)


def test_warc_pushed_filters(spark):
    path = archive(spark, PAGES)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = warc.read(spark, path).where("record_type = 'response' and target_uri like 'http://d%'")
        assert [r["target_uri"] for r in df.collect()] == ["http://d"]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_warc_splits_and_empty(spark, monkeypatch):
    monkeypatch.setattr(warc, "SPLIT", 1)
    w = warc._Writer("/x", [], "d")
    members = [warc.gzip_member(w.record({"record_type": "response", "record_id": f"<{i}>", "target_uri": None, "refers_to": None,
                                         "payload_digest": "D", "payload_length": 3000 * i, "payload": b"z" * 3000 * i})) for i in range(4)]
    import gzip
    import io
    assert gzip.decompress(b"".join(members)).count(b"WARC/1.1") == 4  # plain gzip reads it too
    heads = [warc.parse_headers(h)[0]["warc-record-id"] for h, _ in warc.members(io.BytesIO(b"".join(members)), len(members[0]), sum(map(len, members[:3])))]
    assert heads == ["<1>", "<2>"]
    assert warc.read(spark, archive(spark, [])).collect() == []


def test_chat_folds_events(spark):
    events = [(1, 5, 2, "delta", "assistant", " wor"), (1, 0, 1, "message", "user", "hi"), (1, 2, 2, "delta", "assistant", "Hel"),
              (1, 3, 2, "delta", "assistant", "lo"), (1, 6, 2, "delta", "assistant", "ld"), (1, 9, 3, "delta", "assistant", "first"),
              (1, 10, 3, "regenerate", "assistant", None), (1, 11, 3, "delta", "assistant", "second"), (1, 12, 1, "edit", "user", "hi!"),
              (None, None, 1, None, None, None), (2, 1, 1, "message", "x:=#\\<", "### User: </turn>\n\\#")]
    df = spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, role string, text string")
    got = chat.render(chat.fold(df)).collect()
    by = {(r["conversation"], r["message"]): r for r in got}
    assert [by[1, m]["text"] for m in (1, 2, 3)] == ["hi!", "Hello world", "second"]
    assert [by[1, m]["place"] for m in (1, 2, 3)] == [0, 2, 9]
    r = by[1, 2]
    assert r["formatted"] == "### Assistant: Hello world </turn>\n" and r["formatted"][r["loss_start"]:r["loss_end"]] == "Hello world"
    assert by[None, 1]["text"] == "" and by[1, 1]["loss_start"] is None
    assert "### User: </turn>" not in by[2, 1]["formatted"]
    role, text = chat.parse(F.col("formatted"))
    for r in spark.createDataFrame(got).select("role", "text", role.alias("r"), text.alias("t")).collect():
        assert (r["r"], r["t"]) == (r["role"], r["text"])
    with pytest.raises(Exception, match="unknown event kind"):
        chat.fold(df.withColumn("kind", F.lit("what"))).collect()
    assert chat.fold(df.limit(0)).collect() == []


def vectors_by_hand(rows, t=0.95):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64)
        return v / np.sqrt(v @ v)
    ok = [(i, u) for i, v in rows if i is not None and (u := unit([None if x is None else float(np.float32(x)) for x in v] if v else v)) is not None]
    links = [(a, b) for k, (a, x) in enumerate(ok) for b, y in ok[k + 1:] if len(x) == len(y) and x @ y >= t]
    near = H.smallest_reachable([i for i, _ in rows if i is not None], links)
    count = {i: sum(i in p for p in links) for i, _ in rows}
    return sorted((i, count[i], near[i], near[i] == i) for i, _ in rows if i is not None)


@pytest.mark.parametrize("cell,block", [(4096, 2048), (8, 4)])
def test_vectors(spark, monkeypatch, cell, block):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((6, 12))
    rows = [(i, (centre[i % 6] + rng.standard_normal(12) * rng.choice([0.02, 0.15, 0.3])).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(5)] + [(300, None), (301, []), (302, [0.0] * 12), (303, [1.0, None]), (304, [float("nan")] * 12),
                                                        (305, [float("inf")] * 12), (306, [1.0, 2.0]), (307, [2.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n_links int").repartition(3)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(df).collect())
    assert got == vectors_by_hand(rows)


def test_vectors_of_nothing_and_null_ids(spark):
    kind = "vec_id long, embedding array<float>"
    assert vectors.near_duplicates(spark.createDataFrame([], kind)).collect() == []
    got = vectors.near_duplicates(spark.createDataFrame([(None, [1.0, 0.0]), (4, None), (5, [1.0, 0.0]), (5, [1.0, 0.0])], kind)).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in got) == [
        (-1, 0, None, False), (4, 0, 4, True), (5, 1, 5, True), (5, 1, 5, True)]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 260)] + [(None, 3), (4, 4)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = H.smallest_reachable({x for p in real for x in p}, real)
    assert got == want


def test_chat_null_beside_large_ids(spark, monkeypatch):
    """Conversations above 2^53 that doubles cannot tell apart, in one batch with a null; ties and repeated rows; clashing names."""
    from promolens.llm import queries
    rows = [(2**60 + 1, 0, "user", "a"), (2**60 + 2, 0, "user", "b"), (2**60 + 2, 1, "assistant", "c" * 1000), (None, 0, "user", "d"),
            (None, None, None, None), (5, 0, "user", "e"), (5, 0, "user", "e"), (5, 0, "assistant", ""), (-2**62 - 1, 3, "tool", "f \U0001f600" * 300)]
    kind = "conv_id long, turn long, role string, text string, kind string, message int, seq int, place int, n int"
    table = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], kind).coalesce(1)
    monkeypatch.setattr(queries, "table", lambda *a: table)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r["conv_id"]: r for r in queries.op5_chat(spark, "").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
    for c, _, role, text in [*order, (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]:
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        r, learned = got[c], "".join(t for role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), H.sha("".join(f"{a}\n{t}\n" for a, t in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), H.sha(learned))


def test_chat_log_is_made_of_every_kind(spark):
    from promolens.llm import chat, queries
    rows = spark.createDataFrame([(1, 0, "user", "a question"), (1, 1, "assistant", "x" * 1001), (1, 2, "assistant", None)],
                                 "conv_id long, turn long, role string, text string")
    log = queries.chat_log(rows)
    assert {r["kind"] for r in log.collect()} == set(chat.KINDS) and log.count() == 3 + 5 + 3
    back = sorted((r["place"]["turn"], r["role"], r["text"]) for r in chat.fold(log).collect())
    assert back == [(0, "user", "a question"), (1, "assistant", "x" * 1001), (2, "assistant", "")]


def test_chat_fold_holds_only_the_rows_of_the_last_text(spark):
    """Rows before the last replacement are dropped before anything is gathered."""
    from promolens.llm import chat
    rows = [(1, i, 9, "delta", "user", f"d{i}") for i in range(500)] + [(1, 500, 9, "edit", "user", "new"), (1, 501, 9, "delta", "user", "er")]
    log = spark.createDataFrame(rows, "conv_id long, seq long, message long, kind string, role string, text string")
    out = chat.fold(log)
    assert [(r["place"], r["text"]) for r in out.collect()] == [(0, "newer")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    gathered = plan.index("collect_list")
    assert "Filter" in plan[gathered:] and "replaced" in plan[gathered:]
