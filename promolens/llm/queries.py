"""Registered queries of this subpackage: each applies one operator to its whole
table and returns the columns of that operator's contract."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from promolens.llm import bpe, chat, decontaminate, jaccard, langid, lm, merkle, pieces, quality, suffix, vectors, warc, whitening
from promolens.llm.common import fold, scratch, stored, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path)
    return bpe.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write(warc.plan_revisits(table(spark, sf_dir, "pages")), path)
    number = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")
    back = warc.read(spark, path, verify=True)
    return back.select(
        number("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload"), "payload_length").cast("long").alias("payload_bytes"),
        "payload_digest", "record_type", number("refers_to").alias("refers_to"))


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _chat_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of conversations whose turns come one after the other, in order; only
    the running hashes of one conversation are held."""
    current, count, chars, loss, turns, learned = None, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
    done = []

    def row():
        return current, count, turns.hexdigest(), loss, learned.hexdigest(), chars

    def frame():
        return pd.DataFrame(done, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for batch in batches:
        for conv, role, text, span, n in zip(batch["conversation"], batch["role"], batch["text"], batch["learned"], batch["n"]):
            conv = None if pd.isna(conv) else conv
            if count and conv != current:
                done.append(row())
                count, chars, loss, turns, learned = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            current, count, chars = conv, count + 1, chars + n
            turns.update(f"{role}\n{text}\n".encode())
            if span is not None:
                loss += len(span)
                learned.update(span.encode())
        if done:
            yield frame()
            done = []
    if count:
        done.append(row())
        yield frame()


#: Letters of a streamed delta.
DELTA = 400


def chat_log(rows: DataFrame) -> DataFrame:
    """The event log that leads to ``conversations``: an assistant's text is streamed, begun anew and
    streamed in pieces; other texts are sent as a draft and edited.  Rows of one turn are several messages."""
    ties = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    text = F.coalesce("text", F.lit(""))
    event = lambda kind, t: F.struct(F.lit(kind).alias("kind"), t.alias("text"))
    pieces_ = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % DELTA), F.lit(0))
    again = F.concat(F.array(event("delta", F.lit("A first try")), event("delta", F.lit(", dropped")),
                             event("regenerate", F.coalesce(F.get(pieces_, 0), F.lit("")))),
                     F.transform(F.slice(pieces_, 2, DELTA * 10**6), lambda t: event("delta", t)))
    edited = F.array(event("message", F.lit("A draft")), event("delta", F.lit(" with more")), event("edit", text))
    steps = F.when(F.col("role") == chat.LEARNED, again).otherwise(edited)
    numbered = rows.withColumn("message", F.struct("turn", F.row_number().over(ties).alias("nth")))
    log = numbered.select("conv_id", "message", "role", F.posexplode(steps).alias("step", "_e"))
    return log.select("conv_id", "message", "role", "_e.*", F.struct("message.turn", "message.nth", "step").alias("seq"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text")))
    events = chat_log(rows)
    formatted = stored(chat.render(chat.fold(events)).select("conversation", "place", "formatted", "loss_start", "loss_end"),
                       "chat")
    role, text = chat.parse(F.col("formatted"))
    span = chat.unescape(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    turns = formatted.select("conversation", "place", role.alias("role"), text.alias("text"), span.alias("learned"),
                             F.length("formatted").cast("long").alias("n"))
    return (turns.repartition("conversation").sortWithinPartitions("conversation", "place")
            # as text: pandas would round a nullable number
            .select(F.col("conversation").cast("string").alias("conversation"), "role", "text", "learned", "n")
            .mapInPandas(_chat_digests, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, "
                                        "loss_sha256 string, formatted_chars long")
            .withColumn("conv_id", F.col("conv_id").cast("long")))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "n_matched", "share").distinct()


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 5) == 0
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    score = quality.score(docs, model)
    return (docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold("doc_id", 3) == 1
    model = langid.fit(docs.where(~held_out))
    return (docs.select("doc_id", held_out.alias("held_out"), langid.predict(docs, model).alias("_p"))
            .select("doc_id", "held_out", "_p.lang_pred", "_p.score"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), wanted=16)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")
    encoded = pieces.encode(table(spark, sf_dir, "documents"), path)
    return pieces.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = lambda n: [F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")]
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    changed = merkle.leaf(*fields(F.when(touched, one_more).otherwise(F.col("n_chars"))))
    rows = merkle.manifest(docs.withColumn("tampered", changed), fields(F.col("n_chars")), carry=["tampered"])
    return (rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                        merkle.fold(F.col("tampered"), F.col("proof")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


QUERIES = {
    "op1_lm": op1_lm,
    "op2_bpe": op2_bpe,
    "op3_warc": op3_warc,
    "op4_suffix": op4_suffix,
    "op5_chat": op5_chat,
    "op6_jaccard": op6_jaccard,
    "op7_decontaminate": op7_decontaminate,
    "op8_quality": op8_quality,
    "op9_vectors": op9_vectors,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_pieces": op12_pieces,
    "op13_merkle": op13_merkle,
}
