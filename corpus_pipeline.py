"""A training-corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents its predecessor
kept and returns a DataFrame, which is written as Parquet in the checkpoint folder
and read again as the next stage's ``docs``:

1. language ID drops documents whose language cannot be told, or that are read as
   another language than their label says;
2. the n-gram Jaccard join keeps one document (the smallest id) of each group;
3. suffix-array dedup removes strings that a document with a smaller id has;
4. benchmark decontamination drops documents that hold a benchmark item;
5. BPE encoding returns the token ids, checked by decoding them.

All stages but the last return the columns of ``documents``.  Rows with a null id
or text go through stages 2 to 4 unchanged unless a stage's rule names them; stage 1
drops null texts (their language is ``und``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm import bpe, decontaminate, jaccard, langid, suffix
from promolens.llm.common import bounded_broadcast, stored, table
from promolens.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes if its language is read otherwise than labelled with at least this score.
SURE = 0.9
#: Most rows of a decision table that are broadcast; beyond that it is joined.
BROADCAST_ROWS = 1_000_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs)
    told = docs.select(*COLUMNS, langid.predict(docs, model).alias("_p"))
    other = F.col("lang").isNotNull() & (F.col("_p.lang_pred") != F.col("lang")) & (F.col("_p.score") >= SURE)
    return told.where((F.col("_p.lang_pred") != langid.UNKNOWN) & ~other).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard.similar(docs.select(*COLUMNS)).select("doc_id", "component_id").distinct()
    gone = stored(groups.where("doc_id <> component_id").select("doc_id"), "gone")
    kept = docs.select(*COLUMNS).join(bounded_broadcast(gone, BROADCAST_ROWS), "doc_id", "left_anti")
    return kept.select(*COLUMNS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of a letter that is cut in two go with the cut (and, in such a text, replacement letters)."""
    cut = suffix.deduplicate(docs.withColumn("_null", F.col("text").isNull()), carry=["lang", "source", "n_chars", "_null"])
    kept = F.col("kept").cast("string")
    whole = F.when(F.is_valid_utf8(kept), kept).otherwise(F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit("")))
    text = F.when(F.col("n_removed") > 0, whole).when(~F.col("_null"), kept)
    return cut.select("doc_id", text.alias("text"), "lang", "source",
                      F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    gone = stored(leaks.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).distinct(), "leaks")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_row"))
    return docs.select(*COLUMNS).join(bounded_broadcast(gone, BROADCAST_ROWS), same, "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256``.  The ids are stored before they are decoded: else each
    task has two Python workers, all of which stay, with what they hold, while later jobs run."""
    path = tokenizer_path()
    return bpe.decode(stored(bpe.encode(docs, path), "ids"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("benchmark_free", benchmark_free),
    ("tokens", tokens),
]

#: Language ID is a trained network, which SQL cannot express; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       "decoded_sha256")
