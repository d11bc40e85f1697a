"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.session import checkpoint_dir
from promolens.sources.mart import remove_staged

#: White space that separates words, as a regular-expression class.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, _UPPER, _LOWER)


def fold(key: str, k: int) -> Column:
    """``crc32`` of the id as text modulo ``k``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % k


def scratch(spark: SparkSession, prefix: str) -> str:
    """A fresh folder name under the session's checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def stored(df: DataFrame, prefix: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the checkpoint folder and read back:
    cuts the lineage in storage that every executor can read.  ``options`` are the writer's."""
    spark = df.sparkSession
    path = scratch(spark, prefix)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: what was made of them is stored itself."""
    for t in tables:
        remove_staged(t.sparkSession, t.stored_at)


def pieces(total_bytes: int, each: int) -> int:
    """How many pieces of about ``each`` bytes hold ``total_bytes``."""
    return max(1, -(-int(total_bytes) // int(each)))


def local_path(uri: str) -> str | None:
    """The file-system path of a ``file:`` URI or a plain path, else None."""
    m = re.match(r"^(?:file:(?://)?)?(/.*)$", uri)
    return m[1] if m else None


def give_back() -> None:
    """Return the freed memory of a Python worker to the system when a task ends: later stages use the same
    workers, and what earlier ones once needed would stay with them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps what it has


def keep_freed() -> None:
    """Let a Python worker use freed memory again at once, up to 64 MB of it, and not give it to the system and take
    it back, page by page, for every array of some MB.  ``give_back`` returns it when the task ends."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD: larger blocks go back on their own
        libc.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):
        pass  # another C library


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows; else as it is.
    ``df`` must be cheap to count, such as a stored table."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
