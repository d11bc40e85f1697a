"""Sinks: staged touches and the date-partitioned mart (K1-K5)."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.sources.schemas import MART_SCHEMA, TOUCH_SCHEMA
from promolens.sources.tables import read_touches


def to_mart(df: DataFrame) -> DataFrame:
    """K3/K4: columns in mart order with mart types (partition column last).
    ``gmve`` goes through DOUBLE to FLOAT (values are summed exactly first)."""
    cols = []
    for f in MART_SCHEMA.fields:
        c = F.col(f.name)
        if f.name == "gmve":
            c = c.cast("double")
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _by_day(df: DataFrame) -> DataFrame:
    """Rows of a day together, in pieces that adaptive execution sizes: few
    files for each day, and a large day is still split."""
    return to_mart(df).hint("rebalance", F.col("fecha"))


#: Partition column of a table that keeps runs apart.
RUN = "run_date"


def _quoted(name: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def create_mart_table(spark: SparkSession, table: str, location: str | None = None, by_run: bool = False) -> None:
    """K3: the mart as a catalog table with the declared columns and types,
    partitioned by ``fecha`` (with ``by_run`` by run date and ``fecha``).

    With a ``location`` the table is external: dropping it keeps the files, and
    folders that were written there by path are seen after
    ``register_partitions``.  A table that exists is left as it is, but must
    have the mart's columns."""
    partitions = [T.StructField(RUN, T.DateType())] if by_run else []
    fields = [*MART_SCHEMA.fields[:-1], *partitions, MART_SCHEMA.fields[-1]]
    if spark.catalog.tableExists(table):
        have = {f.name.lower(): f.dataType for f in spark.table(table).schema.fields}
        wrong = [f.name for f in fields if have.get(f.name.lower()) != f.dataType]
        if wrong or len(have) != len(fields):
            raise ValueError(f"table {table} has not the columns of the mart: {wrong or sorted(have)}")
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    by = ", ".join(f"`{f.name}`" for f in [*partitions, MART_SCHEMA.fields[-1]])
    at = "" if location is None else " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"CREATE TABLE {_quoted(table)} ({columns}) USING parquet PARTITIONED BY ({by}){at}")


def register_partitions(spark: SparkSession, table: str) -> None:
    """Make the table see partition folders that were written by path (or are gone)."""
    spark.sql(f"MSCK REPAIR TABLE {_quoted(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def append_mart(df: DataFrame, target: str, table: str | None = None) -> None:
    """K4/K5: dynamic-partition append by ``fecha`` (the reference's mode: a
    rerun appends again).  ``target`` is a path or a catalog table, which is
    created with the mart's columns when it does not exist.  ``table``: the
    external table over a path, whose partitions are then registered."""
    rows = _by_day(df)
    if _is_path(target):
        rows.write.mode("append").partitionBy("fecha").parquet(target)
        if table is not None:
            register_partitions(df.sparkSession, table)
        return
    create_mart_table(df.sparkSession, target)
    rows.write.insertInto(target)


def write_mart_run(df: DataFrame, target: str, run_date, table: str | None = None) -> str:
    """Idempotent variant of K4: a rerun replaces exactly its own run, even when
    it wrote other ``fecha`` partitions (attributed rows are filtered by creation
    date but partitioned by winning date).

    ``target`` is a path, where the run's rows live under
    ``run_date=<date>/fecha=<day>/``, or a catalog table partitioned by both,
    which is created when it does not exist.  ``table`` as in ``append_mart``."""
    if isinstance(run_date, str):
        run_date = _dt.date.fromisoformat(run_date)
    spark, day = df.sparkSession, run_date.isoformat()
    if _is_path(target):
        at = f"{target.rstrip('/')}/{RUN}={day}"
        _by_day(df).write.mode("overwrite").partitionBy("fecha").parquet(at)
        if table is not None:
            register_partitions(spark, table)
        return at
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "static":
        raise RuntimeError("with dynamic partition overwrite a rerun would keep days that it no longer writes")
    create_mart_table(spark, target, by_run=True)
    view = f"mart_run_{uuid.uuid4().hex}"
    _by_day(df).createOrReplaceTempView(view)
    try:
        # a given run date and any day: all partitions of the run are replaced in one commit
        columns = ", ".join(f"`{f.name}`" for f in MART_SCHEMA.fields)
        spark.sql(f"INSERT OVERWRITE TABLE {_quoted(target)} PARTITION (`{RUN}` = DATE'{day}', `fecha`) SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    return target


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """Read the mart (a path or a table) back with its schema (``fecha`` as
    text); a ``run_date`` folder level, if present, is dropped."""
    if not _is_path(path):
        return spark.table(path).select(*[F.col(f.name).cast(f.dataType) for f in MART_SCHEMA.fields])
    df = (spark.read.option("basePath", path)
          .option("recursiveFileLookup", "false").parquet(path))
    df = df.withColumn("fecha", F.col("fecha").cast("string"))
    return df.select(*[f.name for f in MART_SCHEMA.fields])


def stage_touches(df: DataFrame, path: str) -> DataFrame:
    """K1: materialise the extracted touches as Parquet in a shared folder
    and return the re-read frame (cuts lineage; survives executor loss)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TOUCH_SCHEMA.fields if f.name in df.columns]
    return read_touches(df.sparkSession, stage(df.select(*cols), path))


def stage(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet in a fresh shared folder and read again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staged(spark: SparkSession, path: str) -> None:
    """Delete a staging folder, on any file system Spark reaches, when what was
    built on it has been written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
