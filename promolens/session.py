"""Session helpers.

Library functions never change session state on their own; these helpers are
for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

#: Settings every job of this package is planned and tested with.  UTC keeps
#: wall-clock text and epoch seconds aligned in the tests; the library itself
#: does not depend on the zone (24 h is always 86,400 s, see functions.timefmt).
#: Broadcasts are decided only by AQE from measured runtime sizes: the static
#: estimate-based threshold is off, the adaptive one is explicit.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.ui.enabled": "false",
}

#: Starting point for a large cluster (100 TB-class click-stream).  Many
#: initial shuffle partitions so that no post-shuffle partition outgrows
#: executor memory before AQE coalesces them to ~256 MB; file splits of the
#: same order; a partition counts as skewed at 4x the median and 512 MB, and
#: is then split by AQE.  Broadcasts stay runtime-measured (64 MB cap).
SCALE_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "promolens", extra: dict | None = None) -> SparkSession:
    """Get or create a session with the recommended settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the context).

    Only a local master may go without: then a scratch folder is made for the
    context.  On a cluster a machine-local folder would be invisible to the
    other machines, so there an unset folder is an error."""
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="promolens-ckpt-", dir=os.environ.get("PROMOLENS_SCRATCH")))
    return context.getCheckpointDir()
