"""Session construction and the shared work folder.

Jobs cut lineage by writing tables (or `checkpoint()`) under the folder named by
`spark.checkpoint.dir`.  On a cluster that setting points at shared storage and
is read from the session; only when it is unset (local tests, the bench) do we
set our own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Bytes of input files that a shuffle has a partition for, before AQE puts
#: small ones together, and the most partitions that are asked for.
PARTITION_INPUT = 8 << 20
MOST_PARTITIONS = 20_000
#: The bytes to which AQE fills a partition.
PARTITION_FILL = 32 << 20

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "casefile", extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CASEFILE_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_settings(spark)
    return spark


def ensure_session_settings(spark: SparkSession) -> None:
    """Settings every operator relies on (UTC dates, AQE).  Idempotent.

    Joins without a hint are broadcast by what AQE has measured, up to the
    session's threshold.  Before a query runs the size of a table is its files',
    in which keys and repeated values take a byte or less a row: a table of a
    hundred times the threshold would be sent through the driver.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    planned = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if planned != "-1":
        if spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", planned)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def size_shuffles(spark: SparkSession, folder: str) -> None:
    """Shuffles begin with as many partitions as the files of `folder` fill, so
    that a task's rows do not grow with the input; AQE puts small ones together.
    Reads names and lengths alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    size = files.agg(F.sum("length")).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                   str(max(least, min(MOST_PARTITIONS, -(-size // PARTITION_INPUT)))))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(PARTITION_FILL, _size(spark))))


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle begins with."""
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
               or spark.conf.get("spark.sql.shuffle.partitions"))


def _size(spark: SparkSession) -> int:
    """The session's advisory size, given as `64MB`, `8m` or a number."""
    text = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").strip().lower()
    digits = text.rstrip("bkmgt")
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[text[len(digits):].rstrip("b")]


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Read from `spark.checkpoint.dir`; when unset (tests, local runs) a fresh
    folder is created once and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = sc._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="casefile-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path under the checkpoint root, unique to this application."""
    app = spark.sparkContext.applicationId
    return "/".join([checkpoint_root(spark), "casefile", app, *parts])
