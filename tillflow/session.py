"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (stored timestamps are
# zone-less), ANSI casts (we use try_* where the reference coerces), AQE for
# runtime coalescing and skew-join splitting, last-wins JSON keys, and no
# web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A repeated key in a JSON message keeps its last value, as Python's
    # JSON reader does (Spark's parser refuses the message otherwise).
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Removes a query's shuffle files when it has ended (Spark 4.1; earlier versions take no notice).
_FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, app: str = "tillflow",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this comes from ``spark.checkpoint.dir`` (a shared file
    system); we only pick a local folder when nothing is configured and the
    master is local, as in tests on one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local"):
            # A machine-local folder would not survive a lost executor and
            # is not visible to the other nodes.
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder there")
        configured = tempfile.mkdtemp(prefix="tillflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "tillflow", *parts, uuid.uuid4().hex])


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`shared_path` named, once nothing reads it any more."""
    if not path.startswith(checkpoint_dir(spark).rstrip("/") + "/tillflow/"):
        raise ValueError(f"{path} isn't a shared path of this session")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind.

    They would stay on the executors' disks until the driver happens to collect its garbage, so the steps of a job
    would add up.  For writes only: a frame that runs a second time would make its shuffles anew."""
    before = spark.conf.get(_FREE_CONF, None)
    spark.conf.set(_FREE_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_CONF)
        else:
            spark.conf.set(_FREE_CONF, before)


def _store(rows: DataFrame, path: str, form: str = "parquet") -> DataFrame:
    with freed_shuffles(rows.sparkSession):
        rows.write.format(form).option("compression", "zstd").save(path)
    return rows.sparkSession.read.schema(rows.schema).format(form).load(path)


def stored(rows: DataFrame, name: str, form: str = "parquet") -> DataFrame:
    """``rows`` as computed once, in compressed columns below the shared checkpoint folder; a checkpoint holds whole
    rows, uncompressed, at several times the size."""
    return _store(rows, shared_path(rows.sparkSession, name), form)


@contextmanager
def stored_while(rows: DataFrame, name: str) -> Iterator[DataFrame]:
    """:func:`stored` rows that are removed behind the block."""
    path = shared_path(rows.sparkSession, name)
    try:
        yield _store(rows, path)
    finally:
        remove_path(rows.sparkSession, path)
