"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import math
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that one task is dealt where each word becomes a row.
TASK_TEXT = 1 << 24


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting (a laptop, a test) gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="corpusvec-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table under the shared folder."""
    return f"{scratch_root(spark)}/corpusvec/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash rows over the cores when a scan yields fewer splits than cores.

    A large table already has more splits than cores and is returned as it is,
    so this shuffle only ever happens on inputs that fit in a few files. Call
    it on a plain scan: counting splits of a plan with shuffles would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * 2, key)


def spread_work(df: DataFrame, key: str) -> DataFrame:
    """Hash rows by ``key`` for work that costs far more than its few bytes.

    A number of partitions that is asked for is not merged down by size. It is
    the session's shuffle partitions, which are set for the size of the data,
    and at least a few for each core.
    """
    spark = df.sparkSession
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(session, 4 * spark.sparkContext.defaultParallelism), key)


def tasks_of_text(df: DataFrame, text: str) -> int:
    """Tasks that hold about `TASK_TEXT` bytes of a text column each, and two for each core at least."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_TEXT))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, once.

    A job submitted with ``--py-files`` does not need it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="corpusvec-"), "corpusvec"),
        "zip", os.path.dirname(package), os.path.basename(package),
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
