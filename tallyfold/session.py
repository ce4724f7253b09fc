"""Session set-up and the one way this library cuts lineage: a table written to shared storage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tallyfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. Cluster settings win over the ones given here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tallyfold-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_STAGED: dict[str, list[str]] = {}  # application to the tables it has staged
_RECORD: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The tables staged inside the block, by this thread alone."""
    paths: list[str] = []
    token = _RECORD.set(paths)
    try:
        yield paths
    finally:
        _RECORD.reset(token)


def stage_table(df: DataFrame, label: str = "stage", codec: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and read it back; ``codec`` names another compression than the session's.

    The result has no lineage, survives the loss of any executor, never changes between uses and
    has a known size on disk, so the optimizer broadcasts it only when it is really small.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyfold/{label}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    if _RECORD.get() is not None:
        _RECORD.get().append(path)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs now; it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged(spark: SparkSession) -> list[str]:
    """The tables this application has staged and not removed, in order."""
    return list(_STAGED.get(spark.sparkContext.applicationId, []))


def drop_staged(spark: SparkSession, paths: list[str]) -> None:
    """Remove staged tables. Only for a caller who has written what was made from them."""
    hadoop, own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, _STAGED.get(spark.sparkContext.applicationId, [])
    for path in paths:
        if path in own:
            own.remove(path)
            place = hadoop(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    release_shuffles(spark)
