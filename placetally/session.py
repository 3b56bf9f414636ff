"""Session set-up and stored intermediate results in the shared folder."""

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Paths that the library has handed out, by application.
_SCRATCH: dict[str, list[str]] = {}
# Those that belong to a scope of this thread.
_SCOPE = threading.local()


def build_session(app: str = "placetally", **conf: str) -> SparkSession:
    """Session with adaptive execution on; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``.

    Where neither is set, as in a local session, it is a folder of the warehouse,
    which every executor can reach as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, removed by ``clear_scratch`` or at the end of a ``scratch_scope``."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    scope = getattr(_SCOPE, "paths", None)
    (_SCRATCH.setdefault(spark.sparkContext.applicationId, []) if scope is None else scope).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What this thread stores inside is deleted at the end: a batch of a stream leaves nothing behind."""
    before, _SCOPE.paths = getattr(_SCOPE, "paths", None), []
    try:
        yield
    finally:
        paths, _SCOPE.paths = _SCOPE.paths, before
        _delete(spark, paths)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what the library has stored for this application; results that still read it are lost."""
    _delete(spark, _SCRATCH.pop(spark.sparkContext.applicationId, []))


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop).delete(target, True)


def materialized(df: DataFrame, label: str = "stored") -> DataFrame:
    """Write the rows as Parquet to the shared folder once and go on from there.

    This runs a Spark job at once.  The files survive lost executors, cut the
    lineage, and can be read column by column.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A Parquet table, without rows where none has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
