"""Session helpers: building a session and locating the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "fieldwatch", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings the library is tuned for.

    AQE stays on (it coalesces small shuffle partitions and splits skewed join
    partitions at run time); the UI is off; time zone is UTC.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # remove reliable-checkpoint files once their DataFrames are gone
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``SparkContext.getCheckpointDir`` or the
    ``spark.checkpoint.dir`` setting). Only when neither is set *and* the
    master is local (tests, a laptop) is a private scratch folder created; on a
    cluster an unset folder is an error, because a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        d = tempfile.mkdtemp(prefix="fieldwatch-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


ARROW_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_by_rows(spark: SparkSession):
    """Jobs run inside cut their Arrow batches by rows (``maxRecordsPerBatch``) alone. The
    limit in bytes makes Spark measure the whole batch again after each row, which costs
    ordered passes over short rows more than all else they do. A limit in bytes that the
    session sets itself stays, as does Spark's own where there is none in rows."""
    if spark.conf.get(ARROW_BYTES_CONF, None) is not None or int(spark.conf.get(ARROW_ROWS_CONF)) <= 0:
        yield
        return
    spark.conf.set(ARROW_BYTES_CONF, str(2 ** 31 - 1))
    try:
        yield
    finally:
        spark.conf.unset(ARROW_BYTES_CONF)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, made now, of short rows that come through ordered passes."""
    checkpoint_dir(df.sparkSession)
    with batches_by_rows(df.sparkSession):
        return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back. Lineage is
    cut, and a join on the result sees a plain scan and exchange instead of an
    aggregate, so adaptive execution can split a hot key of the other side."""
    return written_copy(df, name)[0]


def written_copy(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`written`, with the folder, for an owner who removes it in the end."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def default_parallelism(spark: SparkSession) -> int:
    try:
        return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    except Exception:  # pragma: no cover
        return max(spark.sparkContext.defaultParallelism, 1)
