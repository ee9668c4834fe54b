"""Session helpers.

The library never changes a caller's session settings, with one exception:
lineage cuts need a checkpoint folder, and when the session has none we set
one - a shared folder is required on a cluster, a scratch folder is made only
for a local master (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  scratch: str | None = None, app: str = "starweave") -> SparkSession:
    """A local session configured the way the tests and bench expect.

    ``scratch`` holds the warehouse, checkpoints and event log; a fresh
    temporary folder is made when it is not given.
    """
    scratch = scratch or tempfile.mkdtemp(prefix="starweave-")
    if os.environ.get("STARWEAVE_EVENT_LOG"):
        os.makedirs(os.path.join(scratch, "events"), exist_ok=True)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STARWEAVE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .config("spark.driver.extraJavaOptions",
                f"-Dderby.system.home={os.path.join(scratch, 'derby')}")
    )
    if os.environ.get("STARWEAVE_EVENT_LOG"):
        # Per-job and per-stage timings, in the scratch folder (the UI stays off).
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", os.path.join(scratch, "events")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only where unset.

    Reads ``spark.checkpoint.dir`` (or a folder already set on the context).
    With neither, a scratch folder is created for a local master; on a
    cluster a machine-local folder would lose checkpoints with the executor,
    so we refuse instead.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect client has no context: use the setting
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set") from None
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="starweave-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a shared folder "
        "(HDFS/S3/ABFS) that every executor can reach"
    )


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet under the session's checkpoint folder and read
    it back.

    A lineage cut that survives lost executors (the files are on shared
    storage and committed atomically) and, unlike an RDD checkpoint, a
    columnar table later passes can prune to the columns they read.  It is
    compressed with zstd, smaller than the default.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # no job to infer what is known


# The folder that ``stored`` writes to inside ``owned_scratch``.
_OWNED: ContextVar[str | None] = ContextVar("starweave_scratch", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder of the innermost
    ``owned_scratch``, else one under the checkpoint folder."""
    return _OWNED.get() or f"{ensure_checkpoint_dir(spark).rstrip('/')}/starweave"


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for everything ``stored`` writes in the block,
    deleted at its end: results must have been written elsewhere by then."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/starweave-{uuid.uuid4().hex}"
    token = _OWNED.set(folder)
    try:
        yield folder
    finally:
        _OWNED.reset(token)
        delete_path(spark, folder)
