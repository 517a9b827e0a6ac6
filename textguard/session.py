"""Session helpers: a local session for tests/bench, and lineage cutting.

On a cluster the caller owns the session; we only *read* ``spark.checkpoint.dir``
and fall back to a scratch directory when running in local mode with nothing set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "textguard") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TEXTGUARD_DRIVER_MEMORY", "16g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; we honour it.
    Only a local-mode session with nothing configured gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="textguard-ckpt-"))
    return sc.getCheckpointDir()


#: Tables written for intermediate results by this process, until ``release``.
_written: list[str] = []


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new path under the checkpoint folder for an intermediate table."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove the intermediate tables that this process wrote; their number.

    To be called when the results made from them were written or are no longer
    needed: a DataFrame that still reads one of them fails afterwards."""
    jvm, done = spark.sparkContext._jvm, 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        done += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return done


def materialize(df: DataFrame, name: str, session: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back (in
    ``session``, if that isn't the one of ``df``).

    Cuts lineage like a reliable checkpoint, but in one pass (no recomputation for
    the write), and keeps a columnar copy, so later readers prune columns.
    """
    spark = df.sparkSession
    path = scratch_table(spark, name)
    df.write.parquet(path)
    return (session or spark).read.parquet(path)


# Relations up to this many rows may be broadcast after they are counted.
BROADCAST_MAX_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, rows_at_most: int | None = None) -> DataFrame:
    """Broadcast ``df`` only under a proven bound, else leave the join to a
    shuffle. The bound is either known by construction (``rows_at_most``: the
    output of a ``limit`` or of a global aggregate) or established by counting
    - cheap for relations small by construction (one row per class, stratum
    or bucket)."""
    from pyspark.sql import functions as F

    n = rows_at_most if rows_at_most is not None else df.count()
    return F.broadcast(df) if n <= max_rows else df
