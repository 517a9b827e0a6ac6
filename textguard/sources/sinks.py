"""Sinks (K1-K6). Directory datasets written by tasks in parallel; nothing is
funnelled through the driver or a single task.

TSV is written only where a human or another tool needs it; Parquet is the
internal format.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.functions import text as tx
from textguard.session import materialize


def _fs(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _tsv(writer):
    return writer.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')


def write_tsv(df: DataFrame, path: str) -> None:
    """K1: overwrite a TSV dataset (header per part file, quoted cells)."""
    _tsv(df.write.mode("overwrite")).csv(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K2 on a plain folder; every part carries its own header when TSV, so the
    'header written once' problem of a single file does not arise. A retried call
    adds its rows again: use ``snapshots.Dataset.append`` with a token where
    batches may be retried."""
    w = df.write.mode("append")
    if fmt == "tsv":
        _tsv(w).csv(path)
    else:
        w.format(fmt).save(path)


def parallel_pairs(df: DataFrame, split_col: str, order_cols, source: str = "source", target: str = "target", keep=(), buckets=None) -> DataFrame:
    """K3 relation: (split, line_no, *keep, src, tgt), newlines folded to spaces so
    one record is one line on both sides. ``order_cols`` must be a total order;
    ``buckets`` as in ``global_index``."""
    from textguard.operators.index import global_index

    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    ix = global_index(df.select(*dict.fromkeys([split_col, *order, *keep, source, target])), order, strata=[split_col], out="_i", buckets=buckets)
    return ix.select(
        F.col(split_col).alias("split"),
        (F.col("_i") + 1).alias("line_no"),
        *keep,
        tx.one_line(F.col(source)).alias("src"),
        tx.one_line(F.col(target)).alias("tgt"),
    )


def write_parallel(pairs: DataFrame, path: str, lines_per_part: int = 1_000_000) -> None:
    """K3: line-aligned ``src`` and ``tgt`` text outputs per split.

    The pair relation is pinned once. A record's part follows from its line
    number alone, and each part is one task's sorted rows, so part k of ``src``
    and of ``tgt`` hold the same lines in line order whatever files or spills
    lie between (concatenate ``part=0``, ``part=1``, ... for one file per side).
    """
    laid = materialize(pairs.select("split", "line_no", "src", "tgt"), "pairs").withColumn("part", F.expr(f"(line_no - 1) div {int(lines_per_part)}"))
    for side in ("src", "tgt"):
        rows = laid.select("split", "part", "line_no", F.col(side).alias("value")).repartition("split", "part")
        # The order holds the writer's own (split, part), so nothing is sorted again.
        rows.sortWithinPartitions("split", "part", "line_no").drop("line_no").write.mode("overwrite").partitionBy("split", "part").text(f"{path}/{side}")


def write_splits(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> None:
    """K4: one directory per split (partition pruning on read)."""
    w = df.write.mode("overwrite").partitionBy(split_col)
    if fmt == "tsv":
        _tsv(w).csv(path)
    else:
        w.format(fmt).save(path)


def write_policies(df: DataFrame, path: str, name: str, policy: str) -> None:
    """S5 for many policies: as many files as ``df`` has partitions, each holding
    policies one after the other, read back by ``readers.read_policies``. A text
    that holds one of the two separators is refused."""
    from textguard.sources.readers import NAME_END, RECORD_END

    bad = F.col(policy).contains(RECORD_END) | F.col(policy).contains(NAME_END) | F.col(name).cast("string").contains(NAME_END)
    body = F.concat(F.col(name).cast("string"), F.lit(NAME_END), F.coalesce(F.col(policy), F.lit("")))
    checked = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit("a policy holds a separator")).cast("string")).otherwise(body)
    df.select(checked.alias("value")).write.mode("overwrite").option("lineSep", RECORD_END).text(path)


def route_write(df: DataFrame, route_col: str, path: str, fmt: str = "parquet") -> None:
    """K5: passed / blocked (any routes) in one pass, one directory per route.
    Adds to the routes there are, so a resumed run keeps what it wrote before."""
    w = df.write.mode("append").partitionBy(route_col)
    if fmt == "tsv":
        _tsv(w).csv(path)
    else:
        w.format(fmt).save(path)


def replace_dataset(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K6: rewrite a dataset in place without ever overwriting the path being read.

    Write a staging directory next to it, then swap with two renames (old ->
    backup, staging -> path) and drop the backup. On HDFS each rename is atomic;
    on object stores the swap is not, and a driver lost between the two renames
    leaves the rows in the backup folder only: ``snapshots.Dataset.replace`` has
    no such step.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    backup = f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    df.write.mode("overwrite").format(fmt).save(staging)
    fs, target = _fs(spark, path)
    _, stage_p = _fs(spark, staging)
    _, backup_p = _fs(spark, backup)
    had_old = fs.exists(target)
    if had_old and not fs.rename(target, backup_p):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(stage_p, target):
        if had_old:
            fs.rename(backup_p, target)
        raise OSError(f"could not publish {staging} as {path}")
    if had_old:
        fs.delete(backup_p, True)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Land a table bucketed and sorted on ``key`` (e.g. documents and labels on
    doc_id with the same bucket count) so later joins and aggregations on the key
    read co-located buckets and plan no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
