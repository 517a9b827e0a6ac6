"""Scans (S1-S6).

TSV is a landing format only: scan it once with explicit schema and options,
then keep Parquet. Every reader takes an explicit ``StructType``; nothing infers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.sources import ranges

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as Parquet (column pruning and filter pushdown apply)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Characters that end a policy and its name in files of many policies.
RECORD_END, NAME_END = "\u001e", "\u001f"


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan over at least the cluster's task slots.

    A big table arrives in many file splits and is returned unchanged (no extra
    shuffle, every optimisation intact). A table stored as a few large row
    groups would run its CPU-heavy text work in a handful of tasks; it is
    hash-partitioned on ``keys`` (round-robin without keys).

    Catalyst pushes deterministic filters below a repartition, which would move
    an expensive filter (say, on a regex-derived label) back into those few
    scan tasks. So the first key is passed through a no-op that depends on the
    partition id: the projection is then nondeterministic and later filters
    stay above the exchange, where the work is spread.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # sessions without RDD access: leave the scan as planned
        return df
    spread = df.repartition(target, *keys) if keys else df.repartition(target)
    pin = keys[0] if keys else df.columns[0]
    return spread.withColumn(pin, F.when(F.spark_partition_id() >= 0, F.col(pin)))


def text_table(spark: SparkSession, sf_dir: str, name: str, key: str, *cols: str) -> DataFrame:
    """A text-heavy driver table, pruned to ``cols`` and spread for CPU work."""
    df = table(spark, sf_dir, name)
    if cols:
        df = df.select(*cols)
    return balanced(df, key)


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    malformed: str = "keep",
    range_bytes: int | None = None,
) -> DataFrame:
    """Header TSV, BOM tolerant, quoted multi-line cells, doubled quotes.

    Files are cut into ranges of ``range_bytes``, each read by a task of its own
    (``sources.ranges``), with the same rows as one task would read. By default
    that is done where a file is larger than two ranges of the usual size; 0: never.

    Cells are read like Python's ``csv`` module: an empty cell is ``''`` (the
    null marker is set to a character that never occurs in text), so a *null*
    field can only mean the physical record was short. ``n_fields`` counts the
    fields present. ``malformed='keep'`` returns every record (a fixer passes
    short rows through); ``'skip'`` drops records with fewer fields than the
    schema (the audit's behaviour). Extra fields of over-long rows are ignored.
    """
    how = dict(sep="\t", quote='"', escape='"', multiLine=True, mode="PERMISSIVE", nullValue="\u0000", emptyValue="")
    if range_bytes is None:
        range_bytes = ranges.RANGE_BYTES if largest_file(spark, path) > 2 * ranges.RANGE_BYTES else 0
    if range_bytes:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        record = F.from_csv("record", ddl, {k: str(v) for k, v in how.items()})
        df = ranges.read_records(spark, path, header, range_bytes=range_bytes).select(record.alias("r")).select("r.*")
    else:
        df = spark.read.schema(schema).csv(path, header=header, encoding="UTF-8", **how)
    present = [F.col(f.name).isNotNull().cast("int") for f in schema.fields]
    n_fields = present[0]
    for c in present[1:]:
        n_fields = n_fields + c
    df = df.withColumn("n_fields", n_fields.cast("int"))
    if malformed == "skip":
        df = df.filter(F.col("n_fields") >= len(schema.fields))
    elif malformed != "keep":
        raise ValueError("malformed must be 'keep' or 'skip'")
    return df


def literal_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """S3: an inline dataset (seed pairs, override maps, policy domains)."""
    return spark.createDataFrame(list(rows), schema=schema)


def read_policy(spark: SparkSession, path: str) -> DataFrame:
    """A whole policy/prompt file as a one-row ``(path, policy)`` relation."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.col("value").alias("policy")
    )


def read_policies(spark: SparkSession, path: str) -> DataFrame:
    """S5 for many policies: files of ``sinks.write_policies`` as (name, policy),
    a row for every policy however few files hold them."""
    lines = spark.read.option("lineSep", RECORD_END).text(path)
    cut = F.instr("value", NAME_END)
    return lines.select(F.substring("value", F.lit(1), cut - 1).alias("name"), F.substring("value", cut + 1, F.length("value")).alias("policy"))


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file under ``path`` (a file, folder or pattern)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for top in fs.globStatus(hpath) or [] for s in ([top] if top.isFile() else fs.listStatus(top.getPath()))]
    return max((s.getLen() for s in found), default=0)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """A previous output if it exists, else an empty relation of ``schema``."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


def ingest_dataset(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> None:
    """S4 (landing half): write any labelled DataFrame, one folder a split, as
    Parquet or as TSV (header, quoted cells; ``read_tsv`` adds the split back)."""
    from textguard.sources import sinks

    sinks.write_splits(df, path, split_col, fmt)
