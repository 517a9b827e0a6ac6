"""Helpers shared by the training-data operators.

``pin`` writes a relation to the shared checkpoint folder and reads it back, so
what follows survives lost executors and never recomputes the step before.
``spread_groups`` deals the rows of a class (an arc, a length, a bucket) over as
many window groups as its size asks for, so ranks inside a class that holds a
third of all rows are still computed by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from textguard.session import scratch_table

# Window groups that spread_groups makes, beside one for each class.
GROUPS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as make it new to ``df``."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def pin(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (``session.release`` removes it)."""
    path = scratch_table(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a key of its rows, ``name`` (binary, never null), that is the
    same each time they are read.

    A row of Parquet files is known by its file and its place in it, which don't
    depend on how a job cuts the files into splits: the key is a 128-bit digest
    of both. Any other input is written to the shared folder first."""
    if not _is_scan(df):
        return numbered(pin(df, "numbered"), name)
    meta = df.metadataColumn("_metadata")
    known = F.unhex(F.md5(F.concat_ws("#", meta["file_path"], meta["row_index"].cast("string"))))
    # Not nullable, so that no join plants a filter of its own above one reading of the rows.
    return df.withColumn(name, F.coalesce(known, F.lit(b"")))


def _is_scan(df: DataFrame) -> bool:
    """Is ``df`` a scan of Parquet files, each read once, with projections and
    filters only? Looks at the plan, not at the files."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().apply(0)
    if node.nodeName().split(" ")[0] not in ("Relation", "LogicalRelation") or node.relation().toString().lower() != "parquet":
        return False
    roots = node.relation().location().rootPaths()
    paths = sorted(f"{roots.apply(i).toString().rstrip('/')}/" for i in range(roots.size()))
    return not any(b.startswith(a) for a, b in zip(paths, paths[1:]))


def crc_of(col: Column) -> Column:
    """CRC-32 of the UTF-8 text of ``col`` (unsigned, as bigint)."""
    return F.crc32(F.encode(col.cast("string"), "UTF-8"))


def spread_groups(rows: DataFrame, cls: str, uid: str, total: int, groups: int = GROUPS) -> DataFrame:
    """Add ``sub``: the window group of a row inside its class.

    A class with a share p of the ``total`` rows gets ceil(p * groups) groups,
    so every group holds about total / groups rows whatever the skew. The
    classes must be bounded in number: one row for each is broadcast.
    """
    per_class = rows.groupBy(cls).agg(F.ceil(F.count(F.lit(1)) * F.lit(float(groups) / max(total, 1))).cast("long").alias("_k"))
    return rows.join(F.broadcast(per_class), cls).withColumn("sub", F.pmod(F.xxhash64(uid), F.greatest("_k", F.lit(1)))).drop("_k")


def rank_in(group_cols: list[str], order_cols: list[str]) -> Column:
    """0-based rank of a row inside its window group."""
    return (F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order_cols)) - 1).cast("long")


def fields(**types: str) -> T.StructType:
    """A schema by column names and simple type names, without a session."""
    kinds = {"long": T.LongType, "int": T.IntegerType, "string": T.StringType, "binary": T.BinaryType, "double": T.DoubleType}
    return T.StructType([T.StructField(name, kinds[kind]()) for name, kind in types.items()])


def nullable(kind: T.DataType) -> T.DataType:
    """``kind`` as it is read back from Parquet: nullable at every depth."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType))
    return kind


def sliced(batches, rows: int = 1000):
    """Arrow batches cut to ``rows`` rows, which bounds what a step holds at once."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker: tokenizers and memos that
    are loaded once and serve every task the worker gets."""
    import sys
    import types

    return sys.modules.setdefault("_textguard_worker_cache", types.ModuleType("_textguard_worker_cache")).__dict__
