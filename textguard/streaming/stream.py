"""Structured Streaming forms of the moderation rules.

The batch operators are reused unchanged on streaming DataFrames: the labeller
and the threshold decision are stateless, their routes written once (T1); dedup keeps the last kept times of the keys, as the engine's state, until the watermark
passes them by the delay (T2); the manner
score is a tumbling-window count with a watermark so state is bounded and late
rows are dropped (T3). Sinks and stream checkpoints live under the session's
checkpoint directory (a shared folder on a cluster).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.operators import policy
from textguard.session import ensure_checkpoint_dir
from textguard.sources.readers import table
from textguard.sources.snapshots import Dataset


def read_stream(spark: SparkSession, directory: str, schema, glob: str = "*.parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream over the files of ``directory`` matching ``glob``,
    with an explicit schema (new files are picked up as they land)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(directory)


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table as a stream, whether it is one Parquet file or a folder of them."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hpath).isDirectory()
    schema = table(spark, sf_dir, name).schema
    return read_stream(spark, *((path, schema) if folder else (sf_dir, schema, f"{name}.parquet")), max_files_per_trigger=max_files_per_trigger)


def moderate_stream(docs: DataFrame, text: str = "text", id_col: str = "doc_id", labels: DataFrame | None = None) -> DataFrame:
    """Per-message rule labelling (R11) on a stream, no state.

    With ``labels`` (a static table of toxic/quality flags) each message is
    enriched by a stream-static left join first, so provenance tags are kept."""
    if labels is None:
        return policy.label(docs, text_col=text, id_col=id_col, toxic_col=None, quality_col=None)
    return policy.label(docs.join(labels.select(id_col, "toxic", "quality"), id_col, "left"), text_col=text, id_col=id_col)


def run_routed(stream: DataFrame, name: str, path: str, route: Callable[[DataFrame], DataFrame] = policy.route) -> Dataset:
    """T1 with F12: drain a labelled stream into the dataset under ``path``, one
    partition a route, every message once.

    Each micro-batch is one commit whose token is the stream's name and the
    batch's number: a batch that is run again, because the driver was lost before
    Spark noted its end, finds its token in the log and adds nothing. The stream's
    own checkpoint lies beside the data, so a later call goes on where this one
    ended. What a lost attempt wrote is read by nobody (``Dataset.vacuum``)."""
    sink = Dataset(stream.sparkSession, path, partition_by=("route",))

    def each(batch: DataFrame, number: int) -> None:
        sink.append(route(batch), token=f"{name}/{number}")

    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{sink.path}/checkpoints/{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return sink


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


#: Buckets that the keys of a stream are dealt over; its state has one row for each.
DEDUP_BUCKETS = 4096

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _identity(schema: T.StructType, keys: list[str]):
    """One string for the values of ``keys``, equal where grouping by them is."""

    def exact(name):
        kind = schema[name].dataType
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(name)
        return F.col(name) + F.lit(0.0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(name)  # -0.0 is 0.0

    values = F.struct(*(exact(k).alias(f"k{i}") for i, k in enumerate(keys)))
    return F.to_json(values, {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def stream_dedup(df: DataFrame, keys, ts: str = "ts", delay: str = "10 minutes", buckets: int = DEDUP_BUCKETS) -> DataFrame:
    """Drop an event if the previous *kept* event of its key is at most
    ``delay`` earlier.

    The state is the engine's (``applyInPandasWithState``): the times of the last
    kept events of a bucket's keys. A time ends once the watermark (the latest time of the
    micro-batches before, less ``delay``) is ``delay`` past it. Inside a micro-batch
    events are taken in event-time order (ties by the other columns), so the kept
    rows don't depend on their order in the files; micro-batches must follow event
    time, and an event older than the watermark is late and dropped. Events without
    a time are dropped.

    Scale: keys are dealt over ``buckets`` by hash, since a call of Python for each key
    costs milliseconds however few events it has. One bucket's events go to one task, which
    holds of each key the first event of every instant, while the others stream by; bound
    the micro-batch (``max_files_per_trigger``) to bound that. A stream's number of
    buckets is part of its checkpoint: it stays as it was begun."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    keys = list(keys)
    gap = int(pd.Timedelta(delay).total_seconds() * 1_000_000)
    timed = event_time(df, ts)
    names = timed.columns
    # Times travel as microseconds; the event-time column is there for the watermark.
    # Integers travel with a flag, as pandas makes a column of them with nulls one of floats.
    flags = {f.name: f"_null_{f.name}" for f in timed.schema if isinstance(f.dataType, _INTEGERS)}
    key = _identity(timed.schema, keys)
    sent = {"_us": F.unix_micros(F.col(ts)), "_key": key, "_bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")}
    sent |= {flag: F.col(n).isNull() for n, flag in flags.items()}
    rows = timed.filter(F.col(ts).isNotNull()).withColumns(sent).fillna(0, list(flags)).withWatermark(ts, delay)
    out = T.StructType([T.StructField("_us", T.LongType()), *(f for f in timed.schema if f.name != ts), *(T.StructField(f, T.BooleanType()) for f in flags.values())])
    order = ["_key", "_us", *(c for n in names if n != ts for c in ([flags[n], n] if n in flags else [n]))]

    def firsts(parts):
        return pd.concat(parts, ignore_index=True).sort_values(order, kind="stable").drop_duplicates(["_key", "_us"], ignore_index=True)

    def first_of_instants(parts):
        held, size, least = [], 0, 100_000
        for part in parts:
            held.append(part[order])
            size += len(part)
            if size > least:
                held = [firsts(held)]
                size = len(held[0])
                least = max(least, 2 * size)
        return firsts(held)

    def fold(bucket, parts, state):
        if state.hasTimedOut:
            state.remove()
            return
        mark = state.getCurrentWatermarkMs()
        last = dict(zip(*state.get)) if state.exists else {}
        held, kept = first_of_instants(parts), []
        for i, (k, t) in enumerate(zip(held["_key"].tolist(), held["_us"].tolist())):
            before = last.get(k)
            if before is None or t > before + gap:
                last[k] = t
                kept.append(i)
        last = {k: t for k, t in last.items() if t + gap >= mark * 1000}
        if last:
            state.update((list(last), list(last.values())))
            state.setTimeoutTimestamp(max((max(last.values()) + gap) // 1000, mark) + 1)
        elif state.exists:
            state.remove()
        if kept:
            yield held.iloc[kept][out.names]

    held = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("last", T.ArrayType(T.LongType()))])
    done = rows.groupBy("_bucket").applyInPandasWithState(fold, out, held, "append", GroupStateTimeout.EventTimeTimeout)
    back = {n: F.when(~F.col(flag), F.col(n)) for n, flag in flags.items()}
    return done.withColumns({ts: F.timestamp_micros("_us"), **back}).select(*names)


def manner_score(df: DataFrame, ts: str = "ts", window: str = "1 hour", delay: str = "10 minutes", bad: str = "error") -> DataFrame:
    """Per-user count of bad events in tumbling windows; append mode emits a
    window once the watermark passes its end, rows later than that are dropped."""
    e = event_time(df, ts).withWatermark(ts, delay)
    return e.groupBy(F.window(ts, window).alias("w"), "user_id").agg(
        F.count_if(F.col("event_type") == bad).alias("manner_score"), F.count(F.lit(1)).alias("n_events")
    ).select(
        F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "user_id",
        "manner_score",
        "n_events",
    )


def manner_score_batch(df: DataFrame, ts: str = "ts", window: str = "1 hour", bad: str = "error") -> DataFrame:
    """T3 batch twin on the same table (checked against SQL)."""
    return df.groupBy(F.window(ts, window).alias("w"), "user_id").agg(
        F.count_if(F.col("event_type") == bad).alias("manner_score"), F.count(F.lit(1)).alias("n_events")
    ).select(
        F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "user_id",
        "manner_score",
        "n_events",
    )


def run_available_now(stream: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Drain everything available into a Parquet sink under the checkpoint dir
    and return the sink as a batch DataFrame (exactly-once file sink)."""
    spark = stream.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}-{uuid.uuid4().hex}"
    q = (
        stream.writeStream.format("parquet")
        .option("path", base + "/out")
        .option("checkpointLocation", base + "/chk")
        .outputMode(output_mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(base + "/out")
