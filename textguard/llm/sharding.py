"""Sharding: consistent-hash ring with virtual nodes and bounded loads (native).

Each shard owns ``replicas`` virtual nodes on a ring of 65,536 cells; a row's
home is the owner of the first virtual node at or after the cell of its key.
Shards have fixed capacities. A shard keeps its home rows up to its capacity;
the rest continue clockwise to the next virtual node whose shard has room. With
``slack`` 0 the capacities add up to the number of rows, so the counts of any
two shards differ by one at most; a larger slack moves fewer rows.

How it runs: rows are ranked inside small window groups (arc of the ring, sub),
whose number is bounded and whose sizes are even whatever the skew. All that is
sequential - walking the overflow round the ring - happens on counts per arc,
at most shards * replicas numbers, in one SQL fold. Its outcome is a bounded
table of rank intervals per group, which is broadcast to place the rows. Only
ids, sizes and checksums are shuffled, never texts.

Defined results: null text has 0 bytes and checksum 0; null keys hash like one
key; repeated rows are placed one by one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textguard.llm.common import GROUPS, crc_of, pin, rank_in, spread_groups

CELLS = 1 << 16
#: Bytes that a row costs besides its text.
ROW_BYTES = 16


def ring(spark, shards: int, replicas: int) -> DataFrame:
    """(cell, arc, home): the virtual node that each ring cell belongs to.

    ``arc`` is the cell of that virtual node. Two nodes in one cell: the lower
    shard has it. CELLS rows, whatever the data.
    """
    node = F.xxhash64(F.lit("virtual node"), F.floor(F.col("id") / replicas).cast("long"), F.col("id") % replicas)
    nodes = (
        spark.range(0, shards * replicas, 1, 1)
        .select(F.pmod(node, F.lit(CELLS)).alias("cell"), F.floor(F.col("id") / replicas).cast("int").alias("shard"))
        .groupBy("cell")
        .agg(F.min("shard").alias("shard"))
    )
    cells = spark.range(0, CELLS, 1, 1).withColumnRenamed("id", "cell").join(nodes, "cell", "left")
    hit = F.when(F.col("shard").isNotNull(), F.struct(F.col("cell").alias("arc"), F.col("shard").alias("home")))
    back = Window.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    owner = F.coalesce(F.last(hit, ignorenulls=True).over(back), F.last(hit, ignorenulls=True).over(whole))
    return cells.select("cell", owner.alias("o")).select("cell", "o.arc", "o.home")


def _walk(spilled: DataFrame, room: DataFrame) -> DataFrame:
    """Carry the overflow round the ring twice: (shard, taken, seq) in order.

    ``spilled``: (arc, home, over) per arc; ``room``: (shard, room) per shard.
    One row holds both as arrays, and a fold passes the arcs clockwise; what is
    carried at the end of the first round meets the early arcs in the second.
    """
    both = spilled.select(F.struct("arc", F.col("home").alias("shard"), "over").alias("a")).withColumn("r", F.lit(None).cast("struct<shard:int,room:bigint>")).unionByName(
        room.select(F.struct("shard", "room").alias("r")), allowMissingColumns=True
    )
    one = both.agg(F.sort_array(F.collect_list("a")).alias("arcs"), F.transform(F.sort_array(F.collect_list("r")), lambda x: x["room"]).alias("rooms"))
    fold = F.expr(
        """aggregate(
             concat(arcs, transform(arcs, a -> named_struct('arc', a.arc, 'shard', a.shard, 'over', 0L))),
             named_struct('carry', 0L, 'rooms', rooms, 'taken', cast(array() as array<struct<shard:int,n:bigint>>)),
             (s, a) -> transform(array(least(s.carry + a.over, s.rooms[a.shard])), n -> named_struct(
                 'carry', s.carry + a.over - n,
                 'rooms', if(n > 0, transform(s.rooms, (v, i) -> if(i = a.shard, v - n, v)), s.rooms),
                 'taken', if(n > 0, concat(s.taken, array(named_struct('shard', a.shard, 'n', n))), s.taken)))[0],
             s -> s.taken)"""
    )
    return one.select(F.posexplode(fold).alias("seq", "t")).select("seq", F.col("t.shard").alias("shard"), F.col("t.n").alias("taken"))


def _intervals(groups: DataFrame, nodes: DataFrame, n: int, shards: int, slack: float) -> DataFrame:
    """(arc, sub, r_from, r_to, shard, slot0): where each group's ranks go.
    ``nodes``: (arc, home) of all virtual nodes, also of those without rows."""
    exact = slack <= 0
    cap = F.lit(n // shards) + (F.col("shard") < n % shards).cast("long") if exact else F.lit(int(-(-n * (1 + slack) // shards)))
    spark = groups.sparkSession
    in_home = Window.partitionBy("home").orderBy("arc", "sub").rowsBetween(Window.unboundedPreceding, -1)
    on_ring = Window.orderBy("arc", "sub").rowsBetween(Window.unboundedPreceding, -1)
    g = (
        groups.withColumn("before", F.coalesce(F.sum("n").over(in_home), F.lit(0)))
        .withColumn("shard", F.col("home"))
        .withColumn("kept", F.greatest(F.lit(0), F.least(F.col("n"), cap - F.col("before"))))
        .withColumn("over", F.col("n") - F.col("kept"))
        .withColumn("q", F.coalesce(F.sum("over").over(on_ring), F.lit(0)))
    )
    g = pin(g.select("arc", "sub", "home", "n", "before", "kept", "over", "q"), "ring-groups")
    held = g.groupBy(F.col("home").alias("shard")).agg(F.sum("kept").alias("held"))
    room = (
        spark.range(0, shards, 1, 1).select(F.col("id").cast("int").alias("shard")).join(held, "shard", "left")
        .select("shard", F.coalesce("held", F.lit(0)).alias("held"), (cap - F.coalesce("held", F.lit(0))).alias("room"))
    )
    spilled = nodes.join(g.groupBy("arc").agg(F.sum("over").alias("over")), "arc", "left").select("arc", "home", F.coalesce("over", F.lit(0)).alias("over"))
    taken = _walk(spilled, room)
    by_seq = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    by_shard = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    events = (
        taken.withColumn("q", F.coalesce(F.sum("taken").over(by_seq), F.lit(0)))
        .withColumn("earlier", F.coalesce(F.sum("taken").over(by_shard), F.lit(0)))
        .join(room, "shard")
        .select("q", F.struct("shard", (F.col("held") + F.col("earlier")).alias("slot"), F.col("q").alias("at")).alias("e"))
    )
    sources = g.filter("over > 0").select("q", F.struct("arc", "sub", "kept", F.col("q").alias("at")).alias("s"))
    # Both sides cut the line of overflow ranks; a piece lies in one group and goes to one shard.
    points = (
        sources.select("q", "s", F.lit(None).cast(events.schema["e"].dataType).alias("e"))
        .unionByName(events.select("q", F.lit(None).cast(sources.schema["s"].dataType).alias("s"), "e"))
        .groupBy("q")
        .agg(F.max("s").alias("s"), F.max("e").alias("e"))
    )
    line = Window.orderBy("q")
    pieces = points.select(
        "q",
        F.last("s", ignorenulls=True).over(line).alias("s"),
        F.last("e", ignorenulls=True).over(line).alias("e"),
        F.lead("q").over(line).alias("q_next"),
    )
    r_from = F.col("s.kept") + F.col("q") - F.col("s.at")
    # The line ends where the last source ends: its ranks have no upper bound of their own.
    moved = pieces.select(
        F.col("s.arc").alias("arc"), F.col("s.sub").alias("sub"), r_from.alias("r_from"),
        (r_from + F.coalesce(F.col("q_next") - F.col("q"), F.lit(1 << 62))).alias("r_to"),
        F.col("e.shard").alias("shard"), (F.col("e.slot") + F.col("q") - F.col("e.at")).alias("slot0"),
    )
    stay = g.filter("kept > 0").select("arc", "sub", F.lit(0).cast("long").alias("r_from"), F.col("kept").alias("r_to"), F.col("home").alias("shard"), F.col("before").alias("slot0"))
    return stay.unionByName(moved)


def ring_shards(docs: DataFrame, shards: int = 40, replicas: int = 64, slack: float = 0.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Place every row of ``docs``: (key, size, text_crc32, home, shard, slot).

    ``home`` is the shard that plain consistent hashing gives; rows with
    shard = home did not move. ``slot`` counts from 0 in each shard, no gaps.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias(key),
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        crc_of(body).alias("text_crc32"),
        F.monotonically_increasing_id().alias("uid"),
        F.xxhash64(F.col(key)).alias("_h"),
    ).withColumn("cell", F.pmod(F.col("_h"), F.lit(CELLS)))
    cells = ring(spark, shards, replicas)
    rows = pin(narrow.join(F.broadcast(cells), "cell").drop("cell"), "ring-rows")
    n = rows.count()
    grouped = spread_groups(rows, "arc", "uid", n, GROUPS)
    counts = grouped.groupBy("arc", "home", "sub").agg(F.count(F.lit(1)).alias("n"))
    places = pin(_intervals(counts, cells.select("arc", "home").distinct(), n, shards, slack), "ring-places")
    ranked = grouped.withColumn("r", rank_in(["arc", "sub"], ["_h", key, "text_crc32", "uid"]))
    # At most 2 * (arcs + GROUPS) + 2 * arcs intervals: a bound that the data can't move.
    return (
        ranked.join(F.broadcast(places), ["arc", "sub"])
        .filter((F.col("r") >= F.col("r_from")) & (F.col("r") < F.col("r_to")))
        .select(key, "size", "text_crc32", "home", F.col("shard").cast("int").alias("shard"), (F.col("slot0") + F.col("r") - F.col("r_from")).alias("slot"))
    )
