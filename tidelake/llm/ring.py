"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations.

Keys and virtual nodes lie on a ring of cells; a key's home is the next node clockwise. A shard takes
its own keys up to its bound, in ring order; the others continue clockwise, first come first placed, and
each node they pass takes what its shard still has room for. The walk needs only counts per cell: a
table whose size is that of the ring, never of the data. Rows then look up their cell's pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidelake.session import stored

#: Virtual nodes per shard, and cells of the ring; both bound all that is broadcast or in one task.
NODES = 64
CELLS = 1 << 16


def ring(spark: SparkSession, shards: int, nodes: int = NODES, cells: int = CELLS) -> DataFrame:
    """(cell, turn, arc, shard): the ring in clockwise order, beginning behind its last node.

    Where two nodes fall into one cell, the smaller shard has it.
    """
    points = (
        spark.range(shards * nodes)
        .select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("node"))
        .select("shard", F.pmod(F.xxhash64(F.lit("node"), "shard", "node"), F.lit(cells)).alias("cell"))
        .groupBy("cell")
        .agg(F.min("shard").alias("shard"))
    )
    last = points.agg(F.max("cell").alias("last"))
    turned = (
        spark.range(cells)
        .withColumnRenamed("id", "cell")
        .join(points, "cell", "left")
        .crossJoin(F.broadcast(last))  # one row
        .select("cell", F.pmod(F.col("cell") - F.col("last") - 1, F.lit(cells)).alias("turn"), "shard")
    )
    against = Window.orderBy(F.desc("turn")).rowsBetween(Window.unboundedPreceding, 0)
    return turned.select(
        "cell",
        "turn",
        F.count("shard").over(against).alias("arc"),
        F.last("shard", ignorenulls=True).over(against).alias("shard"),
    )


def _walk(arcs: Column, shards: int, room: Column) -> Column:
    """What each node takes of the keys that come by, in two turns round the ring: (shard, n)."""
    step = "struct<shard: int, n: bigint>"
    start = F.struct(
        F.lit(0).cast("long").alias("carry"), room.alias("room"), F.array().cast(f"array<{step}>").alias("taken")
    )

    def pass_node(state: Column, node: Column) -> Column:
        come = state["carry"] + node["over"]
        take = F.least(come, F.get(state["room"], node["shard"]))
        left = F.transform(state["room"], lambda v, i: F.when(i == node["shard"], v - take).otherwise(v))
        own = F.array(F.struct(node["shard"].alias("shard"), take.alias("n")))
        return F.struct(
            (come - take).alias("carry"),
            F.when(take > 0, left).otherwise(state["room"]).alias("room"),
            F.when(take > 0, F.concat(state["taken"], own)).otherwise(state["taken"]).alias("taken"),
        )

    again = F.transform(arcs, lambda a: F.struct(a["arc"].alias("arc"), a["shard"].alias("shard"), F.lit(0).cast("long").alias("over")))
    return F.aggregate(F.concat(arcs, again), start, pass_node)["taken"]


def pieces(counts: DataFrame, shards: int, slack: float = 0.0, nodes: int = NODES, cells: int = CELLS) -> DataFrame:
    """(cell, low, high, to, slot0): keys of rank ``low`` to ``high`` (not included) of a cell go ``to`` a shard.

    ``counts`` has the keys per cell. Without slack the bounds are the mean, rounded up for as many
    shards as it takes, so that counts are at most one apart; else a shard may have ``1 + slack`` means.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    if slack:
        bound = F.ceil(F.col("total") * (1 + slack) / shards)
    else:
        bound = F.floor(F.col("total") / shards) + F.when(F.col("shard") < F.col("total") % shards, 1).otherwise(0)
    in_shard = Window.partitionBy("shard").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    # as many rows as the ring has cells, read several times below
    plan = stored(
        ring(counts.sparkSession, shards, nodes, cells)
        .join(counts, "cell", "left")
        .crossJoin(F.broadcast(total))  # one row
        .select("cell", "turn", "arc", "shard", F.coalesce("n", F.lit(0)).alias("n"), bound.alias("bound"))
        .withColumn("slot0", F.coalesce(F.sum("n").over(in_shard), F.lit(0)))
        .withColumn("kept", F.greatest(F.lit(0), F.least("n", F.col("bound") - F.col("slot0"))))
        .withColumn("over", F.col("n") - F.col("kept"))
        .withColumn("over0", F.coalesce(F.sum("over").over(before), F.lit(0)))
    )
    at_home = plan.filter("kept > 0").select(
        "cell", F.lit(0).cast("long").alias("low"), F.col("kept").alias("high"), F.col("shard").alias("to"), "slot0"
    )
    homes = plan.groupBy("shard").agg(F.sum("kept").alias("kept"), F.max("bound").alias("bound"))
    bounds = counts.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(homes, "shard", "left")
    # a shard whose nodes all lost their cells to others has no keys of its own and no node to take some
    room = F.transform(
        F.array_sort(F.collect_list(F.struct("shard", F.coalesce(F.col("bound") - F.col("kept"), F.lit(0)).alias("room")))),
        lambda r: r["room"],
    )
    arcs = plan.groupBy("arc", "shard").agg(F.sum("over").alias("over"))
    # arcs are numbered against the clock
    clockwise = F.reverse(F.array_sort(F.collect_list(F.struct("arc", "shard", "over"))))
    walk = (
        arcs.agg(clockwise.alias("arcs"))
        .crossJoin(bounds.agg(room.alias("room")))  # one row each
        .select(F.posexplode(_walk(F.col("arcs"), shards, F.col("room"))).alias("pos", "taken"))
        .select("pos", "taken.shard", "taken.n")
    )
    sent = walk.join(homes.select("shard", "kept"), "shard").select(
        (F.sum("n").over(Window.orderBy("pos")) - F.col("n")).alias("start"),
        "shard",
        (F.col("kept") + F.sum("n").over(Window.partitionBy("shard").orderBy("pos")) - F.col("n")).alias("slot0"),
    )
    # lay the cells' overflow and what the nodes take side by side, both in the order of the queue
    events = (
        plan.filter("over > 0")
        .select(F.col("over0").alias("start"), F.struct("cell", "kept", "over0").alias("source"), F.lit(None).alias("sink"))
        .unionByName(
            sent.select("start", F.lit(None).alias("source"), F.struct("shard", "slot0", F.col("start").alias("start0")).alias("sink"))
        )
        .groupBy("start")
        .agg(F.max("source").alias("source"), F.max("sink").alias("sink"))
    )
    queue = Window.orderBy("start")
    placed = events.crossJoin(F.broadcast(plan.agg(F.sum("over").alias("end")))).select(
        "start",
        F.lead("start").over(queue).alias("next"),
        "end",
        F.last("source", ignorenulls=True).over(queue).alias("source"),
        F.last("sink", ignorenulls=True).over(queue).alias("sink"),
    )
    rank = F.col("source.kept") - F.col("source.over0")
    moved = placed.select(
        "source.cell",
        (rank + F.col("start")).alias("low"),
        (rank + F.coalesce("next", "end")).alias("high"),
        F.col("sink.shard").alias("to"),
        (F.col("sink.slot0") + F.col("start") - F.col("sink.start0")).alias("slot0"),
    )
    return at_home.unionByName(moved)


def shard(
    df: DataFrame, identity: list[str], shards: int, slack: float = 0.0, nodes: int = NODES, cells: int = CELLS
) -> DataFrame:
    """``df`` with ``shard int`` and ``slot long``, the place within the shard, from 0 without gaps.

    A row's place on the ring is a hash of its ``identity`` columns, which may be null. All rows are
    kept; rows that agree in identity get slots of their own. Columns that bear one of the new names
    are replaced; an empty table gives no rows. One shuffle of the rows, by cell.
    """
    rows = df.drop("shard", "slot").withColumn("_place", F.xxhash64(*identity))
    cell = F.pmod(F.col("_place"), F.lit(cells)).alias("cell")
    counts = rows.groupBy(cell).agg(F.count("*").alias("n"))
    found = pieces(counts, shards, slack, nodes, cells).select(
        F.col("cell").alias("_cell"), F.col("low").alias("_low"), F.col("high").alias("_high"), F.col("to").alias("_to"), F.col("slot0").alias("_slot0")
    )
    ranked = rows.withColumn("_own", cell).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_own").orderBy("_place", *identity)).cast("long") - 1
    )
    inside = (F.col("_own") == F.col("_cell")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    # at most one piece per cell and two for each node that takes keys
    return ranked.join(F.broadcast(found), inside).select(
        *[c for c in df.columns if c not in ("shard", "slot")],
        F.col("_to").alias("shard"),
        (F.col("_slot0") + F.col("_rank") - F.col("_low")).alias("slot"),
    )
