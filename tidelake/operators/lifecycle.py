"""Storage tiers by age, retention, and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidelake.operators.skew import SMALL_ROWS, sized
from tidelake.session import stored
from tidelake.sinks import folders
from tidelake.sinks.tables import replace_by_source
from tidelake.sources.files import file_inventory

#: Pointers of lineage are doubled as long as they are at most so many for each edge.
POINTERS_PER_EDGE = 4

#: Chains are shortened before that while there are more edges than this, and a round takes out at least one in so many.
SHORT_EDGES, LEAST_CUT = 500_000, 10

# fixed values: days in each tier
TIERS = {"hot": 7, "cold": 365, "archive": 3650}


def tier(ts: Column, as_of: Column, limits: dict[str, int] = TIERS) -> Column:
    age = F.date_diff(as_of.cast("date"), ts.cast("date"))
    chosen = None
    for name, days in limits.items():
        chosen = (F if chosen is None else chosen).when(age <= days, name)
    return chosen.otherwise("expired")


def tier_rows(df: DataFrame, ts: str, as_of: Column, limits: dict[str, int] = TIERS) -> DataFrame:
    """Add ``tier``; write with ``partitionBy("tier")`` so that each tier is a folder."""
    return df.withColumn("tier", tier(F.col(ts), as_of, limits))


def retention_plan(
    df: DataFrame, ts: str, previous: Column, as_of: Column, limits: dict[str, int] = TIERS
) -> DataFrame:
    """Rows that stay, move or expire between two runs, per pair of tiers."""
    moved = df.select(
        tier(F.col(ts), previous, limits).alias("from_tier"), tier(F.col(ts), as_of, limits).alias("tier")
    )
    action = (
        F.when(F.col("from_tier") == F.col("tier"), "keep")
        .when(F.col("tier") == "expired", "expire")
        .otherwise("move")
    )
    return moved.groupBy("from_tier", "tier", action.alias("action")).agg(F.count("*").alias("rows"))


def lineage(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Every ancestor of the artefacts in ``start`` with its smallest distance.

    ``edges`` has ``source`` and ``target``, ``start`` has ``node``; nulls and repeated edges don't
    matter, and cycles end. Pointers are doubled: after a round they span twice as many edges, and so
    does what is known, so a chain of depth d takes log2(d) rounds. Where pointers would outgrow the
    edges, as among many artefacts with many sources each, the rest goes edge by edge from the newest
    nodes. Every round is stored, so none repeats the work before it.

    Among many edges, artefacts that only one other was made from are first taken out, a part of them in
    each round, and their edges joined to one that counts for several; their distances follow from
    those that are left. So a long chain costs a few times its length, not its length in every round.
    """
    edges = stored(edges.select("source", "target").filter("source is not null and target is not null").distinct())
    size = edges.count()
    known = stored(start.select("node").filter("node is not null").distinct().withColumn("depth", F.lit(0)))
    if size > SHORT_EDGES:
        found = _along_chains(edges, size, known)
        if found is not None:
            return found
    pointers, span, count = edges, 1, known.count()
    while True:
        # pointers of this span lead from all that is nearer than it to all that is nearer than twice as far
        further = known.join(pointers, F.col("node") == F.col("target")).select(
            F.col("source").alias("node"), (F.col("depth") + span).alias("depth")
        )
        known = stored(known.unionByName(further).groupBy("node").agg(F.min("depth").alias("depth")))
        before, count, span = count, known.count(), 2 * span
        if count == before:
            return known.filter("depth > 0")
        into = pointers.groupBy(F.col("target").alias("node")).agg(F.count("*").alias("up"))
        out = pointers.groupBy(F.col("source").alias("node")).agg(F.count("*").alias("down"))
        grown = into.join(out, "node").agg(F.coalesce(F.sum(F.col("up").cast("decimal(38,0)") * F.col("down")), F.lit(0))).first()[0]
        if grown > POINTERS_PER_EDGE * size + SMALL_ROWS:
            return _by_level(edges, known, span)
        nearer = pointers.select(F.col("source").alias("middle"), "target")
        pointers = stored(pointers.withColumnRenamed("target", "middle").join(nearer, "middle").select("source", "target").distinct())


def _along_chains(edges: DataFrame, size: int, known: DataFrame) -> DataFrame | None:
    """Ancestors by edges of which most are parts of chains; None if they aren't."""
    left, taken = edges.withColumn("length", F.lit(1)), []
    while size > SHORT_EDGES:
        coin = F.lit(len(taken)).cast("long")

        def goes(node: str) -> Column:
            return F.xxhash64(F.col(node), coin) % 2 == 0

        # one target, and one that stays: then no two that go are neighbours
        single = left.groupBy("source").agg(F.min("target").alias("to"), F.max("target").alias("other"), F.min("length").alias("more"))
        out = single.filter((F.col("to") == F.col("other")) & goes("source") & ~goes("to")).select(F.col("source").alias("node"), "to", "more")
        out = stored(out.join(known.select("node"), "node", "left_anti"))
        # a node that goes is not looked for among the others
        stays = left.filter(~goes("source")).unionByName(
            left.filter(goes("source")).join(out.select(F.col("node").alias("source")), "source", "left_anti")
        )
        passed = stays.filter(goes("target")).join(out, F.col("target") == F.col("node"), "left").select(
            "source", F.coalesce("to", "target").alias("target"), (F.col("length") + F.coalesce("more", F.lit(0))).alias("length")
        )
        left = stored(passed.unionByName(stays.filter(~goes("target"))).filter("source <> target"))
        before, size = size, left.count()
        if before - size < before / LEAST_CUT:
            if not taken:
                return None
            taken.append(out)
            break
        taken.append(out)
    left = stored(left.groupBy("source", "target").agg(F.min("length").alias("length")))
    found = _doubled(left, left.count(), known)
    if found is None:
        return None
    for out in reversed(taken):
        nearer = found.select(F.col("node").alias("to"), "depth")
        found = stored(found.unionByName(out.join(nearer, "to").select("node", (F.col("depth") + F.col("more")).alias("depth"))))
    return found.filter("depth > 0")


def _doubled(edges: DataFrame, size: int, known: DataFrame) -> DataFrame | None:
    """Distances by edges of any ``length``, with doubled pointers; None where those would outgrow the edges."""
    pointers, at = edges, None
    while True:
        further = known.join(pointers, F.col("node") == F.col("target")).select(
            F.col("source").alias("node"), (F.col("depth") + F.col("length")).alias("depth")
        )
        known = stored(known.unionByName(further).groupBy("node").agg(F.min("depth").alias("depth")))
        # a path of more edges may be shorter, so distances must stand still, too
        before, at = at, tuple(known.agg(F.count("*"), F.sum(F.col("depth").cast("decimal(38,0)"))).first())
        if before == at:
            return known
        into = pointers.groupBy(F.col("target").alias("node")).agg(F.count("*").alias("up"))
        out = pointers.groupBy(F.col("source").alias("node")).agg(F.count("*").alias("down"))
        grown = into.join(out, "node").agg(F.coalesce(F.sum(F.col("up").cast("decimal(38,0)") * F.col("down")), F.lit(0))).first()[0]
        if grown > POINTERS_PER_EDGE * size + SMALL_ROWS:
            return None
        nearer = pointers.select(F.col("source").alias("middle"), "target", F.col("length").alias("rest"))
        joined = pointers.withColumnRenamed("target", "middle").join(nearer, "middle")
        pointers = stored(joined.groupBy("source", "target").agg(F.min(F.col("length") + F.col("rest")).alias("length")))


def _by_level(edges: DataFrame, known: DataFrame, span: int) -> DataFrame:
    """Goes on from all ancestors nearer than ``span``, one level at a time."""
    frontier = known.filter(F.col("depth") == span - 1)
    depth = span - 1
    while True:
        size = frontier.count()
        if size == 0:
            return known.filter("depth > 0")
        depth += 1
        targets = frontier.select(F.col("node").alias("target"))
        if size <= SMALL_ROWS:
            targets = sized(targets)
        parents = (
            edges.join(targets, "target", "left_semi").select(F.col("source").alias("node")).distinct()
        )
        frontier = stored(
            parents.join(known.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth))
        )
        known = known.unionByName(frontier)


PLACE = ["tier", "day", "origin"]


def write_tiers(
    df: DataFrame, path: str, ts: str, origin: str, as_of: Column, limits: dict[str, int] = TIERS, period: str = "day"
) -> None:
    """Write rows below a folder for each tier, day and ``origin``, the name of this write.

    With a longer ``period`` (``week``, ``month``) its first day stands for all of its rows. Rows that are expired already are written, too: the next move removes them and says so. The same
    origin written again replaces its rows.
    """
    placed = df.withColumns({"day": F.date_trunc(period, ts).cast("date"), "origin": F.lit(origin)})
    replace_by_source(tier_rows(placed, "day", as_of, limits), path, PLACE)


def move_tiers(
    spark: SparkSession, path: str, audit: str, run: str, as_of: Column, columns: StructType, limits: dict[str, int] = TIERS
) -> DataFrame:
    """Move what has come of age to the folder of its tier; returns the audit rows of this run.

    A day changes its tier as a whole, so only folders of such days are read and written. Each is
    written below its new tier before the old folder goes. A run that was interrupted leaves a folder
    in both, under the same day and origin: the next run writes it again and removes the old one. A run
    that finds nothing to do writes no audit row. Rows without a time stay where they are.
    """
    folders_now = _tier_folders(spark, path)
    due = stored(
        folders_now.withColumn("new", tier(F.col("day").cast("date"), as_of, limits)).filter("day is not null and new <> tier")
    )
    names = [tuple(r) for r in due.select(*PLACE, "new").collect()]  # folders, as the driver lists them anyway
    if not names:
        return _read_audit(spark, audit).filter(F.lit(False))
    old = [folders.partition(spark, path, tier=t, day=d, origin=o) for t, d, o, _ in names]
    rows = spark.read.schema(columns).option("basePath", path).parquet(*old).withColumn("tier", F.col("tier").cast("string"))
    key = [F.col("tier"), F.col("day").cast("string"), F.col("origin").cast("string")]
    rows = rows.withColumn("_new", tier(F.col("day").cast("date"), as_of, limits))
    action = F.when(F.col("_new") == "expired", "expire").otherwise("move").alias("action")
    counts = stored(rows.groupBy(F.col("tier").alias("from_tier"), F.col("_new").alias("tier"), action).agg(F.count("*").alias("rows")))
    moved = rows.filter("_new <> 'expired'").select(*[f.name for f in columns], F.col("_new").alias("tier"), *[k.alias(n) for k, n in zip(key[1:], PLACE[1:])])
    replace_by_source(moved, path, PLACE)
    replace_by_source(counts.withColumn("run", F.lit(run)), audit, "run")
    for folder in old:
        folders.remove(spark, folder)
    return _read_audit(spark, audit).filter(F.col("run") == run)


_AUDIT = "from_tier string, tier string, action string, rows long, run string"


def _read_audit(spark: SparkSession, audit: str) -> DataFrame:
    return spark.read.schema(_AUDIT).parquet(audit) if folders.exists(spark, audit) else spark.createDataFrame([], _AUDIT)


def _tier_folders(spark: SparkSession, path: str) -> DataFrame:
    """(tier, day, origin) of the folders that hold files; nothing is read but their names."""
    files = file_inventory(spark, path, recursive=True).filter("file_size > 0")

    def named(key: str) -> Column:
        value = F.url_decode(F.replace(F.regexp_extract("file_path", f"/{key}=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))
        return F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__")).alias(key)

    return files.select(*map(named, PLACE)).distinct()
