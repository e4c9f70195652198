"""Quality, profiling, drift, privacy, tiers, audit and lineage over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidelake import schema
from tidelake.functions.content import content_hash
from tidelake.operators import lifecycle, privacy, profiling, quality
from tidelake.plans.catalogue import query, table

PROPS = StructType([StructField("k", LongType())])


@query(
    """select event_type, coalesce(c_mktsegment, 'none') as segment, count(*) as n,
              cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total_k
       from events left join customer on c_custkey = user_id group by all"""
)
def telemetry_parse(spark, sf_dir):
    events = quality.parse_telemetry(table(spark, sf_dir, "events"), PROPS)
    dimension = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    known = quality.with_metadata(events, dimension, "user_id")
    return known.groupBy("event_type", F.coalesce("c_mktsegment", F.lit("none")).alias("segment")).agg(
        F.count("*").alias("n"), F.sum("k").alias("total_k")
    )


_MIXED = """case event_id % 10 when 0 then substr(props, 1, length(props) - 1) when 1 then '{}'
            when 2 then '{"k": "x"}' when 3 then null else props end"""


@query(
    f"""with e as (select event_id, {_MIXED} as p from events)
    select event_id, case when p is null then 'absent' when not json_valid(p) then 'unparsable'
        when json_extract(p, '$.k') is null then 'missing field'
        when json_type(p, '$.k') not in ('UBIGINT', 'BIGINT') then 'wrong type' else 'ok' end as status,
        coalesce(case when json_valid(p) then try_cast(json_extract_string(p, '$.k') as bigint) end, -1) as k
    from e"""
)
def schema_validate(spark, sf_dir):
    mixed = table(spark, sf_dir, "events").withColumn("props", F.expr(_MIXED))
    checked = quality.validate_rows(mixed, PROPS)
    return checked.select("event_id", "status", F.coalesce("parsed.k", F.lit(-1)).alias("k"))


@query(
    """select event_type, count(*) as n, count(region) as with_region, round(sum(value), 4) as total
       from (select event_type, cast(null as varchar) as region, cast(user_id as double) as value from events
             where event_id % 2 = 0
             union all select event_type, 'r' || (user_id % 5) as region, value from events
             where event_id % 2 = 1) group by all"""
)
def schema_evolution(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    old = events.filter("event_id % 2 = 0").select("event_type", F.col("user_id").cast("int").alias("value"))
    region = F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string")).alias("region")
    new = events.filter("event_id % 2 = 1").select("event_type", region, "value")
    return schema.evolve(old, new).groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count("region").alias("with_region"),
        F.round(F.sum("value"), 4).alias("total"),
    )


@query(
    """with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
               from events group by all)
    select event_id, event_type, value from events join q using (event_type)
    where value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)"""
)
def iqr_clean(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    kept = quality.clean_outliers(events, "value", ["event_type"])
    return kept.select("event_id", "event_type", "value")


@query(
    """select l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.05), 4) as p05,
              round(quantile_cont(l_extendedprice, 0.5), 4) as p50,
              round(quantile_cont(l_extendedprice, 0.999), 4) as p999
       from lineitem group by all"""
)
def price_quantiles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    found = quality.quantiles(
        lines, "l_extendedprice", ["l_returnflag", "l_linestatus"], {"p05": 0.05, "p50": 0.5, "p999": 0.999}
    )
    return found.select(
        "l_returnflag", "l_linestatus", *[F.round(c, 4).alias(c) for c in ("p05", "p50", "p999")]
    )


@query(
    """select * from lineitem
       where cast('0x' || substr(md5(l_orderkey || '-' || l_linenumber), 1, 12) as bigint) < 0.01 * 281474976710656"""
)
def sample_1pct(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return profiling.sample_by_hash(lines, key, 0.01)


@query(
    """select share, count(*) as n, sum(l_orderkey) as keys from lineitem, (select unnest([0, 1e-6, 0.5, 1.0]::double[]) as share)
       where cast('0x' || substr(md5(l_orderkey || '-' || l_linenumber), 1, 12) as bigint) < share * 281474976710656 group by share
       union all select 0.0, 0, 0"""
)
def sample_shares(spark, sf_dir):
    """None, a few, half and all of the rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    counted = [
        profiling.sample_by_hash(lines, key, share).agg(
            F.lit(share).alias("share"), F.count("*").alias("n"), F.coalesce(F.sum("l_orderkey"), F.lit(0)).alias("keys")
        ).filter("n > 0 or share = 0")
        for share in (0.0, 1e-6, 0.5, 1.0)
    ]
    return reduce(DataFrame.union, counted)


_NUMBERS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]
_WORDS = ["l_returnflag", "l_linestatus"]


def _profile_sql(name: str, number: bool) -> str:
    def of(text):
        return f"cast({text} as double)" if number else "cast(null as double)"

    return f"""select '{name}' as "column", count(*) as n, count(*) - count({name}) as nulls,
        count(distinct {name}) as "distinct", {of(f'min({name})')} as "min", {of(f'max({name})')} as "max",
        round({of(f'avg({name})')}, 4) as mean, round({of(f'stddev_pop({name})' if number else 'null')}, 4) as std
        from lineitem"""


@query(
    " union all ".join(
        [_profile_sql(c, True) for c in _NUMBERS]
        + [_profile_sql(c, False).replace("avg(l_returnflag)", "null").replace("avg(l_linestatus)", "null") for c in _WORDS]
    )
)
def profile(spark, sf_dir):
    found = profiling.profile(table(spark, sf_dir, "lineitem"), [*_NUMBERS, *_WORDS])
    return found.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query(
    """with b as (select min(value) as lo, max(value) as hi from events)
    select cast(least(19, floor((value - lo) / ((hi - lo) / 20))) as integer) as bin, count(*) as n,
           round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 20), 6) as low,
           round(any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / 20), 6) as high
    from events, b group by bin"""
)
def histogram(spark, sf_dir):
    found = profiling.histogram(table(spark, sf_dir, "events"), "value", 20)
    return found.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


def _january_halves(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "value")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    return events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle)


_DRIFT = """
    with b as (select min(value) as lo, max(value) as hi from events where ts < timestamp '2024-01-16'),
    c as (select cast(greatest(0, least(9, floor((value - lo) / ((hi - lo) / 10)))) as integer) as bin,
                 count(*) filter (where ts < timestamp '2024-01-16') as n_ref,
                 count(*) filter (where ts >= timestamp '2024-01-16') as n_cur
          from events, b group by 1),
    s as (select *, n_ref / sum(n_ref) over () as p_ref, n_cur / sum(n_cur) over () as p_cur from c),
    d as (select *, (greatest(p_cur, 1e-6) - greatest(p_ref, 1e-6))
                    * ln(greatest(p_cur, 1e-6) / greatest(p_ref, 1e-6)) as psi,
                 abs(sum(p_cur) over w - sum(p_ref) over w) as gap
          from s window w as (order by bin rows unbounded preceding))
"""


@query(_DRIFT + "select bin, n_ref, n_cur, round(psi, 6) as psi from d")
def drift_psi(spark, sf_dir):
    first, second = _january_halves(spark, sf_dir)
    bins = profiling.drift_bins(first, second, "value", 10)
    return bins.select("bin", "n_ref", "n_cur", F.round("psi", 6).alias("psi"))


@query(
    _DRIFT + """, v as (select value, count(*) filter (where ts < timestamp '2024-01-16') as a,
                        count(*) filter (where ts >= timestamp '2024-01-16') as b from events group by value),
    k as (select abs(sum(a) over w / sum(a) over () - sum(b) over w / sum(b) over ()) as gap
          from v window w as (order by value rows unbounded preceding))
    select round((select sum(psi) from d), 6) as psi, round(max(gap), 6) as ks from k"""
)
def drift_ks(spark, sf_dir):
    first, second = _january_halves(spark, sf_dir)
    found = profiling.drift(first, second, "value", 10)
    return found.select(F.round("psi", 6).alias("psi"), F.round("ks", 6).alias("ks"))


def _order_metrics(spark, sf_dir):
    return quality.dq_metrics(
        table(spark, sf_dir, "orders"),
        complete=["o_custkey", "o_orderdate"],
        unique=["o_orderkey", "o_custkey"],
        valid={
            "o_totalprice": F.col("o_totalprice") > 50000,
            "o_orderstatus": F.col("o_orderstatus").isin("O", "F"),
        },
        fresh="o_orderdate",
        as_of=F.lit("2003-01-01").cast("date"),
    )


_DQ = """
    m as (
    select 'completeness' as metric, 'o_custkey' as item, count(o_custkey) / count(*) as value from orders
    union all select 'completeness', 'o_orderdate', count(o_orderdate) / count(*) from orders
    union all select 'uniqueness', 'o_orderkey', count(distinct o_orderkey) / count(o_orderkey) from orders
    union all select 'uniqueness', 'o_custkey', count(distinct o_custkey) / count(o_custkey) from orders
    union all select 'validity', 'o_totalprice', count(*) filter (where o_totalprice > 50000) / count(*) from orders
    union all select 'validity', 'o_orderstatus',
        count(*) filter (where o_orderstatus in ('O', 'F')) / count(*) from orders
    union all select 'freshness', 'o_orderdate',
        date_diff('day', max(o_orderdate)::date, date '2003-01-01')::double from orders)
"""


@query(f"with {_DQ} select metric, item, round(value, 6) as value from m")
def dq_metrics(spark, sf_dir):
    return _order_metrics(spark, sf_dir).withColumn("value", F.round("value", 6))


@query(
    f"""with {_DQ} select metric, item, round(value, 6) as value, 0 as rule, 'critical' as severity
        from m where metric = 'uniqueness' and value < 1
        union all select metric, item, round(value, 6), 1, 'warning' from m where metric = 'validity' and value < 0.99
        union all select metric, item, round(value, 6), 2, 'critical' from m where metric = 'validity' and value < 0.75
        union all select metric, item, round(value, 6), 3, 'warning' from m where metric = 'freshness' and value > 30"""
)
def alerts(spark, sf_dir):
    rules = [
        quality.Rule("uniqueness", lambda v: v < 1, "critical"),
        quality.Rule("validity", lambda v: v < 0.99, "warning"),
        quality.Rule("validity", lambda v: v < 0.75, "critical"),
        quality.Rule("freshness", lambda v: v > 30, "warning"),
    ]
    return quality.alerts(_order_metrics(spark, sf_dir), rules).withColumn("value", F.round("value", 6))


_TIER = """case when age <= 7 then 'hot' when age <= 365 then 'cold' when age <= 3650 then 'archive'
           else 'expired' end"""


@query(
    f"""with a as (select max(o_orderdate)::date as d from orders),
        o as (select o_orderkey, date_diff('day', o_orderdate::date, d) as age from orders, a)
    select o_orderkey, {_TIER} as tier from o"""
)
def tiering(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    as_of = orders.agg(F.max("o_orderdate")).scalar()
    return lifecycle.tier_rows(orders, "o_orderdate", as_of).select("o_orderkey", "tier")


@query(
    f"""with a as (select max(o_orderdate)::date as d from orders),
        o as (select {_TIER.replace('age', "date_diff('day', o_orderdate::date, d)")} as from_tier,
                     {_TIER.replace('age', "date_diff('day', o_orderdate::date, date '2008-01-01')")} as tier
              from orders, a)
    select from_tier, tier, case when from_tier = tier then 'keep' when tier = 'expired' then 'expire'
        else 'move' end as action, count(*) as rows from o group by all"""
)
def retention(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    previous = orders.agg(F.max("o_orderdate")).scalar()
    return lifecycle.retention_plan(orders, "o_orderdate", previous, F.lit("2008-01-01").cast("date"))


_KINDS = privacy.PATTERNS


@query(
    "select doc_id, "
    + ", ".join(f"cast(len(regexp_extract_all(text, '{p}')) as integer) as n_{k}" for k, p in _KINDS.items())
    + " from documents"
)
def pii_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return privacy.count_pii(docs, "text").drop("text")


def _mask_sql(column: str) -> str:
    for kind, pattern in _KINDS.items():
        column = f"regexp_replace({column}, '{pattern}', '[{kind.upper()}]', 'g')"
    return column


@query(
    f"""with d as (select doc_id, case when doc_id % 13 = 0 then '' else text end as text from documents)
        select doc_id, {_mask_sql('text')} as text from d where length(text) > 0"""
)
def edge_mask(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 13 != 0, F.col("text")).otherwise("").alias("text")
    )
    return privacy.edge_filter(docs, "text")


def _token_steps() -> str:
    """One step per kind, so that no expression repeats the earlier ones."""
    steps, before = [], "documents"
    for i, kind in enumerate(_KINDS):
        found = (
            f"list_sort(list_transform(list_distinct(regexp_extract_all(text, '{_KINDS[kind]}')),"
            " lambda m: struct_pack(n := -length(m), m := m)))"
        )
        swap = (
            f"list_reduce(list_transform({found}, lambda s: s.m), lambda acc, m: replace(acc, m,"
            f" '<{kind}:' || sha256('pepper' || m) || '>'), text)"
        )
        steps.append(f"s{i} as (select doc_id, {swap} as text from {before})")
        before = f"s{i}"
    return f"with {', '.join(steps)} select doc_id, text from {before}"


@query(_token_steps())
def anonymise(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return privacy.anonymise(docs, "text", "pepper")


@query("select o_custkey, sha256('salt' || o_custkey) as token, count(*) as n from orders group by all")
def pseudonyms(spark, sf_dir):
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return counted.withColumn("token", privacy.pseudonym(F.col("o_custkey"), "salt"))


@query(
    """select 'loader' as actor, 'documents' as job, source, count(*) as rows, timestamp '2024-02-01' as at
       from documents group by source
       union all select 'labeller', 'labels', 'all', count(*), timestamp '2024-02-01' from labels"""
)
def compliance_audit(spark, sf_dir):
    as_of = F.lit("2024-02-01").cast("timestamp_ntz")
    loads = privacy.audit(table(spark, sf_dir, "documents"), "documents", "loader", as_of, ["source"])
    labels = privacy.audit(table(spark, sf_dir, "labels"), "labels", "labeller", as_of)
    both = loads.unionByName(labels, allowMissingColumns=True)
    return both.withColumn("source", F.coalesce("source", F.lit("all")))


@query(
    """with recursive e as (
        select 'file:' || source as source, 'doc:' || doc_id as target from documents
        union select 'doc:' || doc_id, 'content:' || md5(text) from documents
        union select 'content:' || md5(text), 'label:' || doc_id from labels join documents using (doc_id)),
    up(node, depth) as (
        select 'label:' || doc_id, 0 from labels where toxic = 1
        union select e.source, depth + 1 from up join e on e.target = up.node where depth < 10)
    select node, cast(min(depth) as integer) as depth from up where depth > 0 group by node"""
)
def lineage_closure(spark, sf_dir):
    """Everything the toxic labels come from: contents, documents, files."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("file"), content_hash(F.col("text")).alias("h")
    )
    labels = table(spark, sf_dir, "labels")

    def node(kind, column):
        return F.concat(F.lit(kind + ":"), F.col(column).cast("string"))

    edges = (
        docs.select(node("file", "file").alias("source"), node("doc", "doc_id").alias("target"))
        .union(docs.select(node("doc", "doc_id"), node("content", "h")))
        .union(
            labels.join(docs, "doc_id").select(node("content", "h"), node("label", "doc_id"))
        )
    )
    start = labels.filter("toxic = 1").select(node("label", "doc_id").alias("node"))
    return lifecycle.lineage(edges, start)
