"""Features, scores, labels, review, evaluation and business metrics over the given tables.

The two models are nearest-centroid classifiers, one built on the even and one on the odd vectors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidelake.operators import business, evaluation, features, images, labelling, profiling, quality, review
from tidelake.operators.profiling import cohort
from tidelake.plans.catalogue import query, table
from tidelake.plans.pixel_queries import GREY, grey8
from tidelake.streaming import windows


@query(
    """with f as (select event_type, cast(ts as date) as day, count(*) as rows,
        sum(cast('0x' || substr(h, 1, 16) as ubigint)::hugeint) as s0, sum(cast('0x' || substr(h, 17, 16) as ubigint)::hugeint) as s1,
        sum(cast('0x' || substr(h, 33, 16) as ubigint)::hugeint) as s2, sum(cast('0x' || substr(h, 49, 16) as ubigint)::hugeint) as s3
        from (select *, sha256(length(cast(event_id as varchar)) || ':' || event_id || length(cast(user_id as varchar)) || ':' || user_id
                               || length(event_type) || ':' || event_type) as h from events) group by event_type, day),
    v as (select event_type, day, rows, sha256(rows || '|' || s0 || '|' || s1 || '|' || s2 || '|' || s3) as version from f)
    select event_type, cast(max(day) as varchar) as day, arg_max(rows, day) as rows, arg_max(version, day) as version
    from v group by event_type"""
)
def feature_registry(spark, sf_dir):
    """Latest version of each feature table; a new version per day."""
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    versions = features.feature_version(events, ["event_id", "user_id", "event_type"], ["event_type", "day"])
    newest = features.latest(versions, ["event_type"], ["day"])
    return newest.withColumn("day", F.col("day").cast("string"))


@query(
    """select user_id, event_id, ts, event_type, value from events
       qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""
)
def inference_view(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return features.latest(events, ["user_id"], ["ts", "event_id"])


@query(
    """with l as (select user_id, event_id, ts, value from events where event_type = 'purchase'),
            f as (select user_id, event_id, ts, value from events where event_type = 'view')
    select l.user_id, l.event_id, l.ts, l.value, coalesce(f.event_id, -1) as f_event_id,
           coalesce(f.ts, l.ts) as f_ts, coalesce(f.value, -1) as f_value
    from l asof left join f on l.user_id = f.user_id and l.ts >= f.ts"""
)
def training_view_asof(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value", "event_type")
    purchases = events.filter("event_type = 'purchase'").drop("event_type")
    views = events.filter("event_type = 'view'").drop("event_type")
    view = features.as_of_join(purchases, views, "user_id", "ts", "event_id", "event_id")
    return view.withColumns(
        {
            "f_event_id": F.coalesce("f_event_id", F.lit(-1)),
            "f_ts": F.coalesce("f_ts", "ts"),
            "f_value": F.coalesce("f_value", F.lit(-1.0)),
        }
    )


def _vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def _scored(spark, sf_dir, rest: int) -> DataFrame:
    """Scores of all vectors under the model built on the vectors with ``vec_id % 2 = rest``."""
    vectors = _vectors(spark, sf_dir).select("vec_id", "label", "embedding")
    classes = labelling.centroids(vectors.filter(F.col("vec_id") % 2 == rest), "embedding", "label")
    return labelling.class_scores(vectors, "embedding", classes, "label").drop("embedding")


_MODEL = """
    lv as (select vec_id, label, i, cast(embedding[i] as double) as v from embeddings, range(1, 65) t(i)),
    ce as (select vec_id % 2 as half, label as k, i, avg(v) as m from lv group by all),
    di as (select half, vec_id, label, k, sqrt(sum((v - m) * (v - m))) as d
           from lv join ce using (i) group by all),
    so as (select half, vec_id, label, k, exp(-d) / sum(exp(-d)) over (partition by half, vec_id) as p from di),
    en as (select vec_id, label, k, avg(p) as p, (max(p) - min(p)) * (max(p) - min(p)) / 4 as var
           from so group by all)
"""


@query(
    """with lv as (select vec_id, label, i, cast(embedding[i] as double) as v from embeddings, range(1, 65) t(i)),
    ce as (select label, i, avg(v) as m from lv group by all),
    di as (select vec_id, label, sqrt(sum((v - m) * (v - m))) as d from lv join ce using (label, i) group by all),
    st as (select label, avg(d) + 2 * stddev_pop(d) as lim from di group by label)
    select vec_id, label, round(d, 6) as distance, d > lim as is_ood from di join st using (label)"""
)
def ood_centroid(spark, sf_dir):
    found = labelling.ood_scores(_vectors(spark, sf_dir), "embedding", "label", 2.0)
    return found.select("vec_id", "label", F.round("distance", 6).alias("distance"), "is_ood")


@query(
    f"""with {GREY}, r as (select image_id, y, avg(v) as m from px group by all),
    s as (select image_id, y, abs(m - lag(m) over (partition by image_id order by y)) as change from r)
    select image_id, cast(y as integer) as row, round(change, 6) as change from s
    qualify row_number() over (partition by image_id order by change desc nulls last, y) = 1"""
)
def horizon_row(spark, sf_dir):
    found = labelling.horizon_row(images.row_profile(grey8(spark, sf_dir)))
    return found.select("image_id", "row", F.round("change", 6).alias("change"))


@query(
    f"""with {_MODEL}
    select vec_id, arg_max(k, p) as label, round(max(p), 6) as confidence,
           round(avg(var), 8) as variance from en group by vec_id"""
)
def ensemble(spark, sf_dir):
    models = [_scored(spark, sf_dir, rest) for rest in (0, 1)]
    return labelling.ensemble(models, "vec_id").select(
        "vec_id",
        labelling.predicted(F.col("scores"), F.col("classes")).alias("label"),
        F.round(F.array_max("scores"), 6).alias("confidence"),
        F.round("variance", 8).alias("variance"),
    )


_CONFIDENCE = f"""{_MODEL},
    r as (select *, row_number() over (partition by vec_id order by p desc, k) as rn from so where half = 0),
    co as (select vec_id, any_value(label) as label, max(k) filter (where rn = 1) as predicted,
                  max(p) as confidence,
                  max(p) filter (where rn = 1) - max(p) filter (where rn = 2) as margin,
                  -sum(p * ln(p)) as entropy from r group by vec_id)
"""


def _confident(spark, sf_dir) -> DataFrame:
    scored = labelling.confidence(_scored(spark, sf_dir, 0))
    return scored.withColumn("predicted", labelling.predicted(F.col("scores"), F.col("classes")))


@query(
    f"""with {_CONFIDENCE} select vec_id, predicted, round(confidence, 6) as confidence,
        round(margin, 6) as margin, round(entropy, 6) as entropy from co"""
)
def confidence(spark, sf_dir):
    return _confident(spark, sf_dir).select(
        "vec_id",
        "predicted",
        *[F.round(c, 6).alias(c) for c in ("confidence", "margin", "entropy")],
    )


@query(
    f"""with {_CONFIDENCE} select vec_id, predicted,
        cast(row_number() over (partition by predicted order by margin, vec_id) as integer) as rank from co
        qualify rank <= 5"""
)
def hard_examples(spark, sf_dir):
    rows = _confident(spark, sf_dir).select("vec_id", "predicted", "margin")
    return labelling.hard_examples(rows, "predicted", "margin", "vec_id", 5).drop("margin")


@query(f"with {_CONFIDENCE} select vec_id, round(confidence, 6) as confidence from co where confidence < 0.115")
def low_conf_queue(spark, sf_dir):
    rows = _confident(spark, sf_dir).select("vec_id", "confidence")
    return labelling.low_confidence(rows, 0.115).withColumn("confidence", F.round("confidence", 6))


@query(
    f"""with {_CONFIDENCE} select vec_id, predicted as label, round(confidence, 6) as confidence,
        'nearest-centroid' as model, 'even' as version from co"""
)
def labelled_set(spark, sf_dir):
    scored = _scored(spark, sf_dir, 0).drop("label")
    rows = labelling.labelled(scored, "nearest-centroid", "even")
    return rows.select(
        "vec_id", "label", F.round("confidence", 6).alias("confidence"), "provenance.model", "provenance.version"
    )


@query(
    """with e as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events),
    s as (select event_id, user_id, rn, round(avg(value) over (partition by user_id order by rn
                 rows between 2 preceding and 2 following), 6) as smooth_value from e),
    c as (select a.event_id, b.event_type, count(*) as n from e a join e b
          on a.user_id = b.user_id and b.rn between a.rn - 4 and a.rn group by all)
    select s.event_id, s.smooth_value, c.event_type as smooth_label
    from s join c using (event_id)
    qualify row_number() over (partition by s.event_id order by c.n desc, c.event_type) = 1"""
)
def smooth(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type")
    found = labelling.smooth(events, "user_id", ["ts", "event_id"], "value", "event_type", 2, 5)
    return found.select("event_id", F.round("smooth_value", 6).alias("smooth_value"), "smooth_label")


def _label_rules():
    return {"critical": F.col("toxic") == 1, "high": F.col("quality") == 0}


@query(
    """select doc_id, case when toxic = 1 then 'critical' when quality = 0 then 'high' else 'normal' end
       as urgency from labels"""
)
def urgency(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", review.urgency(_label_rules()).alias("urgency"))


@query(
    """with q as (select timestamp '2024-02-01' - to_hours(cast(doc_id % 240 as bigint)) as created,
        case when toxic = 1 then 'critical' when quality = 0 then 'high' else 'normal' end as urgency
        from labels join documents using (doc_id)),
    d as (select urgency, created + to_hours(case urgency when 'critical' then 1 when 'high' then 24
          else 168 end) as due from q)
    select urgency, count(*) as depth, count(*) filter (where due < timestamp '2024-02-01') as overdue,
           min(due) as first_due from d group by urgency"""
)
def sla_queue(spark, sf_dir):
    as_of = F.lit("2024-02-01").cast("timestamp_ntz")
    documents = table(spark, sf_dir, "documents").select("doc_id")
    rows = table(spark, sf_dir, "labels").join(documents, "doc_id")
    age = F.make_dt_interval(F.lit(0), (F.col("doc_id") % 240).cast("int"))
    queue = review.review_queue(rows.withColumn("created", as_of - age), _label_rules(), "created", as_of)
    return review.queue_depth(queue)


@query(
    """select doc_id, case when doc_id % 20 = 0 then quality when doc_id % 10 = 0 then 1 - quality
              else quality end as quality, doc_id % 10 = 0 as corrected from labels"""
)
def feedback_merge(spark, sf_dir):
    """Every tenth label is flipped; every twentieth is flipped back later."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    flipped = labels.filter("doc_id % 10 = 0").select(
        "doc_id", (1 - F.col("quality")).alias("quality"), F.lit(1).alias("at")
    )
    again = labels.filter("doc_id % 20 = 0").select("doc_id", "quality", F.lit(2).alias("at"))
    return review.merge_feedback(labels, flipped.union(again), "doc_id", "quality", ["at"])


@query(
    """with c as (select conv_id, turn, role, cast(length(text) > 500 as varchar) as long_text,
            lag(role) over w as old_role, lag(cast(length(text) > 500 as varchar)) over w as old_long,
            row_number() over w as rn
            from conversations window w as (partition by conv_id order by turn, md5(text)))
    select conv_id, turn, 'role' as "column", coalesce(old_role, '') as old, role as new from c
    where rn = 1 or old_role <> role
    union all select conv_id, turn, 'long_text', coalesce(old_long, ''), long_text from c
    where rn = 1 or old_long <> long_text"""
)
def audit_trail(spark, sf_dir):
    log = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.md5("text").alias("entry"), "role", (F.length("text") > 500).alias("long_text")
    )
    changes = review.audit_changes(log, "conv_id", ["turn", "entry"], ["role", "long_text"])
    return changes.drop("entry").withColumn("old", F.coalesce("old", F.lit("")))


_HELD = """select count(*) as n, true as accurate from embeddings
    where cast('0x' || substr(md5(vec_id || '|0|held out'), 1, 12) as bigint) < 0.2 * 281474976710656"""


def _sides(spark, sf_dir) -> DataFrame:
    """Vectors with a label that can be learnt from them: the signs of two components, a quarter by chance."""
    side = (F.get("embedding", F.lit(0)) > 0).cast("int") + 2 * (F.get("embedding", F.lit(1)) > 0).cast("int")
    return _vectors(spark, sf_dir).withColumn("label", side)


def _judged(predictions) -> DataFrame:
    right = F.avg((F.col("label") == F.col("prediction")).cast("int"))
    return predictions.agg(F.count("*").alias("n"), (right >= 0.5).alias("accurate"))


@query(_HELD)
def train_light(spark, sf_dir):
    """Accuracy on the rows that the model hasn't seen."""
    vectors, held = _sides(spark, sf_dir), evaluation.held_out(F.col("vec_id"))
    _, found = evaluation.train_light(vectors.filter(~held), "embedding", "label", judge=vectors.filter(held))
    return _judged(found)


@query(_HELD)
def tune(spark, sf_dir):
    """Accuracy of the best model of a penalty grid on the rows that the search hasn't seen."""
    vectors, held = _sides(spark, sf_dir), evaluation.held_out(F.col("vec_id"))
    search = evaluation.tune(vectors.filter(~held), "embedding", "label", [0.01, 0.1], folds=2, steps=5)
    return _judged(search.bestModel.transform(evaluation.with_features(vectors.filter(held), "embedding", "label")))


@query(
    """select 'completeness' as what, 0.0::double as value, count(*) as n from orders
       union all select 'uniqueness', -1, count(*) from orders
       union all select 'psi', -1, count(*) from events union all select 'ks', -1, count(*) from events
       union all select 'z', -1, count(*) from events
       union all select 'saving', -1, count(distinct event_type) from events
       union all select 'margin', count(*), count(*) from embeddings
       union all select 'far', count(*), count(*) from embeddings"""
)
def edge_inputs(spark, sf_dir):
    """Columns of nulls, an empty window, constant arms, a zero baseline, one class, far vectors."""
    orders, events, vectors = (table(spark, sf_dir, t) for t in ("orders", "events", "embeddings"))
    nothing = F.lit(None).cast("string")

    def row(df, what, value, column=None):
        cell = F.coalesce(F.max(value) if column is None else column, F.lit(-1.0)).cast("double")
        return df.agg(F.lit(what).alias("what"), cell.alias("value"), F.count("*").alias("n"))

    empty = orders.withColumn("empty", nothing)
    metrics = quality.dq_metrics(empty, ["empty"], ["empty"], {}, "o_orderdate", F.lit("2003-01-01").cast("date"))
    metrics = metrics.filter("item = 'empty'").select(
        F.col("metric").alias("what"), F.coalesce("value", F.lit(-1.0)).alias("value"), orders.agg(F.count("*")).scalar().alias("n")
    )
    drift = profiling.drift(events, events.filter("event_id < -1"), "value", 10)
    total = events.agg(F.count("*")).scalar().alias("n")
    drifts = [drift.select(F.lit(c).alias("what"), F.coalesce(c, F.lit(-1.0)).alias("value"), total) for c in ("psi", "ks")]
    arms = evaluation.ab_test(events.withColumn("one", F.lit(1.0)), F.col("user_id") % 2 == 0, "one")
    z = arms.select(F.lit("z").alias("what"), F.coalesce("z", F.lit(-1.0)).alias("value"), (F.col("n_a") + F.col("n_b")).alias("n"))
    saved = business.saving(events.withColumn("zero", F.lit(0.0)), "event_type", "zero", F.col("user_id") % 2 == 0)
    one = vectors.select("vec_id", F.lit(0).alias("label"), "embedding")
    lead = labelling.confidence(
        labelling.class_scores(one, "embedding", labelling.centroids(one, "embedding", "label"), "label")
    )
    away = vectors.withColumn("embedding", F.transform("embedding", lambda v: v.cast("double") * 1e6))
    far = labelling.class_scores(away, "embedding", labelling.centroids(vectors, "embedding", "label"), "label")
    total_score = F.aggregate("scores", F.lit(0.0), lambda s, p: s + p)
    parts = [
        metrics, *drifts, z, row(saved, "saving", "saving"),
        row(lead, "margin", None, F.sum("margin")),
        row(far, "far", None, F.sum(F.when(F.abs(total_score - 1) < 1e-9, 1.0).otherwise(0.0))),
    ]
    return reduce(DataFrame.union, parts)


@query(f"with {_CONFIDENCE} select label as truth, predicted, count(*) as n from co group by all")
def confusion(spark, sf_dir):
    return evaluation.confusion(_confident(spark, sf_dir), "label", "predicted")


@query(
    f"""with {_CONFIDENCE}, cl as (select distinct label as class from co union select distinct predicted from co),
    t as (select class, count(*) filter (where label = class and predicted = class) as tp,
                 count(*) filter (where label = class and predicted <> class) as fn,
                 count(*) filter (where label <> class and predicted = class) as fp from cl, co group by class)
    select class, tp, fn, fp, round(case when tp + fp > 0 then tp / (tp + fp) else 0 end, 6) as precision,
           round(case when tp + fn > 0 then tp / (tp + fn) else 0 end, 6) as recall,
           round(2 * tp / (2 * tp + fp + fn), 6) as f1, round(tp / (tp + fp + fn), 6) as iou from t"""
)
def class_metrics(spark, sf_dir):
    pairs = evaluation.confusion(_confident(spark, sf_dir), "label", "predicted")
    found = evaluation.class_metrics(pairs)
    return found.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1", "iou")})


def _predictions(spark, sf_dir, rest: int) -> DataFrame:
    scored = _scored(spark, sf_dir, rest)
    best = labelling.predicted(F.col("scores"), F.col("classes")).alias("predicted")
    return scored.select("vec_id", "label", best, F.array_max("scores").alias("confidence"))


_BEST = f"""{_MODEL},
    b as (select half, vec_id, any_value(label) as label, arg_max(k, p) as predicted, max(p) as confidence
          from so group by half, vec_id)
"""


@query(
    f"""with {_BEST} select a.predicted, count(*) as n,
        round(avg(cast(a.predicted = c.predicted as integer)), 6) as agreement
        from b a join b c on a.vec_id = c.vec_id and a.half = 0 and c.half = 1 group by a.predicted"""
)
def shadow(spark, sf_dir):
    current, candidate = _predictions(spark, sf_dir, 0), _predictions(spark, sf_dir, 1)
    found = evaluation.agreement(candidate, current, "vec_id", "predicted")
    return found.withColumn("agreement", F.round("agreement", 6))


@query(
    f"""with {_BEST}, m as (select half, avg(cast(label = predicted as integer)) as acc, avg(confidence) as conf
        from b group by half)
    select cast(2 as bigint) as metrics, cast(cast(c.acc - p.acc >= 0.0 as integer) + cast(c.conf - p.conf >= -0.05 as integer) as bigint)
               as passed, c.acc - p.acc >= 0.0 and c.conf - p.conf >= -0.05 as promote
    from m c join m p on c.half = 1 and p.half = 0"""
)
def promote(spark, sf_dir):
    """Accuracy must not fall; mean confidence may fall by 0.05."""

    def metrics(rest):
        found = _predictions(spark, sf_dir, rest).agg(
            F.avg((F.col("label") == F.col("predicted")).cast("int")).alias("accuracy"),
            F.avg("confidence").alias("confidence"),
        )
        return found.unpivot([], ["accuracy", "confidence"], "metric", "value")

    return evaluation.promote(metrics(1), metrics(0), {"accuracy": 0.0, "confidence": -0.05})


@query(
    """select user_id, cast('0x' || substr(md5(cast(user_id as varchar)), 1, 12) as bigint) < 0.1 * 281474976710656 as in_cohort, count(*) as n,
              round(avg(value), 6) as mean_value from events group by all"""
)
def canary(spark, sf_dir):
    marked = cohort(table(spark, sf_dir, "events"), "user_id", 0.1)
    return marked.groupBy("user_id", "in_cohort").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value")
    )


@query(
    """with d as (select event_id, user_id, value - lag(value) over w as d1,
                  value - 2 * lag(value) over w + lag(value, 2) over w as d2
                  from events window w as (partition by user_id order by ts, event_id))
    select event_id, user_id, round(d1, 6) as first_difference, round(d2, 6) as second_difference
    from d where abs(d2) > 200"""
)
def jerks(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    found = evaluation.jerks(events, "user_id", ["ts", "event_id"], "value", 200.0)
    return found.select(
        "event_id",
        "user_id",
        F.round("first_difference", 6).alias("first_difference"),
        F.round("second_difference", 6).alias("second_difference"),
    )


@query(
    """with a as (select count(*) filter (where user_id % 2 = 0) as n_a, count(*) filter (where user_id % 2 = 1) as n_b,
        avg(value) filter (where user_id % 2 = 0) as mean_a, avg(value) filter (where user_id % 2 = 1) as mean_b,
        var_samp(value) filter (where user_id % 2 = 0) as var_a,
        var_samp(value) filter (where user_id % 2 = 1) as var_b from events)
    select n_a, n_b, round(mean_a, 6) as mean_a, round(mean_b, 6) as mean_b, round(var_a, 4) as var_a,
           round(var_b, 4) as var_b, round((mean_b - mean_a) / sqrt(var_a / n_a + var_b / n_b), 6) as z from a"""
)
def ab_test(spark, sf_dir):
    found = evaluation.ab_test(table(spark, sf_dir, "events"), F.col("user_id") % 2 == 1, "value")
    return found.select(
        "n_a",
        "n_b",
        F.round("mean_a", 6).alias("mean_a"),
        F.round("mean_b", 6).alias("mean_b"),
        F.round("var_a", 4).alias("var_a"),
        F.round("var_b", 4).alias("var_b"),
        F.round("z", 6).alias("z"),
    )


@query(
    """with e as (select ts, value, event_type, unnest([0, 1]) as back from events),
    w as (select time_bucket(interval '12 hours', ts) - back * interval '12 hours' as window_start, count(*) as events,
                 count(*) filter (where event_type = 'error') / count(*) as error_rate from e group by 1),
    b as (select count(*) filter (where event_type = 'error') / count(*) as base from events)
    select window_start, window_start + interval '1 day' as window_end, events, round(error_rate, 6) as error_rate,
           round(error_rate - base, 6) as delta from w, b"""
)
def monitor(spark, sf_dir):
    """Error rate per day, sliding by half a day, against the overall rate."""
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    rate = F.count_if(F.col("event_type") == "error") / F.count("*")
    days = windows.monitor(
        events, "ts", "1 day", {"events": F.count("*"), "error_rate": rate}, slide="12 hours"
    )
    found = evaluation.baseline_delta(days, "error_rate", events.agg(rate).scalar())
    return found.select(
        "window_start",
        "window_end",
        "events",
        F.round("error_rate", 6).alias("error_rate"),
        F.round("delta", 6).alias("delta"),
    )


_SAFETY = """
    sa as (select source, count(*) as n, count(*) filter (where quality = 0 and toxic = 0) as false_alarms,
                  count(*) filter (where toxic = 1 and quality = 1) as misses
           from labels join documents using (doc_id) group by source)
"""


def _safety(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id"
    )
    return business.safety_index(rows, "source", F.col("toxic") == 1, F.col("quality") == 0)


@query(
    f"""with {_SAFETY} select source, n, false_alarms, misses,
        round(1 - (false_alarms + 5 * misses) / (5 * n), 6) as safety_index from sa"""
)
def safety_index(spark, sf_dir):
    return _safety(spark, sf_dir).withColumn("safety_index", F.round("safety_index", 6))


_SAVING = """
    sv as (select event_type, avg(value) filter (where ts < timestamp '2024-01-16') as baseline,
                  avg(value) filter (where ts >= timestamp '2024-01-16') as current from events group by all)
"""


def _saving(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "ts", "value")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return business.saving(events, "event_type", "value", early)


@query(
    f"""with {_SAVING} select event_type, round(baseline, 6) as baseline, round(current, 6) as current,
        round((baseline - current) / baseline, 6) as saving from sv"""
)
def fuel_saving(spark, sf_dir):
    found = _saving(spark, sf_dir)
    return found.withColumns({c: F.round(c, 6) for c in ("baseline", "current", "saving")})


_DOWN = """
    e as (select user_id, ts, event_id, ts - lag(ts) over (partition by user_id order by ts, event_id)
                 > interval '12 hours' as far from events where event_type = 'error'),
    s as (select *, sum(cast(coalesce(far, true) as integer))
                 over (partition by user_id order by ts, event_id rows unbounded preceding) as n from e),
    dn as (select user_id, min(ts) as session_start, max(ts) as last_event, count(*) as events,
                  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::double as seconds from s group by user_id, n)
"""


def _downtime(spark, sf_dir):
    errors = table(spark, sf_dir, "events").filter("event_type = 'error'").select("user_id", "ts")
    return business.downtime(errors, "user_id", "ts", 12 * 3600)


@query(f"with {_DOWN} select user_id, session_start, last_event, events, cast(round(seconds * 1e6::double) as bigint) as micros from dn")
def downtime_sessions(spark, sf_dir):
    found = _downtime(spark, sf_dir)
    return found.withColumns(
        {
            "session_start": F.col("session_start").cast("timestamp_ntz"),
            "last_event": F.col("last_event").cast("timestamp_ntz"),
            "micros": F.round(F.col("seconds") * 1e6).cast("long"),
        }
    ).drop("seconds")


@query(
    f"""with {_SAFETY}, {_SAVING}, {_DOWN},
    t as (select (select sum(greatest((baseline - current) / baseline, 0)) from sv) * 100000 as benefit,
                 (select sum(seconds) from dn) / 3600 * 10
                 + (select sum(false_alarms + 5 * misses) from sa) as cost)
    select round(benefit, 3) as benefit, round(cost, 3) as cost,
           round((benefit - cost) / cost, 6) as roi from t"""
)
def roi(spark, sf_dir):
    """Savings against downtime hours, false alarms and misses, each at a price."""
    saved = _saving(spark, sf_dir).agg(F.sum(F.greatest("saving", F.lit(0.0))))
    hours = _downtime(spark, sf_dir).agg(F.sum("seconds") / 3600)
    wrong = _safety(spark, sf_dir).agg(F.sum(F.col("false_alarms") + 5 * F.col("misses")))
    one = saved.select(
        (saved.scalar() * 100000).alias("benefit"), (hours.scalar() * 10 + wrong.scalar()).alias("cost")
    )
    return one.select(
        F.round("benefit", 3).alias("benefit"),
        F.round("cost", 3).alias("cost"),
        F.round(business.roi(F.col("benefit"), F.col("cost")), 6).alias("roi"),
    )
