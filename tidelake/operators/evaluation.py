"""Training a light model, offline metrics, comparisons, behaviour checks and promotion."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.functions.content import draw
from tidelake.operators.skew import ROWS_PER_TASK, neighbours


def with_features(df: DataFrame, vector: str, label: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>"))).withColumn(
        "target", F.col(label).cast("double")
    )


def held_out(key: Column, share: float = 0.2) -> Column:
    """Whether a row is kept from training; the same rows in every run."""
    return F.coalesce(draw(key.cast("string"), 0, "held out") < F.lit(float(share)), F.lit(False))


def train_light(
    df: DataFrame, vector: str, label: str, steps: int = 20, penalty: float = 0.01, judge: DataFrame | None = None
):
    """Multinomial logistic regression; returns the model and its predictions for ``judge``.

    Judge a model on rows it hasn't seen; without ``judge`` the predictions are for its own rows.
    """
    rows = with_features(df, vector, label)
    learner = LogisticRegression(
        featuresCol="features", labelCol="target", family="multinomial", maxIter=steps, regParam=penalty
    )
    model = learner.fit(rows)
    judged = rows if judge is None else with_features(judge, vector, label)
    return model, model.transform(judged).drop("features", "target", "rawPrediction", "probability")


def tune(df: DataFrame, vector: str, label: str, penalties: list[float], folds: int = 3, steps: int = 10):
    """Grid over the penalty with folds; returns the fitted search."""
    learner = LogisticRegression(featuresCol="features", labelCol="target", maxIter=steps)
    grid = ParamGridBuilder().addGrid(learner.regParam, penalties).build()
    judge = MulticlassClassificationEvaluator(labelCol="target", metricName="accuracy")
    search = CrossValidator(
        estimator=learner,
        estimatorParamMaps=grid,
        evaluator=judge,
        numFolds=folds,
        seed=7,
        parallelism=len(penalties),
    )
    return search.fit(with_features(df, vector, label))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def class_metrics(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and intersection over union per class, from confusion counts."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("truth").alias("class"), hit.alias("tp"), (F.col("n") - hit).alias("fn"), F.lit(0).cast("long").alias("fp")
                ),
                F.struct(
                    F.col("predicted").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fn"), (F.col("n") - hit).alias("fp")
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "fn", "fp")])

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    tp, fn, fp = (F.col(c) for c in ("tp", "fn", "fp"))
    return sums.select(
        "class",
        "tp",
        "fn",
        "fp",
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        share(tp, tp + fp + fn).alias("iou"),
    )


def agreement(candidate: DataFrame, current: DataFrame, key: str, label: str) -> DataFrame:
    """Share of items on which two models agree, per class of the current one."""
    both = current.select(key, F.col(label).alias("_a")).join(
        candidate.select(key, F.col(label).alias("_b")), key
    )
    return both.groupBy(F.col("_a").alias(label)).agg(
        F.count("*").alias("n"), F.avg((F.col("_a") == F.col("_b")).cast("double")).alias("agreement")
    )


def jerks(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    limit: float,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """First and second differences per unit; rows whose second difference exceeds ``limit``."""
    columns = {
        "_one": lambda w: F.lag(value, 1).over(w),
        "_two": lambda w: F.lag(value, 2).over(w),
    }
    seen = neighbours(df, [key], order, 2, 0, columns, rows_per_task)
    first = F.col(value) - F.col("_one")
    second = first - (F.col("_one") - F.col("_two"))
    return (
        seen.withColumns({"first_difference": first, "second_difference": second})
        .filter(F.abs("second_difference") > limit)
        .drop("_one", "_two")
    )


def ab_test(df: DataFrame, treated: Column, value: str) -> DataFrame:
    """Size, mean and variance of both arms and the z score of their difference, in one pass.

    Without variance, or with an empty arm, there is no score: it is null.
    """

    def arm(chosen: Column, name: str) -> list[Column]:
        seen = F.when(chosen, F.col(value))
        return [
            F.count(seen).alias(f"n_{name}"),
            F.avg(seen).alias(f"mean_{name}"),
            F.var_samp(seen).alias(f"var_{name}"),
        ]

    sums = df.agg(*arm(~treated, "a"), *arm(treated, "b"))
    error = F.sqrt(F.try_divide("var_a", "n_a") + F.try_divide("var_b", "n_b"))
    return sums.withColumn("z", F.try_divide(F.col("mean_b") - F.col("mean_a"), error))


def baseline_delta(windows: DataFrame, metric: str, baseline: Column) -> DataFrame:
    """Difference of each window's metric from a baseline value."""
    return windows.withColumn("baseline", baseline).withColumn("delta", F.col(metric) - F.col("baseline"))


def promote(
    candidate: DataFrame, production: DataFrame, gains: dict[str, float]
) -> DataFrame:
    """Compare metric tables (metric, value): each named metric must gain at least its amount.

    A negative amount is a guardrail: the metric may fall by that much. One row: the decision.
    """
    need = None
    for name, amount in gains.items():
        need = (F if need is None else need).when(F.col("metric") == name, F.lit(float(amount)))
    both = candidate.join(production.withColumnRenamed("value", "was"), "metric").withColumn("need", need)
    judged = both.filter(F.col("need").isNotNull()).withColumn(
        "passed", F.col("value") - F.col("was") >= F.col("need")
    )
    return judged.agg(
        F.count("*").alias("metrics"),
        F.count_if("passed").alias("passed"),
        (F.count("*") == len(gains)).alias("complete"),
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("better"),
    ).select("metrics", "passed", (F.col("complete") & F.col("better")).alias("promote"))
