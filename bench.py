"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

One warm-up and three timed runs per query into the ``noop`` sink; the median counts. The pixel job
also reports pictures per second on 256 x 256 x 3 pictures grown from the embeddings.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession, functions as F

from tidelake.plans import load
from tidelake.session import configure, ship_package

HEADLINE = [
    "content_dedup", "dedup_rows", "new_since_ledger", "run_report", "batch_counts", "export_names",
    "blake2b_dedup", "px_autocontrast", "px_median", "label_argmax", "overlay", "telemetry_parse",
    "schema_validate", "iqr_clean", "price_quantiles", "ood_centroid", "pii_counts", "anonymise",
    "tiering", "retention", "sample_1pct", "profile", "histogram", "drift_ks", "dq_metrics",
    "inference_view", "training_view_asof", "ensemble", "confidence", "hard_examples", "smooth",
    "audit_trail", "class_metrics", "jerks", "ab_test", "monitor", "downtime_sessions", "roi",
    "lineage_closure", "stream_raw_equals_batch", "stream_windows",
]


def timed(run, repeats: int = 3) -> float:
    run()
    seconds = []
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def write(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def pictures(spark, sf_dir: str, side: int = 256):
    """One colour picture per three vectors, enlarged to ``side`` by the pixel job itself."""
    from tidelake.operators import images
    from tidelake.plans.pixel_queries import rgb8

    tasks = 4 * spark.sparkContext.defaultParallelism
    grown = images.standardise_images(
        rgb8(spark, sf_dir).repartition(tasks, "image_id"), [images.resize(side, side, "bilinear")]
    )
    return grown.drop("error")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "5g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    queries = load().QUERIES
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    seconds = {name: timed(lambda n=name: write(queries[n](spark, sf_dir))) for name in names}

    from tidelake.operators import images
    from tidelake.session import scratch

    path = scratch(spark, "bench-pictures")
    pictures(spark, sf_dir).write.parquet(path)
    stored = spark.read.parquet(path)
    count = stored.count()
    tasks = 4 * spark.sparkContext.defaultParallelism
    standard = timed(
        lambda: write(images.standardise_images(stored.repartition(tasks, "image_id"), images.default_steps(256)))
    )
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "pictures_per_second": round(count / standard, 1),
            }
        )
    )


if __name__ == "__main__":
    main()
