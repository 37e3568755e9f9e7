"""Time the headline queries and print one JSON line.

`BENCH_SF_DIR` is the directory of the tables, `BENCH_CPUS` the number of cores.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tidemark.catalog import ALL

HEADLINE = [
    "log_parse",
    "log_country_requests",
    "log_country_unique_hosts",
    "log_host_share",
    "log_heatmap",
    "log_country_report",
    "ratings_percent_rank",
    "ratings_temporal_split",
    "split_stratified",
    "kfold_assign",
    "setop_subtract",
    "cluster_semi_ratings",
    "liked_movies",
    "genre_top10",
    "eval_rmse",
    "eval_auc",
    "eval_f1_weighted",
    "feat_scale",
    "model_poisson_glm",
    "model_logreg_l1",
    "model_random_forest",
    "model_kmeans",
    "als_report_ratings",
    "cluster_genres_by_split",
    "claims_report_all_features",
    "classifier_report_particles",
]

#: Models that these queries fit, folds included.
FITS = {
    "als_report_ratings": 6,
    "cluster_genres_by_split": 3,
    "claims_report_all_features": 48,
    "classifier_report_particles": 21,
}


def session(cpus: int) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def seconds(spark: SparkSession, name: str, directory: str) -> float:
    start = time.perf_counter()
    ALL[name].run(spark, directory).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8)))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{directory}/orders.parquet").count()
    timed = {name: seconds(spark, name, directory) for name in HEADLINE}
    per_fit = {name: round(timed[name] / fits, 3) for name, fits in FITS.items()}
    scale = Path(directory).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "seconds_per_fit": per_fit,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
