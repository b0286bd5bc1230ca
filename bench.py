"""Wall time of the headline work; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) holds the tables and ``BENCH_CPUS``
the local cores. The cleaning job writes the user table once; the reports and the
K-means job read it, as they would in production. Keys starting with ``full_`` are
registered queries run end to end from the raw records.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession, functions as F

from habitscope.operators import cluster, regress
from habitscope.plans import clustering, regression, reports
from habitscope.plans import fixed_values as V
from habitscope.plans import users as plan
from habitscope.registry import dataset, query_functions
from habitscope.sources import tables
from habitscope.sources.scratch import use_checkpoints
from habitscope.sources.session import suit_wide_tables

FULL = ["q4_loyalty", "q8_anomaly", "c1_one_row_per_key", "e3_frequency_index_keep",
        "w1_rank_whole_table", "e8_standardise_centred", "r13_metrics_by_model", "r1_least_squares"]


def drain(df) -> None:
    """Compute every row without bringing it to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="habitscope-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("habitscope-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    suit_wide_tables(spark)
    drain(tables.read_parquet(spark, f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count())

    times: dict[str, float] = {}

    def timed(key: str, work) -> None:
        start = time.perf_counter()
        work()
        times[key] = round(time.perf_counter() - start, 3)

    clean_path = f"{scratch}/users"
    timed("clean_job", lambda: plan.run_cleaning(
        dataset.raw_users(spark, sf_dir), clean_path, prefer=[F.col("record_id")]))
    users = tables.read_parquet(spark, clean_path)
    timed("report_preview", lambda: drain(plan.users_by_gender(users)))
    limits = {"ad_targeting": {"more_than": 20}, "exercise_and_usage": {"at_least": 20}}
    for name, report in reports.ALL_REPORTS.items():
        timed(f"report_{name}", lambda: drain(report(users, **limits.get(name, {}))))

    features = clustering.prepared(users)
    timed("elbow", lambda: drain(cluster.elbow(features, V.CLUSTER_FEATURES, [V.KEY])))
    timed("kmeans", lambda: drain(clustering.radar_profile(
        clustering.clustered(features, clustering.fit(features)))))
    v = regression.vectors(users)
    line_up = regress.seven_regressors(v.train, regression.FEATURES, "label", keys=[V.KEY])
    use_checkpoints(spark)
    models = {}
    for name, estimator in line_up.items():
        timed("fit_" + name.lower().replace(" ", "_"),
              lambda: models.update({name: estimator.fit(v.train)}))
    timed("leaderboard", lambda: drain(regression.bake_off(v, models)))
    for key in FULL:
        timed(f"full_{key}", lambda: drain(query_functions()[key](spark, sf_dir)))
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of the headline work", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
