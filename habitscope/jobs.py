"""The four jobs from the command line, for ``spark-submit``:

    spark-submit habitscope/jobs.py clean   --input raw.csv  --output users
    spark-submit habitscope/jobs.py report  --input users    --output reports [--name loyalty_segments]
    spark-submit habitscope/jobs.py cluster --input users    --output clusters
    spark-submit habitscope/jobs.py regress --input users    --output board

``--output`` is a folder; jobs with several results write one table for each into it.
What is printed is a preview and says so. Memory, cores and shuffle width come from
``spark-submit``; set ``spark.checkpoint.dir`` to a folder all executors share. Scratch
tables are removed when a job ends.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from habitscope.operators import cluster, explain, explore
from habitscope.plans import clustering, regression, reports
from habitscope.plans import fixed_values as V
from habitscope.plans import users as plan
from habitscope.sources import scratch, tables
from habitscope.sources.session import suit_wide_tables


def load(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """CSV is read as text: every job casts what it uses, so no inference pass."""
    return tables.read_csv_text(spark, path) if fmt == "csv" else tables.read_parquet(spark, path)


PREVIEW_ROWS = 60


def preview(df: DataFrame, name: str) -> None:
    """Print the first rows, and how many more there are."""
    print(name)
    df.show(PREVIEW_ROWS, truncate=False)
    more = df.count() - PREVIEW_ROWS
    if more > 0:
        print(f"({more} more rows in the output)")


def keep(df: DataFrame, output: str, name: str) -> DataFrame:
    """Write one result of a job whole, and return it as written."""
    tables.write_parquet(df, f"{output}/{name}")
    return tables.read_parquet(df.sparkSession, f"{output}/{name}")


def preferred(texts: list[str]) -> list:
    """``column:type`` marks: of a user's complete records the greatest wins."""
    return [F.col(c).try_cast(t) for c, _, t in (x.partition(":") for x in texts)]


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    counts = plan.run_cleaning(load(spark, args.input, args.format or "csv"), args.output,
                               args.output_format, preferred(args.prefer))
    for name, n in counts.items():
        print(f"{name}: {n:,}")
    if args.output_format == "parquet":
        preview(plan.users_by_gender(tables.read_parquet(spark, args.output)), "users_by_gender")


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    users = load(spark, args.input, args.format or "parquet")
    if args.format == "csv":
        users = plan.typed(users)
    tables.register_view(users, "users_clean")
    for name in args.name or reports.ALL_REPORTS:
        preview(keep(reports.ALL_REPORTS[name](users), args.output, name), name)


def cluster_users(spark: SparkSession, args: argparse.Namespace) -> None:
    features = clustering.prepared(load(spark, args.input, args.format or "parquet"))
    preview(keep(cluster.elbow(features, V.CLUSTER_FEATURES, [V.KEY]), args.output, "elbow").orderBy("k"), "elbow")
    model = clustering.fit(features, k=args.clusters)
    written = keep(clustering.clustered(features, model), args.output, "users")
    preview(keep(cluster.cluster_sizes(written), args.output, "sizes").orderBy("Cluster"), "sizes")
    preview(keep(clustering.radar_profile(written), args.output, "profile").orderBy("Cluster"), "profile")
    keep(cluster.project_2d(written, V.CLUSTER_FEATURES, [V.KEY, "Cluster"]), args.output, "projection")


def regress(spark: SparkSession, args: argparse.Namespace) -> None:
    users = load(spark, args.input, args.format or "parquet")
    inputs = scratch.settled(regression.numeric_inputs(users), "exploration")
    keep(explore.histogram(inputs, V.REGRESSION_LABEL, args.bin_width), args.output, "histogram")
    keep(explore.correlations(inputs, regression.NUMBERS), args.output, "correlations")
    v = regression.vectors(users)
    models = regression.fit_models(v, args.trees, args.rounds)
    preview(keep(regression.bake_off(v, models), args.output, "leaderboard").orderBy("place"), "leaderboard")
    explained, names = models[regression.EXPLAINED], v.names()
    keep(explain.tree_importances(v.train, explained, names), args.output, "importances")
    keep(explain.permutation_importance(v.test, explained, names, "label", [V.KEY]),
         args.output, "permutation_importances")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="habitscope")
    jobs = parser.add_subparsers(required=True)
    for name, job in (("clean", clean), ("report", report), ("cluster", cluster_users),
                      ("regress", regress)):
        sub = jobs.add_parser(name)
        sub.set_defaults(job=job)
        sub.add_argument("--input", required=True)
        sub.add_argument("--format", choices=["csv", "parquet"])
        sub.add_argument("--output", required=True)
        if name == "report":
            sub.add_argument("--name", nargs="*", choices=list(reports.ALL_REPORTS))
        if name == "clean":
            sub.add_argument("--output-format", choices=["csv", "parquet"], default="parquet")
            sub.add_argument("--prefer", nargs="*", default=[], metavar="COLUMN:TYPE")
        if name == "cluster":
            sub.add_argument("--clusters", type=int, default=V.CLUSTERS)
        if name == "regress":
            sub.add_argument("--trees", type=int, default=100)
            sub.add_argument("--rounds", type=int, default=100)
            sub.add_argument("--bin-width", type=float, default=1.0)
    args = parser.parse_args(argv)
    spark = suit_wide_tables(SparkSession.builder.getOrCreate())
    with scratch.cleared(spark):
        args.job(spark, args)


if __name__ == "__main__":
    main()
