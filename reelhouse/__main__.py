"""Command line of the jobs, for ``spark-submit`` or ``python -m reelhouse``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from reelhouse import fixed_values as fixed
from reelhouse.plans import insights
from reelhouse.plans.lakehouse import Lakehouse
from reelhouse.plans.replicas import ServingTables
from reelhouse.session import build_session, shuffle_partitions_for
from reelhouse.sources import csv_files, event_log, external
from reelhouse.streaming import jobs

STEPS = ("ingest", "refine", "recommend", "aggregate")


def batch(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raw, cleaned and aggregate layers; each step can be run on its own."""
    house = Lakehouse(spark, args.lake)
    for step in args.steps:
        if step == "ingest":
            input_rows = house.ingest(
                csv_files.read_ratings(spark, f"{args.input}/ratings.csv"),
                csv_files.read_movies(spark, f"{args.input}/movies.csv"),
                csv_files.read_tags(spark, f"{args.input}/tags.csv"),
                args.cutoff_year,
            )
            house.check_raw(input_rows)
        elif step == "refine":
            house.refine()
            house.check_cleaned()
        elif step == "recommend":
            house.recommend(args.sample_fraction, args.seed, args.als_blocks)
        else:
            house.aggregate()


def serve(spark: SparkSession, args: argparse.Namespace) -> None:
    """Reload the serving copies from the aggregate layer and window results."""
    house, serving = Lakehouse(spark, args.lake), ServingTables(spark, args.serving)
    recommendations = house.recommendations.read()
    serving.reload_recommendations(recommendations)
    serving.reload_movies(house.bronze_movies.read(), recommendations)
    if args.windows:
        activity = jobs.read_results(spark, args.windows, "genre_activity")
        serving.reload_activity(activity.drop("computed_at", "window_date"))
    if args.jdbc_url:
        properties = {"driver": args.jdbc_driver} if args.jdbc_driver else {}
        for table, rows in (
            ("gold.user_recommendations", serving.recommendations),
            ("gold.dim_movie", serving.movies),
        ):
            external.reload_jdbc(rows.read(), args.jdbc_url, table, properties)
    if args.documents_uri:
        external.reload_collection(
            serving.documents.read(),
            args.documents_uri,
            args.documents_database,
            "gold_user_recommendations",
        )


REPORTS = {
    "user-recommendations": lambda house, args: insights.user_recommendations(
        house.recommendations.read(), house.movies.read(), args.user_id, args.limit
    ),
    "most-recommended": lambda house, args: insights.most_recommended_movies(
        house.recommendations.read(), house.movies.read(), args.limit
    ),
    "top-genre-by-decade": lambda house, args: insights.top_genre_by_decade(
        house.genre_decade.read(), args.min_ratings
    ),
    "prediction-diversity": lambda house, args: insights.prediction_diversity(
        house.recommendations.read(), args.limit
    ),
    "rating-percentages": lambda house, args: insights.rating_percentages(
        house.distribution.read()
    ),
    "novelty-vs-classic": lambda house, args: insights.novelty_vs_classic(
        house.recommendations.read(), house.movies.read()
    ),
}


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Store the rows of one business report as Parquet."""
    if args.name == "user-recommendations" and args.user_id is None:
        raise SystemExit("user-recommendations needs --user-id")
    rows = REPORTS[args.name](Lakehouse(spark, args.lake), args)
    rows.write.mode("overwrite").parquet(args.out)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Window results of the event topic until one of the queries stops."""
    jobs.start_all(
        lambda: event_log.read_topic(
            spark,
            args.servers,
            args.topic,
            messages_per_trigger=args.messages_per_trigger,
        ),
        args.out,
        args.checkpoints,
        args.burst_window_seconds,
        args.burst_threshold,
    )
    spark.streams.awaitAnyTermination()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="reelhouse", description=__doc__)
    parser.add_argument("--master", help="left out under spark-submit")
    commands = parser.add_subparsers(dest="command", required=True)

    job = commands.add_parser("batch", help=batch.__doc__)
    job.add_argument("--input", help="folder of ratings.csv, movies.csv and tags.csv")
    job.add_argument("--input-gb", type=float, help="sizes the shuffles")
    job.add_argument("--lake", required=True)
    job.add_argument("--cutoff-year", type=int, default=fixed.BATCH_CUTOFF_YEAR)
    job.add_argument("--sample-fraction", type=float, default=fixed.SAMPLE_FRACTION)
    job.add_argument("--seed", type=int, default=fixed.SAMPLE_SEED)
    job.add_argument("--als-blocks", type=int, default=fixed.ALS_BLOCKS)
    job.add_argument("--steps", nargs="+", choices=STEPS, default=STEPS)
    job.set_defaults(run=batch)

    job = commands.add_parser("serve", help=serve.__doc__)
    job.add_argument("--lake", required=True)
    job.add_argument("--serving", required=True)
    job.add_argument("--windows", help="folder of the streams' results")
    job.add_argument("--jdbc-url", help="copy the flat tables to this database as well")
    job.add_argument("--jdbc-driver", help="class of the database's driver")
    job.add_argument("--documents-uri", help="copy the nested rows to this store as well")
    job.add_argument("--documents-database", default="reelhouse")
    job.set_defaults(run=serve)

    job = commands.add_parser("stream", help=stream.__doc__)
    job.add_argument("--servers", required=True)
    job.add_argument("--topic", required=True)
    job.add_argument("--messages-per-trigger", type=int)
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoints", required=True)
    job.add_argument("--burst-window-seconds", type=int, default=fixed.BURST_WINDOW_SECONDS)
    job.add_argument("--burst-threshold", type=int, default=fixed.BURST_THRESHOLD)
    job.add_argument(
        "--shuffle-partitions", type=int, help="kept by a checkpoint from its first start on"
    )
    job.set_defaults(run=stream)

    job = commands.add_parser("report", help=report.__doc__)
    job.add_argument("name", choices=sorted(REPORTS))
    job.add_argument("--lake", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--user-id", type=int)
    job.add_argument("--limit", type=int, default=10)
    job.add_argument("--min-ratings", type=int, default=fixed.TOP_GENRE_MIN_RATINGS)
    job.set_defaults(run=report)
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session(f"reelhouse-{args.command}", args.master)
    if getattr(args, "input_gb", None):
        cores = spark.sparkContext.defaultParallelism
        partitions = shuffle_partitions_for(int(args.input_gb * 2**30), cores)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    if getattr(args, "shuffle_partitions", None):
        spark.conf.set("spark.sql.shuffle.partitions", args.shuffle_partitions)
    args.run(spark, args)


if __name__ == "__main__":
    main()
