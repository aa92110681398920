"""Time the pipeline's jobs, the reports on its tables, and the event windows.

Prints one JSON line. ``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the
number of cores. Every step is the median of three runs, which compute the whole
result and, for jobs, store it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import registry  # noqa: E402
from reelhouse.operators import event_windows  # noqa: E402
from reelhouse.plans import gold, insights, live, replicas  # noqa: E402
from reelhouse.plans.lakehouse import Lakehouse  # noqa: E402
from checks.work_folder import name_work_folder  # noqa: E402
from reelhouse.session import build_session, new_work_path  # noqa: E402
from reelhouse.sources import csv_files, event_log  # noqa: E402
from reelhouse.sources.sample_views import SampleViews  # noqa: E402
from reelhouse.streaming import jobs  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def consume(df) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def seconds(step) -> float:
    start = time.perf_counter()
    step()
    return time.perf_counter() - start


def write_inputs(views: SampleViews, files: str) -> None:
    csv_files.write_csv(views.ratings_raw(), f"{files}/ratings")
    csv_files.write_csv(views.movies_raw(), f"{files}/movies")
    csv_files.write_csv(views.tags_raw(), f"{files}/tags")
    views.platform_events().write.parquet(f"{files}/events")
    event_log.write_message_files(views.platform_events(), f"{files}/messages")


def pipeline_times(spark, files: str) -> tuple[Lakehouse, dict[str, float]]:
    house = Lakehouse(spark, new_work_path(spark, "bench-lakehouse"))
    inputs = (
        csv_files.read_ratings(spark, f"{files}/ratings"),
        csv_files.read_movies(spark, f"{files}/movies"),
        csv_files.read_tags(spark, f"{files}/tags"),
    )
    steps = {
        "job_bronze_ingest": lambda: house.ingest(*inputs, registry.CUTOFF_YEAR),
        "job_silver": house.refine,
        "job_genre_decade_stats": house.store_genre_decade,
        "job_rating_distribution": house.store_distribution,
        "job_train_score_store": house.recommend,
    }
    times = {name: [] for name in steps}
    for _ in range(RUNS):
        for name, step in steps.items():
            times[name].append(seconds(step))
    return house, {name: statistics.median(runs) for name, runs in times.items()}


def stream(spark, files: str, start) -> None:
    work = new_work_path(spark, "bench-stream")
    messages = event_log.read_message_files(spark, f"{files}/messages")
    start(messages, f"{work}/out", f"{work}/checkpoints", until_caught_up=True).awaitTermination()


def report_times(spark, house: Lakehouse, files: str) -> dict[str, float]:
    recommendations, movies = house.recommendations.read(), house.movies.read()
    stats, distribution = house.genre_decade.read(), house.distribution.read()
    events = spark.read.parquet(f"{files}/events")
    results = new_work_path(spark, "bench-results")
    event_windows.trending(events).write.parquet(f"{results}/trending")
    event_windows.genre_activity(events).write.parquet(f"{results}/activity")
    trending = spark.read.parquet(f"{results}/trending")
    activity = spark.read.parquet(f"{results}/activity")
    documents = f"{results}/documents"

    def store_documents():
        rows = replicas.for_point_reads(replicas.user_documents(recommendations), "user_id")
        rows.write.mode("overwrite").parquet(documents)

    store_documents()
    user = registry.USER_ID
    ratings = house.ratings.read()
    reports = {
        "report_genre_decade_stats": lambda: consume(gold.genre_decade_stats(ratings)),
        "report_rating_distribution": lambda: consume(gold.rating_distribution(ratings)),
        "report_user_recommendations": lambda: consume(
            insights.user_recommendations(recommendations, movies, user)
        ),
        "report_most_recommended": lambda: consume(
            insights.most_recommended_movies(recommendations, movies)
        ),
        "report_top_genre_by_decade": lambda: consume(
            insights.top_genre_by_decade(stats, registry.MIN_RATINGS)
        ),
        "report_prediction_diversity": lambda: consume(
            insights.prediction_diversity(recommendations)
        ),
        "report_rating_percentages": lambda: consume(
            insights.rating_percentages(distribution)
        ),
        "report_novelty_vs_classic": lambda: consume(
            insights.novelty_vs_classic(recommendations, movies)
        ),
        "report_user_document": lambda: consume(
            live.user_document(spark.read.parquet(documents), user)
        ),
        "report_trending_top_k": lambda: consume(live.trending_top_k(trending)),
        "report_most_active_genres": lambda: consume(live.most_active_genres(activity)),
        "store_user_documents": store_documents,
        "window_trending": lambda: consume(event_windows.trending(events)),
        "window_trending_direct": lambda: consume(event_windows.trending(events, fold=False)),
        "window_trending_1d": lambda: consume(event_windows.trending(events, registry.DAY, fold=True)),
        "window_trending_1d_direct": lambda: consume(
            event_windows.trending(events, registry.DAY, fold=False)
        ),
        "window_genre_activity": lambda: consume(event_windows.genre_activity(events)),
        "window_rating_bursts": lambda: consume(event_windows.rating_bursts(events)),
        "stream_trending": lambda: stream(spark, files, jobs.start_trending),
        "stream_genre_activity": lambda: stream(spark, files, jobs.start_genre_activity),
    }
    return {
        name: statistics.median(seconds(step) for _ in range(RUNS))
        for name, step in reports.items()
    }


def query_times(spark) -> dict[str, float]:
    """Reports and windows computed from the raw tables in one plan each."""
    names = ["genre_decade_stats", "silver_enriched", "top_genre_by_decade", "trending_tumbling"]
    return {
        f"raw_{name}": statistics.median(
            seconds(lambda q=registry.all_queries()[name]: consume(q(spark, FOLDER)))
            for _ in range(RUNS)
        )
        for name in names
    }


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        int(CPUS),
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    views = SampleViews(spark, FOLDER)
    name_work_folder(spark)
    files = new_work_path(spark, "bench-input")
    write_inputs(views, files)
    house, queries = pipeline_times(spark, files)
    queries |= report_times(spark, house, files)
    queries |= query_times(spark)
    print(
        json.dumps(
            {
                "metric": "total seconds over all jobs, reports and windows",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in queries.items()},
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "ratings": house.bronze_ratings.read().count(),
                "recommendations": house.recommendations.read().count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
