"""Time the batch jobs on many shifted copies of the sample ratings.

Usage: python -m checks.scale_trial FOLDER COPIES

With the sf0.1 folder and 54 copies this gives 32 million ratings by about
200,000 users of 80,000 movies, the size the recorded baseline was taken at.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import CUTOFF_YEAR
from reelhouse.plans.lakehouse import Lakehouse
from checks.work_folder import name_work_folder
from reelhouse.session import build_session, new_work_path
from reelhouse.sources import csv_files
from reelhouse.sources.sample_views import SampleViews

USER_GROUPS, USERS_PER_GROUP = 14, 15_000
MOVIE_GROUPS, MOVIES_PER_GROUP = 4, 20_000


def _ratings(views: SampleViews, copies: int) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    return views.ratings_raw().select("*", copy).select(
        (F.col("userId") + F.col("copy") % USER_GROUPS * USERS_PER_GROUP).alias("userId"),
        (F.col("movieId") + F.col("copy") % MOVIE_GROUPS * MOVIES_PER_GROUP).alias("movieId"),
        "rating",
        (F.col("timestamp") + F.col("copy")).alias("timestamp"),
    )


def _movies(views: SampleViews) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(0), F.lit(MOVIE_GROUPS - 1))).alias("copy")
    return views.movies_raw().select("*", copy).select(
        (F.col("movieId") + F.col("copy") * MOVIES_PER_GROUP).alias("movieId"),
        "title",
        "genres",
    )


def main(folder: str, copies: int) -> None:
    spark = build_session(
        "scale-trial",
        "local[8]",
        32,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "20g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    name_work_folder(spark)
    views, files = SampleViews(spark, folder), new_work_path(spark, "scale-input")
    csv_files.write_csv(_ratings(views, copies).repartition(64), f"{files}/ratings")
    csv_files.write_csv(_movies(views), f"{files}/movies")
    csv_files.write_csv(views.tags_raw(), f"{files}/tags")
    house = Lakehouse(spark, new_work_path(spark, "scale-lakehouse"))
    inputs = (
        csv_files.read_ratings(spark, f"{files}/ratings"),
        csv_files.read_movies(spark, f"{files}/movies"),
        csv_files.read_tags(spark, f"{files}/tags"),
    )
    steps = {
        "bronze_ingest": lambda: house.ingest(*inputs, CUTOFF_YEAR),
        "silver": house.refine,
        "genre_decade_stats": house.store_genre_decade,
        "rating_distribution": house.store_distribution,
        "train_score_store": house.recommend,
    }
    times = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        times[name] = round(time.perf_counter() - start, 2)
        print(name, times[name], file=sys.stderr, flush=True)
    times["ratings"] = house.ratings.read().count()
    times["recommendations"] = house.recommendations.read().count()
    print(json.dumps(times))


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]))
