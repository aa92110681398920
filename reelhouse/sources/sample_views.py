"""Rating-shaped views over the order tables, for queries, checks and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelhouse.operators.dedup import top_per_key
from reelhouse.plans import gold, silver
from reelhouse.session import small_tasks


class SampleViews:
    """Each method derives one input or stored table from the files in a folder."""

    def __init__(self, spark: SparkSession, folder: str, items: DataFrame | None = None):
        self.spark = spark
        self.folder = folder
        self._items = items

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- raw -------------------------------------------------------------

    def with_items_stored(self, path: str) -> tuple[SampleViews, int]:
        """The same views with the lines joined to their orders once, stored, and their number.

        Ratings and tags then share one join. The rows are counted as they are written.
        """
        seen = Observation()
        rows = self._sold_items().observe(seen, F.count("*").alias("n"))
        with small_tasks(self.spark, self._table("lineitem").count()):
            rows.write.option("compression", "zstd").parquet(path)
        stored = self.spark.read.schema(rows.schema).parquet(path)
        return SampleViews(self.spark, self.folder, stored), seen.get["n"]

    def _sold_items(self) -> DataFrame:
        if self._items is not None:
            return self._items
        items = self._table("lineitem").withColumn(
            "timestamp", F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))
        )
        return items.join(
            self._table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        ).select(
            F.col("o_custkey").cast("int").alias("userId"),
            F.col("l_partkey").cast("int").alias("movieId"),
            "timestamp",
            "l_quantity",
            "l_linenumber",
            "o_orderpriority",
        )

    def ratings_raw(self) -> DataFrame:
        return self._sold_items().select(
            "userId",
            "movieId",
            (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("rating"),
            "timestamp",
        )

    def movies_raw(self) -> DataFrame:
        """Some titles lack a year, some movies their genres, and some rows an id."""
        return self._table("part").selectExpr(
            "cast(if(p_partkey % 97 = 13, null, p_partkey) as int) as movieId",
            """case when p_partkey % 50 = 0 then p_name
                    else concat(p_name, ' (', 1930 + (p_partkey * 7) % 95, ')')
               end as title""",
            """case when p_partkey % 40 = 0 then '(no genres listed)'
                    else concat(p_type, '|', replace(p_name, ' ', '|'))
               end as genres""",
        )

    def tags_raw(self) -> DataFrame:
        """Tags with blanks, padding and mixed case."""
        priority = F.col("o_orderpriority")
        tag = (
            F.when(F.col("l_linenumber") == 7, "   ")
            .when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("  "), priority, F.lit(" ")))
            .otherwise(F.lower(priority))
        )
        return self._sold_items().select("userId", "movieId", tag.alias("tag"), "timestamp")

    def platform_events(self) -> DataFrame:
        """User events; movies that have no row give no title and no genres.

        Some lack their user, movie or time, and some are from before 1970.
        """
        kinds = F.create_map(
            *[
                F.lit(x)
                for pair in {
                    "purchase": "rating",
                    "view": "play_start",
                    "click": "search",
                    "signup": "add_to_favorites",
                }.items()
                for x in pair
            ]
        )
        odd = lambda n: F.col("event_id") % n == 1
        time = F.col("ts").cast("timestamp")
        past = time - F.expr("interval 60 years")
        events = self._table("events").select(
            F.col("event_id").cast("string").alias("event_id"),
            F.coalesce(
                F.try_element_at(kinds, F.col("event_type")), F.lit("play_stop")
            ).alias("event_type"),
            F.when(~odd(97), F.col("user_id")).alias("user_id"),
            F.when(~odd(89), F.get_json_object("props", "$.k").cast("bigint")).alias("movie_id"),
            F.when(~odd(83), F.when(odd(79), past).otherwise(time)).alias("event_ts"),
            "value",
        )
        movies = self.movies_raw().select(
            F.col("movieId").cast("bigint").alias("movie_id"),
            F.col("title").alias("movie_title"),
            F.split("genres", r"\|").alias("genres"),
        )
        rating = F.ceil(F.least("value", F.lit(100.0)) / 10).cast("double") / 2
        return (
            events.join(movies, "movie_id", "left")
            .withColumn("rating", F.when(F.col("event_type") == "rating", rating))
            .drop("value")
        )

    def event_arrivals(self) -> DataFrame:
        """Events with the time they came at, up to three days after they happened."""
        number = F.col("event_id").cast("bigint")
        delay = F.make_dt_interval(secs=(number * 7919) % (3 * 86_400))
        return self.platform_events().withColumns(
            {"event_no": number, "arrived_at": F.col("event_ts") + delay}
        )

    def vectors(self) -> DataFrame:
        """Finite vectors of one length: id, vector."""
        rows = self._table("embeddings").filter(F.size("embedding") == 64)
        return rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))

    # -- cleaned ---------------------------------------------------------

    def movies_clean(self) -> DataFrame:
        return silver.clean_movies(self.movies_raw())

    def ratings_clean(self) -> DataFrame:
        return silver.clean_ratings(self.ratings_raw())

    def ratings_enriched(self) -> DataFrame:
        return silver.enrich_ratings(self.ratings_clean(), self.movies_clean())

    # -- aggregated ------------------------------------------------------

    def recommendation_scores(self) -> DataFrame:
        """Ten movies per user under a formula, as a repeatable recommender output."""
        mix = (F.col("userId") * 31 + F.col("movieId") * 17) % 4000
        # Dealt by user once: the dedupe, the distinct pairs and the lists all follow that.
        cleaned = silver.clean_ratings(self.ratings_raw().repartition("userId"))
        seen = cleaned.select("userId", "movieId").distinct()
        best = top_per_key(
            seen.withColumn("mix", mix), ["userId"], [F.desc("mix"), F.asc("movieId")], 10
        )
        score = F.lit(1.0) + F.col("mix") / F.lit(1237.0)
        return best.select("userId", "movieId", score.alias("predicted_score"))

    def recommendations(self) -> DataFrame:
        return gold.enrich_recommendations(
            self.recommendation_scores(), self.movies_clean()
        )

    def dim_movie(self) -> DataFrame:
        movies = self.movies_raw().select("movieId", "title", "genres")
        return gold.recommended_movies(movies, self.recommendation_scores())
