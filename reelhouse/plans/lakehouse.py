"""The batch pipeline over stored tables: raw, cleaned, aggregated.

Every step can be run again: raw tables are cleared first (as a logged delete,
so earlier versions stay readable) and all others are replaced in one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed
from reelhouse import schemas
from reelhouse.operators import quality
from reelhouse.operators.lookups import fits_broadcast
from reelhouse.plans import bronze, gold, recommender, silver
from reelhouse.plans.replicas import for_point_reads
from reelhouse.session import small_tasks
from reelhouse.sources import csv_files
from reelhouse.sources.lake import LakeTable


class Lakehouse:
    def __init__(self, spark: SparkSession, root: str):
        def table(name, schema, *partition_by):
            return LakeTable(spark, f"{root}/{name}", schema, partition_by)

        self.spark = spark
        self.bronze_ratings = table("bronze/ratings", schemas.BRONZE_RATINGS, "batch_id")
        self.bronze_movies = table("bronze/movies", schemas.BRONZE_MOVIES)
        self.bronze_tags = table("bronze/tags", schemas.BRONZE_TAGS)
        self.movies = table("silver/movies", schemas.SILVER_MOVIES)
        self.ratings = table("silver/ratings_enriched", schemas.SILVER_RATINGS, "rating_year")
        self.tags = table("silver/tags_clean", schemas.SILVER_TAGS)
        self.recommendations = table("gold/recommendations", schemas.GOLD_RECOMMENDATIONS)
        self.genre_decade = table("gold/stats_genre_decade", schemas.GOLD_GENRE_DECADE)
        self.distribution = table(
            "gold/rating_distribution", schemas.GOLD_RATING_DISTRIBUTION
        )

    def tables(self) -> dict[str, LakeTable]:
        return {
            "bronze_ratings": self.bronze_ratings,
            "bronze_movies": self.bronze_movies,
            "bronze_tags": self.bronze_tags,
            "silver_movies": self.movies,
            "silver_ratings_enriched": self.ratings,
            "silver_tags_clean": self.tags,
            "gold_recommendations": self.recommendations,
            "gold_stats_genre_decade": self.genre_decade,
            "gold_rating_distribution": self.distribution,
        }

    def register_views(self) -> None:
        """Name the current version of every stored table for ``spark.sql``."""
        for name, table in self.tables().items():
            if table.exists():
                table.read().createOrReplaceTempView(name)

    # -- raw -------------------------------------------------------------

    def ingest(
        self,
        ratings: DataFrame,
        movies: DataFrame,
        tags: DataFrame,
        cutoff_year: int = fixed.BATCH_CUTOFF_YEAR,
    ) -> int:
        """Replace the raw tables and return the number of input ratings.

        Ratings are read once: the pass that leaves a commit per batch also
        counts what the files held.
        """
        seen = Observation()
        read = csv_files.with_provenance(ratings, bronze.rating_batch(cutoff_year))
        self.bronze_ratings.append_batches(
            read.observe(seen, F.count("*").alias("input_rows")),
            bronze.RATING_BATCHES,
            overflow=bronze.UNDATED_BATCH,
            clear=True,
        )
        for raw, rows in ((self.bronze_movies, movies), (self.bronze_tags, tags)):
            raw.append(
                csv_files.with_provenance(rows, fixed.DIMENSION_BATCH),
                fixed.DIMENSION_BATCH,
                clear=True,
            )
        return seen.get["input_rows"]

    def check_raw(self, input_rows: int) -> None:
        """Fail unless every input rating is stored, in range, in two commits or more."""
        quality.require_ok(self.raw_report(input_rows))

    def raw_report(self, input_rows: int) -> DataFrame:
        """The checks of the stored raw ratings, in one pass over them.

        Only appends since the ratings were last cleared count as commits.
        """
        log = self.bronze_ratings.snapshots()
        cleared = log.filter("operation <> 'append'").agg(F.max("seq")).scalar()
        appends = log.filter(
            (F.col("operation") == "append") & (F.col("seq") > F.coalesce(cleared, F.lit(0)))
        )
        missing = F.greatest(F.lit(2) - F.count("*"), F.lit(0))
        return quality.stored_report(self.bronze_ratings.read(), input_rows).unionByName(
            quality.report_of(appends.agg(missing.alias("bronze_has_two_commits")))
        )

    def cleaned_report(self) -> DataFrame:
        """The checks of the stored cleaned ratings."""
        return quality.bad_row_counts(
            self.ratings.read(), {"silver_null_key": quality.null_rating_key()}
        )

    # -- cleaned ---------------------------------------------------------

    def refine(self) -> None:
        self.movies.overwrite(silver.clean_movies(self.bronze_movies.read()))
        with small_tasks(self.spark, self.bronze_ratings.row_count()):
            self._store_enriched()
        with small_tasks(self.spark, self.bronze_tags.row_count()):
            self.tags.overwrite(silver.clean_tags(self.bronze_tags.read()))

    def _store_enriched(self) -> None:
        """Join and store by year, straight from the join: the wide rows are not shuffled
        again, and each task writes a file for each year it holds.
        """
        movies = self.movies.read()
        if fits_broadcast(movies):
            movies = F.broadcast(movies)
        enriched = silver.clean_and_enrich(self.bronze_ratings.read(), movies)
        self.ratings.overwrite(enriched, spread=False)

    def check_cleaned(self) -> None:
        quality.require_ok(self.cleaned_report())

    # -- aggregated ------------------------------------------------------

    def store_genre_decade(self) -> None:
        self.genre_decade.overwrite(gold.genre_decade_stats(self.ratings.read()))

    def store_distribution(self) -> None:
        self.distribution.overwrite(gold.rating_distribution(self.ratings.read()))

    def genre_decade_in_order(self) -> DataFrame:
        return self.genre_decade.read().orderBy("genre", "decade")

    def distribution_in_order(self) -> DataFrame:
        return self.distribution.read().orderBy("rating")

    def aggregate(self) -> None:
        self.store_genre_decade()
        self.store_distribution()

    def recommend(
        self,
        fraction: float = fixed.SAMPLE_FRACTION,
        seed: int = fixed.SAMPLE_SEED,
        blocks: int = fixed.ALS_BLOCKS,
    ) -> None:
        """Train on a sample and store the top movies of each trained user.

        ``fraction`` of the ratings is drawn with ``seed``, which the model starts
        from as well; ``blocks`` are the model's factor blocks.
        """
        sample = recommender.training_sample(self.ratings.read(), fraction, seed)
        model = recommender.train(sample, seed, blocks)
        scores = gold.enrich_recommendations(
            recommender.top_scores(model), self.movies.read()
        )
        self.recommendations.overwrite(for_point_reads(scores, "userId"))

    def gold_ready(self) -> bool:
        """Whether recommendations have been stored."""
        return self.recommendations.exists() and not self.recommendations.read().isEmpty()

    def run(
        self,
        ratings: DataFrame,
        movies: DataFrame,
        tags: DataFrame,
        cutoff_year: int = fixed.BATCH_CUTOFF_YEAR,
        fraction: float = fixed.SAMPLE_FRACTION,
        seed: int = fixed.SAMPLE_SEED,
        blocks: int = fixed.ALS_BLOCKS,
    ) -> None:
        self.check_raw(self.ingest(ratings, movies, tags, cutoff_year))
        self.refine()
        self.check_cleaned()
        self.recommend(fraction, seed, blocks)
        self.aggregate()
