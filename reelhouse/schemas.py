"""Explicit schemas of every stored table and input file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
STRING, BOOLEAN, TIMESTAMP = T.StringType(), T.BooleanType(), T.TimestampType()
STRINGS = T.ArrayType(STRING)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_PROVENANCE = {"ingestion_timestamp": TIMESTAMP, "source_file": STRING, "batch_id": STRING}

RATINGS_CSV = _struct(userId=INT, movieId=INT, rating=DOUBLE, timestamp=LONG)
MOVIES_CSV = _struct(movieId=INT, title=STRING, genres=STRING)
TAGS_CSV = _struct(userId=INT, movieId=INT, tag=STRING, timestamp=LONG)

BRONZE_RATINGS = T.StructType(RATINGS_CSV.fields + _struct(**_PROVENANCE).fields)
BRONZE_MOVIES = T.StructType(MOVIES_CSV.fields + _struct(**_PROVENANCE).fields)
BRONZE_TAGS = T.StructType(TAGS_CSV.fields + _struct(**_PROVENANCE).fields)

SILVER_MOVIES = _struct(
    movieId=INT,
    title_clean=STRING,
    genres=STRING,
    genre_list=STRINGS,
    release_year=INT,
    decade=INT,
    is_recent=BOOLEAN,
)
SILVER_RATINGS = _struct(
    userId=INT,
    movieId=INT,
    rating=DOUBLE,
    rating_normalized=DOUBLE,
    rating_date=TIMESTAMP,
    rating_year=INT,
    timestamp=LONG,
    title_clean=STRING,
    genres=STRING,
    genre_list=STRINGS,
    release_year=INT,
    decade=INT,
    is_recent=BOOLEAN,
)
SILVER_TAGS = TAGS_CSV

GOLD_RECOMMENDATIONS = _struct(
    userId=INT, movieId=INT, title=STRING, genres=STRING, predicted_score=DOUBLE
)
GOLD_GENRE_DECADE = _struct(
    genre=STRING, decade=INT, avg_rating=DOUBLE, total_ratings=LONG
)
GOLD_RATING_DISTRIBUTION = _struct(rating=DOUBLE, total=LONG)

USER_RECOMMENDATIONS = _struct(user_id=INT, movie_id=INT, predicted_score=DOUBLE)
USER_DOCUMENTS = _struct(
    user_id=INT, page=INT, items=T.ArrayType(_struct(movie_id=INT, predicted_score=DOUBLE))
)
DIM_MOVIE = _struct(movie_id=INT, title=STRING, genres=STRING)
GENRE_ACTIVITY = _struct(
    window_start=TIMESTAMP, window_end=TIMESTAMP, genre=STRING, event_count=LONG
)

PLATFORM_EVENT = _struct(
    event_id=STRING,
    event_type=STRING,
    user_id=LONG,
    movie_id=LONG,
    movie_title=STRING,
    genres=STRINGS,
    timestamp=STRING,
    session_id=STRING,
    rating=DOUBLE,
    watch_duration_seconds=INT,
)

COMMIT_LOG = _struct(
    seq=INT,
    commit_id=STRING,
    batch_id=STRING,
    committed_at=TIMESTAMP,
    operation=STRING,
    added_rows=LONG,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns by name, in its order and with its types."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
