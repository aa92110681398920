"""Physical plans: what must, and what must not, be in them."""

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from checks.registry import all_queries
from reelhouse.functions import events as event_fn
from reelhouse.operators import event_windows
from reelhouse.plans import gold, insights, live, silver
from tests.conftest import SAMPLE_FOLDER, plan_of

# These run jobs and return what they stored: their plan is a scan. Scoring in als_ compares
# all users with all movies inside MLlib, as the README says.
EAGER = re.compile(
    "^(stored_|stream_|bronze_|snapshot_|reco_csv|replica_|als_|batch_union|rerun_|gold_presence"
    "|dq_report$|genre_decade_sorted|distribution_sorted)"
)
LAZY = sorted(n for n in all_queries() if not EAGER.match(n))


@pytest.mark.parametrize("name", LAZY)
def test_no_pair_joins_and_no_python(spark, name):
    plan = plan_of(all_queries()[name](spark, SAMPLE_FOLDER))
    for operator in ("CartesianProduct", "NestedLoop", "Python", "MapInPandas"):
        assert operator not in plan


def test_rating_dedupe_is_a_folding_hash_aggregate(sample):
    plan = plan_of(sample.ratings_clean())
    assert "partial_max(rating" in plan and "Sort" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_movie_dedupe_folds_before_the_shuffle(sample):
    assert re.search(r"WindowGroupLimit .* Partial", plan_of(sample.movies_clean()))


def test_genre_stats_fold_before_exploding(sample):
    plan = plan_of(gold.genre_decade_stats(sample.ratings_enriched()))
    assert plan.index("Generate explode") < plan.index("partial_count(rating")
    assert "o_orderdate" not in plan and "l_extendedprice" not in plan


def test_report_limits_before_its_lookup(sample):
    plan = plan_of(
        insights.most_recommended_movies(
            sample.recommendation_scores(), sample.movies_clean()
        )
    )
    assert "TakeOrderedAndProject" in plan


def test_static_windows_fold_panes_with_hash_aggregates(sample):
    plan = plan_of(event_windows.genre_activity(sample.platform_events()))
    assert plan.index("Generate explode") < plan.index("partial_count(1)")
    assert "SortAggregate" not in plan


def test_messages_are_parsed_once(spark, sample):
    messages = event_fn.to_wire(sample.platform_events())
    plan = event_windows.trending(event_fn.parse_wire(messages))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_large_dimension_is_not_broadcast(spark, sample):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = plan_of(silver.enrich_ratings(sample.ratings_clean(), sample.movies_clean()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_live_reports_read_only_the_dates_they_need(spark, tmp_path):
    ends = [datetime(2024, 1, d, h, tzinfo=timezone.utc) for d in range(1, 7) for h in (1, 2)]
    rows = [(end, end, m, f"m{m}", m, "g", 1) for end in ends for m in range(5)]
    schema = (
        "window_end timestamp, detected_at timestamp, movie_id long, movie_title string,"
        " rating_count long, genre string, event_count long"
    )
    dated = spark.createDataFrame(rows, schema).withColumns(
        {"window_date": F.to_date("window_end"), "detected_date": F.to_date("detected_at")}
    )
    dated = dated.withColumns({"session_start": F.col("detected_at"), "user_id": F.col("movie_id")})
    for date in ("window_date", "detected_date"):
        dated.write.partitionBy(date).parquet(f"{tmp_path}/{date}")
    windows, alerts = (spark.read.parquet(f"{tmp_path}/{d}") for d in ("window_date", "detected_date"))
    reports = (
        (live.trending_top_k(windows), live.trending_top_k(dated.drop("window_date"))),
        (live.most_active_genres(windows, 3), live.most_active_genres(dated.drop("window_date"), 3)),
        (live.alerts_since(alerts, ends[-1], 60), live.alerts_since(dated.drop("detected_date"), ends[-1], 60)),
    )
    for stored, plain in reports:
        assert re.search(r"PartitionFilters: \[isnotnull\(\w+_date#\d+\), \(\w+_date#\d+ >=", plan_of(stored))
        columns = [c for c in plain.columns if not c.endswith("_date")]
        assert sorted(map(repr, stored.select(columns).collect())) == sorted(
            map(repr, plain.select(columns).collect())
        )
