"""URL allow and block rules, joined on short hash prefixes of URL expressions.

A URL is expanded into host suffixes times path prefixes. Rules and expressions meet in an
equi-join on the first hex digits of their SHA-256 digests; the whole digests then confirm
the match, and the longest rule wins. Only built-in column functions are used.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, and every path that starts with ``path``."""

    verdict: str
    host: str
    path: str


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Rules as rows (verdict, host, path); repeated rules count once."""
    rows = sorted({(r.verdict, r.host, r.path) for r in rules})
    return spark.createDataFrame(rows, "verdict string, host string, path string")


def _host_suffixes(host: Column, label_counts: Column) -> Column:
    """The last n labels of the host for each n that some rule has."""
    labels = F.split(host, r"\.")
    fitting = F.filter(label_counts, lambda n: n <= F.size(labels))
    return F.transform(
        fitting, lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")
    )


def _path_prefixes(path: Column, lengths: Column) -> Column:
    """The first n characters of the path for each n that some rule has."""
    fitting = F.filter(lengths, lambda n: n <= F.length(path))
    return F.transform(fitting, lambda n: F.substr(path, F.lit(1), n))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def judge_urls(
    urls: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    prefix_digits: int = 8,
) -> DataFrame:
    """One row per distinct (host, path) of ``urls``: host, path, rule, verdict.

    ``rules`` has columns verdict, host and path, in the form of :func:`rule_table`. Among the
    rules that fit, the one with most characters wins; of those, the one with the longer host;
    of equal ones that disagree, block. Without a rule, ``rule`` is null and the verdict is
    ``default``. A null URL, or one without ``://``, has an empty host and path.

    Only suffixes and prefixes of a length that some rule has are expanded, which loses no
    match. Their number per URL is bounded by the rules, not by the URL.
    """
    host, path = url_parts(F.col(url))
    places = urls.select(host.alias("host"), path.alias("path")).distinct()
    sizes = rules.agg(
        F.collect_set(F.size(F.split("host", r"\."))).alias("label_counts"),
        F.collect_set(F.length("path")).alias("path_lengths"),
    ).first()
    label_counts, path_lengths = (
        F.array(*map(F.lit, sorted(found))).cast("array<int>")
        for found in (sizes.label_counts, sizes.path_lengths)
    )

    expressions = (
        places.withColumn("host_part", F.explode(_host_suffixes(F.col("host"), label_counts)))
        .withColumn("path_part", F.explode(_path_prefixes(F.col("path"), path_lengths)))
        .withColumn("digest", _digest(F.col("host_part"), F.col("path_part")))
        .select("host", "path", "digest", F.left("digest", F.lit(prefix_digits)).alias("short"))
    )
    listed = rules.select(
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.col("verdict").alias("listed_verdict"),
        _digest(F.col("host"), F.col("path")).alias("rule_digest"),
    ).withColumn("short", F.left("rule_digest", F.lit(prefix_digits)))

    best = (
        expressions.join(listed, "short")
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule").alias("length"), "host_length", "listed_verdict", "rule"
                )
            ).alias("best")
        )
    )
    return places.join(best, ["host", "path"], "left").select(
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.listed_verdict", F.lit(default)).alias("verdict"),
    )


def judge_pages(pages: DataFrame, rules: DataFrame, **options) -> DataFrame:
    """Every row of ``pages`` as page_id, host, path, rule and verdict.

    Each distinct place is judged once; rows then look their place up, and a place that holds a
    large share of the rows is split by adaptive execution. Other columns of ``pages`` are not
    read. Null page ids and repeated rows stay as they are.
    """
    host, path = url_parts(F.col("url"))
    judged = judge_urls(pages, rules, **options)
    return (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .join(judged, ["host", "path"], "left")
        .select("page_id", "host", "path", "rule", "verdict")
    )
