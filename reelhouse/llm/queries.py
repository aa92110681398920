"""The corpus operators as queries over the given tables, and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import (
    byte_bpe,
    cotraining,
    covering_simhash,
    hash_tree_shards,
    hd_language,
    heap_counts,
    html_extraction,
    int8_neighbours,
    pivot_clusters,
    segment_search,
    url_rules,
    vector_packing,
    word_runs,
)

SHARDS = 24
RULES = (
    url_rules.Rule("allow", "org", "/"),
    url_rules.Rule("block", "example.org", "/es/"),
    url_rules.Rule("block", "example.org", "/en/1"),
    url_rules.Rule("allow", "com", "/fr/"),
    url_rules.Rule("block", "com", "/de/"),
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# Usable vectors, the least one of a repeated id.
_VECTORS = """
    select vec_id, min(embedding) as embedding from embeddings
    where vec_id is not null and embedding is not null
      and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)
    group by vec_id
"""


@_query
def op1_segment_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Each hundredth vector's 10 highest integer inner products, by segment statistics."""
    is_query = F.col("vec_id") % 100 == 0
    return segment_search.exact_top_k(read(spark, folder, "embeddings"), is_query, k=10)


_SQL["op1_segment_top_k"] = f"""
    with vectors as ({_VECTORS}),
    whole as (
        select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from vectors
    ),
    scored as (
        select q.vec_id as query_id, c.vec_id,
               cast(list_inner_product(q.v, c.v) as bigint) as score
        from whole q join whole c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
    )
    select query_id, vec_id, score,
           cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
    from scored
    qualify rank <= 10
"""


@_query
def op2_vector_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as pieces of at most 4096 tokens in as few sequences as best fit finds."""
    docs = read(spark, folder, "documents")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = vector_packing.token_pieces(docs, tokenizer, max_tokens=4096, end_id=1)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = vector_packing.pack(digests, docs.count(), vector_packing.Capacities(tokens=4096))
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@_query
def op3_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards of a tree of weighted hash draws, and in 25."""
    docs = read(spark, folder, "documents")
    tree, grown = (hash_tree_shards.even_tree(n) for n in (SHARDS, SHARDS + 1))
    return hash_tree_shards.shard_documents(docs, tree, grown)


@_query
def op4_covering_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's SimHash of 3-word shingles and its component at 3 differing bits."""
    docs = read(spark, folder, "documents")
    found = covering_simhash.near_duplicates(docs, words=3, radius=3, seed=42)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@_query
def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's host, path, longest fitting rule and verdict."""
    rules = url_rules.rule_table(spark, RULES)
    return url_rules.judge_pages(read(spark, folder, "pages"), rules)


_RULE_ROWS = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
_SQL["op5_url_rules"] = f"""
    with rules(verdict, host, path) as (values {_RULE_ROWS}),
    rests as (
        select page_id, case when contains(url, '://')
            then substring(url, position('://' in url) + 3) else '' end as rest
        from pages
    ),
    parts as (
        select page_id, translate(regexp_extract(rest, '^[^/?#]*'),
            '{url_rules.UPPER}', '{url_rules.UPPER.lower()}') as host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
        from rests
    ),
    places as (select distinct host, path from parts),
    best as (
        select p.host, p.path, max_by(r, length(r.host || r.path)) as r
        from places p join rules r
          on (p.host = r.host or p.host like '%.' || r.host) and starts_with(p.path, r.path)
        group by all
    )
    select parts.page_id, parts.host, parts.path, best.r.host || best.r.path as rule,
           coalesce(best.r.verdict, 'allow') as verdict
    from parts left join best using (host, path)
"""


@_query
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids by the byte-level ranks, and the bytes they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = byte_bpe.encode(read(spark, folder, "documents"), ranks, decoded=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op7_int8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Each twentieth vector's 20 largest inner products, by int8 tiles."""
    is_query = F.col("vec_id") % 20 == 0
    return int8_neighbours.nearest(read(spark, folder, "embeddings"), is_query, k=20)


_SQL["op7_int8_neighbours"] = f"""
    with vectors as (
        select vec_id, list_transform(embedding, lambda x: x::double) as v from ({_VECTORS})
        where list_bool_or(list_transform(embedding, lambda x: x <> 0))
    ),
    scored as (
        select q.vec_id as query_id, c.vec_id,
               list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]),
                           lambda x, y: x + y) as score
        from vectors q join vectors c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
    )
    select query_id, vec_id, score,
           cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
    from scored
    qualify rank <= 20
"""


@_query
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's main text, by the maximum-scoring subsequence of its tokens."""
    pages = read(spark, folder, "pages")
    return html_extraction.extract(pages, html_extraction.learn_weights(pages))


@_query
def op9_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality by two co-trained views, and whether it is kept."""
    docs = read(spark, folder, "documents")
    model = cotraining.learn(docs, read(spark, folder, "labels"))
    columns = ("doc_id", "text_score", "metadata_score", "score", "keep")
    return cotraining.score(docs, model).select(*columns)


@_query
def op10_hd_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language, learned from the documents outside the held-out quarter."""
    docs = read(spark, folder, "documents")
    prototypes = hd_language.learn(docs.where(~hd_language.held_out(F.col("doc_id"))))
    return hd_language.identify(docs, prototypes).select(
        "doc_id", hd_language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@_query
def op11_pivot_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector of 64 components in one of 8 clusters, by bounds from a pivot table."""
    return pivot_clusters.cluster_vectors(read(spark, folder, "embeddings"), clusters=8, rounds=10)


def _cluster_sql(clusters: int = 8, rounds: int = 10, components: int = 64) -> str:
    """The rounds one after the other; ``moved<n>`` holds the centroids after round n."""
    steps = [
        f"""whole as materialized (
        select row_number() over () as row, vec_id,
               list_transform(embedding, lambda x: cast(floor(1024 * x::double) as bigint)) as v
        from embeddings
        where len(embedding) = {components}
          and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    )""",
        f"""moved0 as materialized (
        select cast(row_number() over (order by sha256('3:' || vec_id), v) - 1 as integer) as cluster, v
        from whole qualify cluster < {clusters}
    )""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""near{n} as materialized (
        select row, arg_min(cluster, (d, cluster)) as cluster, min(d) as distance
        from (
            select row, c.cluster, cast(list_sum(list_transform(list_zip(w.v, c.v),
                   lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as d
            from whole w cross join moved{n} c
        ) group by row
    )""")
        if n < rounds:
            steps.append(f"""moved{n + 1} as materialized (
        select cluster, coalesce(m.v, o.v) as v from moved{n} o left join (
            select cluster, list(floor_of order by place) as v from (
                select cluster, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as floor_of
                from (
                    select cluster, unnest(w.v) as x, unnest(range(1, {components + 1})) as place
                    from near{n} join whole w using (row)
                ) group by cluster, place
            ) group by cluster
        ) m using (cluster)
    )""")
    return f"""
    with {", ".join(steps)}
    select vec_id, cluster, distance,
           cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
           cast(sum(distance) over () as bigint) as inertia,
           sha256(array_to_string(c.v, ',')) as centroid_sha256
    from near{rounds} join whole using (row) join moved{rounds} c using (cluster)
"""


_SQL["op11_pivot_clusters"] = _cluster_sql()


@_query
def op12_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's runs of repeated words, the longest of them, and the text without repeats."""
    docs = word_runs.with_repeats(read(spark, folder, "documents"))
    digest = lambda name: F.sha2(F.col(name), 256)
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(""))
    found = word_runs.find_document_runs(docs, shortest=12)
    found = found.withColumns({"lines": lines, "best": word_runs.longest("runs")})
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        digest("lines").alias("runs_sha256"),
        digest("collapsed").alias("collapsed_sha256"),
    )


@_query
def op13_heap_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's number of byte-level tokens, by merging pairs from a heap."""
    definition = public_tokenizers.path("byte_bpe_50k.json")
    return heap_counts.count_tokens(read(spark, folder, "documents"), definition, limit=512)
