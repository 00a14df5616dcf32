"""Reports, joins and aggregates on the driver tables, each with its SQL check."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import (
    catalog,
    editions,
    mean6,
    supplier_nations,
    table,
    to_places,
)
from shelfmark.functions.lookup import titled_lookup
from shelfmark.functions.text import empty_to_null, guarded_decimal
from shelfmark.operators.predict import dominant_category
from shelfmark.operators.quality import orphans
from shelfmark.operators.shape import ordered_distinct_concat
from shelfmark.plans import reports

QUERIES = {}


def query(name, sql=None):
    def register(run):
        QUERIES[name] = (run, sql)
        return run

    return register


def as_double(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


PLAYER_MEANS = f"""
means AS (
  SELECT l_partkey AS id, {mean6("CAST(sum(l_quantity) * 100 AS BIGINT)", "count(*)")} AS m6
  FROM lineitem GROUP BY l_partkey
)"""
SELLERS = """
sellers AS (
  SELECT DISTINCT l_partkey AS id, s_name, n_name
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
)"""
CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"


@query(
    "platform_stats",
    f"""
WITH {PLAYER_MEANS}, {SELLERS},
releases AS (SELECT DISTINCT id, n_name FROM sellers),
joined AS (
  SELECT n_name, r.id, {CENTS} AS cents, m6
  FROM releases r LEFT JOIN part ON p_partkey = r.id LEFT JOIN means ON means.id = r.id
)
SELECT n_name AS platform, count(*) AS games_count,
  {mean6("sum(cents)", "count(cents)")} / 1000000.0 AS avg_critic_score,
  CAST((2 * sum(m6) * 10000 + count(m6)) // (2 * count(m6)) AS BIGINT) / 10000000000.0
    AS avg_player_score_over_games
FROM joined GROUP BY n_name
""",
)
def platform_stats(spark, sf_dir):
    return as_double(
        reports.platform_stats(catalog(spark, sf_dir)),
        "avg_critic_score",
        "avg_player_score_over_games",
    )


EDITIONS = """
editions AS (
  SELECT l_partkey * 10000 + year(l_shipdate) AS id, l_partkey, year(l_shipdate) AS year,
    CAST(sum(l_quantity) * 100 AS BIGINT) AS s, count(*) AS n
  FROM lineitem GROUP BY ALL
)"""
RANKED = """
SELECT genre, CAST(year AS INTEGER) AS year, CAST(year AS VARCHAR) AS year_label,
  id AS moby_id, p_name AS name_, score
FROM (
  SELECT *, row_number() OVER (PARTITION BY genre, year ORDER BY score DESC, id) AS place
  FROM scored
) WHERE place <= 10"""


@query(
    "top_rated_players",
    f"""
WITH {EDITIONS},
scored AS (
  SELECT p_type AS genre, year, id, p_name, {to_places(mean6("s", "n"), 2)} AS score
  FROM editions JOIN part ON p_partkey = l_partkey
)
{RANKED}""",
)
def top_rated_players(spark, sf_dir):
    return as_double(reports.top_rated_by_players(editions(spark, sf_dir), n=10), "score")


@query(
    "top_rated_critics",
    f"""
WITH {EDITIONS},
scored AS (
  SELECT p_type AS genre, year, id, p_name, {CENTS} / 100.0 AS score
  FROM editions JOIN part ON p_partkey = l_partkey
)
{RANKED}""",
)
def top_rated_critics(spark, sf_dir):
    best = reports.top_rated_by_critics(editions(spark, sf_dir), n=10, precision=8)
    return as_double(best, "score")


@query(
    "top_by_two_facets",
    f"""
SELECT p_type AS genre_name, p_brand AS setting_name, p_partkey AS moby_id, p_name AS name_,
  {CENTS} / 100.0 AS score
FROM (
  SELECT *, row_number() OVER (PARTITION BY p_type, p_brand
    ORDER BY p_retailprice DESC, p_partkey) AS place
  FROM part
) WHERE place <= 5""",
)
def top_by_two_facets(spark, sf_dir):
    best = reports.top_games_by_genre_setting(catalog(spark, sf_dir), n=5, precision=8)
    return as_double(best, "score")


@query(
    "top_devs_by_genre",
    f"""
WITH {SELLERS},
makers AS (SELECT DISTINCT id, s_name FROM sellers),
means AS (
  SELECT p_type AS genre, s_name AS developer,
    {to_places(mean6(f"sum({CENTS})", "count(*)"), 3)} AS avg_critic_score,
    count(DISTINCT id) AS games_count
  FROM makers JOIN part ON p_partkey = id GROUP BY p_type, s_name
)
SELECT genre, developer, avg_critic_score, games_count FROM (
  SELECT *, row_number() OVER (PARTITION BY genre
    ORDER BY avg_critic_score DESC, developer) AS place
  FROM means
) WHERE place <= 5""",
)
def top_devs_by_genre(spark, sf_dir):
    best = reports.top_developers_by_genre(catalog(spark, sf_dir), n=5)
    return as_double(best, "avg_critic_score")


@query(
    "consensus_profile",
    f"""
WITH {PLAYER_MEANS}, {SELLERS},
best AS (SELECT id FROM means ORDER BY m6 DESC, id LIMIT 50),
pairs AS (
  SELECT 'developer' AS facet, s_name AS value
    FROM (SELECT DISTINCT id, s_name FROM sellers) JOIN best USING (id)
  UNION ALL
  SELECT 'publisher', n_name FROM (SELECT DISTINCT id, n_name FROM sellers) JOIN best USING (id)
  UNION ALL
  SELECT 'genre', p_type FROM part JOIN best ON id = p_partkey
  UNION ALL
  SELECT 'setting', p_brand FROM part JOIN best ON id = p_partkey
),
placed AS (
  SELECT facet, value, row_number() OVER (PARTITION BY facet ORDER BY count(*) DESC, value) AS place
  FROM pairs GROUP BY facet, value
)
SELECT facet, min(value) FILTER (WHERE place = 1) AS winner,
  string_agg(value, '; ' ORDER BY place) AS top_list,
  'Top 50 player-rated games aggregated' AS recommended_based_on
FROM placed WHERE place <= 10 GROUP BY facet""",
)
def consensus_profile(spark, sf_dir):
    return reports.consensus_profile(catalog(spark, sf_dir))


@query(
    "top_by_distinct_volume",
    """
SELECT s_name, count(DISTINCT l_partkey) AS games_count
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
GROUP BY s_name ORDER BY games_count DESC, s_name LIMIT 5""",
)
def top_by_distinct_volume(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    credits = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return reports.top_by_volume(credits, "s_name", "l_partkey", 5)


@query(
    "pair_collaborations",
    """
SELECT c_name AS director, s_name AS developer, count(DISTINCT l_orderkey) AS games_count
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
GROUP BY c_name, s_name HAVING count(DISTINCT l_orderkey) >= 2
ORDER BY games_count DESC, director, developer LIMIT 10""",
)
def pair_collaborations(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    credits = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("c_name").alias("director"),
            F.col("s_name").alias("developer"),
            F.col("l_orderkey").alias("moby_id"),
        )
    )
    return reports.pair_collaborations(credits, "director", "developer", "moby_id", 10, 2)


@query(
    "facet_filter_type",
    """
SELECT p_partkey AS moby_id, p_name AS name_, p_type AS value
FROM part WHERE p_type = 'ECONOMY'""",
)
def facet_filter_type(spark, sf_dir):
    return reports.games_for_facet(catalog(spark, sf_dir), "genre", "ECONOMY")


@query(
    "facet_filter_supplier",
    """
SELECT DISTINCT p_partkey AS moby_id, p_name AS name_, s_name AS value
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
WHERE s_name = 'Supplier#000000007'""",
)
def facet_filter_supplier(spark, sf_dir):
    return reports.games_for_facet(catalog(spark, sf_dir), "developer", "Supplier#000000007")


@query(
    "facet_options",
    """
SELECT 'genre' AS facet, value FROM (SELECT DISTINCT p_type AS value FROM part)
UNION ALL SELECT 'developer', value FROM (
  SELECT DISTINCT s_name AS value FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
UNION ALL SELECT 'platform', value FROM (
  SELECT DISTINCT n_name AS value FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey)""",
)
def facet_options(spark, sf_dir):
    tables = catalog(spark, sf_dir)
    parts = [
        reports.facet_options(tables, f).select(F.lit(f).alias("facet"), "value")
        for f in ("genre", "developer", "platform")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).orderBy("facet", "value")


@query(
    "user_history",
    """
SELECT CAST(o_custkey AS VARCHAR) AS username_pk, l_partkey AS moby_id, p_name AS game_name,
  n_name AS platform, CAST(l_quantity AS VARCHAR) AS score, l_returnflag AS title,
  l_linestatus AS body, strftime(l_shipdate, '%Y-%m-%d') AS date
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN part ON p_partkey = l_partkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
)
def user_history(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    nations = supplier_nations(spark, sf_dir).select("s_suppkey", "n_name")
    reviews = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(nations, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("o_custkey").cast("string").alias("username_pk"),
            F.col("l_partkey").alias("moby_id"),
            F.col("n_name").alias("platform"),
            F.col("l_quantity").cast("string").alias("score"),
            F.col("l_returnflag").alias("title"),
            F.col("l_linestatus").alias("body"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        )
    )
    tables = catalog(spark, sf_dir)
    return reports.user_history(type(tables)({**tables.tables, "player_reviews": reviews}))


@query(
    "unknown_label_counts",
    """
SELECT COALESCE(CAST(quality AS VARCHAR), 'Unknown Quality') AS quality_name, count(*) AS n
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
)
def unknown_label_counts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    name = F.coalesce(F.col("quality").cast("string"), F.lit("Unknown Quality"))
    return (
        documents.join(labels, "doc_id", "left")
        .groupBy(name.alias("quality_name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "anti_join_orphans",
    """
SELECT doc_id, lang, source FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def anti_join_orphans(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return orphans(documents, table(spark, sf_dir, "labels"), ["doc_id"])


EVENT_NAMES = {"signup": "Sign-up", "purchase": "Purchase order", "error": "Failure"}


@query(
    "dict_lookup_default",
    """
SELECT CASE event_type WHEN 'signup' THEN 'Sign-up' WHEN 'purchase' THEN 'Purchase order'
  WHEN 'error' THEN 'Failure' ELSE upper(event_type[1]) || event_type[2:] END AS event_name,
  count(*) AS n
FROM events GROUP BY 1""",
)
def dict_lookup_default(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type")
    named = events.select(titled_lookup("event_type", EVENT_NAMES).alias("event_name"))
    return named.groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "numeric_guard",
    """
SELECT event_id, CAST(CASE WHEN regexp_matches(t, '^[0-9]+\\.?[0-9]*$') THEN t END
  AS DOUBLE) AS score
FROM (
  SELECT event_id, CASE event_type
    WHEN 'click' THEN k || '%' WHEN 'view' THEN k || '.' WHEN 'error' THEN ''
    WHEN 'signup' THEN k || '.5' ELSE k END AS t
  FROM (SELECT event_id, event_type, regexp_extract(props, '[0-9]+') AS k FROM events)
)""",
)
def numeric_guard(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    k = F.regexp_extract("props", "[0-9]+", 0)
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(k, F.lit("%")))
        .when(kind == "view", F.concat(k, F.lit(".")))
        .when(kind == "error", F.lit(""))
        .when(kind == "signup", F.concat(k, F.lit(".5")))
        .otherwise(k)
    )
    return events.select(
        "event_id", guarded_decimal(empty_to_null(text)).cast("double").alias("score")
    )


@query(
    "year_range_filter",
    """
SELECT o_orderkey, year(o_orderdate) AS year, o_totalprice FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 1998 AND o_orderstatus <> 'F'""",
)
def year_range_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"
    )
    kept = reports.games_released(
        orders, "o_orderdate", 1996, 1998, [F.col("o_orderstatus") == "F"], "o_totalprice"
    )
    return kept.select(
        "o_orderkey", F.year("o_orderdate").cast("long").alias("year"), "o_totalprice"
    )


@query(
    "ordered_distinct_concat",
    """
SELECT user_id, string_agg(event_type, '; ' ORDER BY first_at, id) AS event_types
FROM (SELECT user_id, event_type, min(ts) AS first_at, arg_min(event_id, (ts, event_id)) AS id
  FROM events GROUP BY 1, 2)
GROUP BY user_id""",
)
def ordered_concat(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return ordered_distinct_concat(
        events, ["user_id"], "event_type", ["ts", "event_id"], "event_types"
    )


@query(
    "dominant_category",
    """
SELECT user_id, event_type, n FROM (
  SELECT user_id, event_type, count(*) AS n,
    row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS place
  FROM events GROUP BY 1, 2
) WHERE place = 1""",
)
def dominant(spark, sf_dir):
    return dominant_category(table(spark, sf_dir, "events"), ["user_id"], "event_type")
