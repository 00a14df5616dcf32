"""Scalar functions, page links and text rules on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import BASE_URL, table
from shelfmark.functions.text import (
    ends_in_name,
    explode_list,
    first_id_of_kinds,
    join_url,
    json_texts,
    page_key,
    rank_of_total,
    sha256_hex,
    synthetic_key,
    text_year,
    url_id,
    user_name,
    year_label,
)
from shelfmark.operators.predict import dominant_key, prediction_label
from shelfmark.operators.quality import derive_users, strength_failure
from shelfmark.operators.shape import conform, unpivot_ids
from shelfmark.plans.extract import (
    CRITIC_AVERAGE,
    CRITIC_COUNT,
    page_headings,
    page_links,
    summary_parts,
)
from shelfmark.sources.elements import Reading, elements

QUERIES = {}


def query(name, sql=None):
    def register(run):
        QUERIES[name] = (run, sql)
        return run

    return register


@query(
    "url_id",
    r"SELECT page_id, regexp_extract(url, '/en/([0-9]+)/', 1) AS slashed, "
    r"regexp_extract(url || '/', '/en/([0-9]+)/', 1) AS id FROM pages",
)
def url_ids(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    closed = F.concat("url", F.lit("/"))
    return pages.select(
        "page_id", url_id("url", "en").alias("slashed"), url_id(closed, "en").alias("id")
    )


@query(
    "first_id_of_kinds",
    r"""
SELECT page_id, COALESCE(nullif(regexp_extract(url, '/fr/([0-9]+)', 1), ''),
  nullif(regexp_extract(url, '/en/([0-9]+)', 1), ''),
  nullif(regexp_extract(url, '/de/([0-9]+)', 1), '')) AS id
FROM pages""",
)
def first_ids(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", first_id_of_kinds("url", ["fr", "en", "de"]).alias("id"))


@query(
    "synthetic_key",
    "SELECT doc_id, 'doc' || substr(md5(text), 1, 10) AS doc_key FROM documents",
)
def synthetic_keys(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", synthetic_key("doc", "text").alias("doc_key"))


@query("sha256_digest", "SELECT doc_id, sha256(text) AS digest FROM documents")
def digests(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", sha256_hex("text").alias("digest"))


@query(
    "url_tail",
    r"""
SELECT page_id, split_part(regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1), '?', 1)
  AS name
FROM pages""",
)
def url_tails(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", user_name("url").alias("name"))


@query(
    "suffix_match",
    r"""
SELECT page_id, link FROM (
  SELECT page_id, unnest(list_concat([url], regexp_extract_all(html, 'href="([^"]*)"', 1))) AS link FROM pages)
WHERE link LIKE '%/the' OR link LIKE '%/the/' OR link = 'the'""",
)
def suffix_match(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    found = F.explode(F.concat(F.array("url"), F.coalesce(links, F.array())))
    return pages.select("page_id", found.alias("link")).where(ends_in_name("link", "the"))


@query(
    "text_date_year",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER)
  END AS year,
  CASE WHEN o_orderstatus = 'P' THEN 'No Year' ELSE CAST(year(o_orderdate) AS VARCHAR) END
  AS year_label
FROM orders""",
)
def text_date_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy")).otherwise(
        F.date_format("o_orderdate", "MMMM d, yyyy")
    )
    return orders.select("o_orderkey", text_year(text).alias("year")).withColumn(
        "year_label", year_label("year")
    )


@query(
    "rank_of_total",
    """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS rank,
  CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) || ' parts' END AS total
FROM part""",
)
def ranks(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    number, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    text = F.when(F.col("p_size") % 5 == 0, F.concat(number, F.lit(" of "), size)).otherwise(
        F.concat(F.lit("#"), number, F.lit(" of "), size, F.lit(" parts"))
    )
    rank, total = rank_of_total(text)
    return part.select("p_partkey", rank.alias("rank"), total.alias("total"))


@query(
    "absolute_links",
    r"""
SELECT page_id, href,
  regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS link,
  regexp_replace(regexp_replace(url, '\?.*$', ''), '/+$', '') || '/' AS page
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href
  FROM pages)""",
)
def absolute_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)))
    return pages.select("page_id", "url", found.alias("href")).select(
        "page_id", "href", join_url("url", "href").alias("link"), page_key("url").alias("page")
    )


@query(
    "explode_multivalue",
    """
SELECT p_partkey, word FROM (
  SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS word FROM part)
WHERE word <> ''""",
)
def explode_multivalue(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    lists = part.withColumn("names", F.replace("p_name", F.lit(" "), F.lit("; ")))
    return explode_list(lists, "names", "word").select("p_partkey", "word")


@query(
    "json_scalar_or_array",
    """
SELECT event_id, unnest(CASE WHEN event_id % 3 = 0 THEN [k, event_type] ELSE [k] END) AS platform
FROM (SELECT event_id, event_type, regexp_extract(props, '[0-9]+') AS k FROM events)""",
)
def json_scalar_or_array(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    k = F.regexp_extract("props", "[0-9]+", 0)
    several = F.to_json(F.struct(F.array(k, F.col("event_type")).alias("gamePlatform")))
    single = F.to_json(F.struct(k.alias("gamePlatform")))
    doc = F.when(F.col("event_id") % 3 == 0, several).otherwise(single)
    return events.select("event_id", F.explode(json_texts(doc, "$.gamePlatform")).alias("platform"))


@query(
    "label_format",
    """
WITH counts AS (
  SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL
),
tops AS (
  SELECT user_id, event_type FROM counts
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1
),
ages AS (
  SELECT user_id, count(*) AS n, min(event_type) AS emotion, max(event_type) AS race
  FROM events GROUP BY user_id
)
SELECT user_id, event_type || ', ' || CAST(CAST(round_even(n / 2.0, 0) AS BIGINT) AS VARCHAR)
  || ' yrs' || chr(10) || emotion || ', ' || race AS label
FROM tops JOIN ages USING (user_id)""",
)
def label_format(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    counts = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    # One entry per event type, so a user's map stays small however many events there are.
    people = counts.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("scores"),
        (F.sum("n") / 2.0).alias("age"),
        F.min("event_type").alias("emotion"),
        F.max("event_type").alias("race"),
    )
    return people.select(
        "user_id",
        prediction_label(dominant_key("scores"), "age", "emotion", "race").alias("label"),
    )


@query(
    "first_failing_rule",
    r"""
SELECT doc_id, CASE
  WHEN length(text) < 8 THEN 'Password must be at least 8 characters.'
  WHEN NOT regexp_matches(text, '[A-Z]')
    THEN 'Password must include at least one uppercase letter.'
  WHEN NOT regexp_matches(text, '[a-z]')
    THEN 'Password must include at least one lowercase letter.'
  WHEN NOT regexp_matches(text, '[0-9]') THEN 'Password must include at least one number.'
  WHEN NOT regexp_matches(text, '[!@#$%^&*(),.?":{}|<>]')
    THEN 'Password must include at least one special character.' END AS reason
FROM documents""",
)
def first_failing_rule(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", strength_failure("text").alias("reason"))


@query("derive_dimension", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS username FROM orders")
def derive_dimension(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_custkey").cast("string")
    profile = F.concat(F.lit(f"{BASE_URL}/user/"), key, F.lit("/"), key, F.lit("/"))
    return derive_users(orders.select(profile.alias("url")), "url")


@query(
    "conform_columns",
    """
SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS moby_id, '' AS overview,
  c_mktsegment AS "Related Sites"
FROM customer""",
)
def conform_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_custkey").alias("moby_id"),
        "c_acctbal",
        F.col("c_mktsegment").alias("Related Sites"),
    )
    return conform(customer, ["moby_id", "name", "overview", "Related Sites"])


@query(
    "unpivot_ids",
    """
SELECT DISTINCT kind, id FROM (
  SELECT 'l_orderkey' AS kind, CAST(l_orderkey AS VARCHAR) AS id FROM lineitem
  UNION ALL SELECT 'l_partkey', CAST(l_partkey AS VARCHAR) FROM lineitem
  UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR) FROM lineitem)""",
)
def unpivot(spark, sf_dir):
    return unpivot_ids(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"]
    )


@query(
    "summary_regex",
    r"""
SELECT doc_id, regexp_extract(s, 'Average score[:\s]*([0-9.]+%?)', 1) AS average,
  regexp_extract(s, 'based on\s+([0-9]+)\s+ratings?', 1) AS ratings
FROM (SELECT doc_id, text || CASE WHEN doc_id % 4 = 0 THEN '' ELSE
  ' Average score: ' || CAST(n_chars % 100 AS VARCHAR) || '% based on ' || CAST(n_chars AS VARCHAR)
  || ' ratings' END AS s FROM documents)""",
)
def summary_regex(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    chars = F.col("n_chars")
    sentence = F.concat(
        F.lit(" Average score: "), (chars % 100).cast("string"), F.lit("% based on "),
        chars.cast("string"), F.lit(" ratings"),
    )
    text = F.concat("text", F.when(F.col("doc_id") % 4 == 0, F.lit("")).otherwise(sentence))
    average, ratings = summary_parts(text, CRITIC_AVERAGE, CRITIC_COUNT)
    return documents.select("doc_id", average.alias("average"), ratings.alias("ratings"))


UNESCAPED = (
    "replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), "
    "'&quot;', '\"'), '&#x27;', ''''), '&amp;', '&')"
)


@query(
    "page_title_h1",
    f"""
SELECT page_id, url, {UNESCAPED.format("trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's'))")}
  AS title,
  {UNESCAPED.format("trim(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'))")} AS h1
FROM pages""",
)
def page_title_h1(spark, sf_dir):
    return page_headings(elements(table(spark, sf_dir, "pages"), Reading(("title", "h1"))))


VISIBLE = "regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(<script|<style)[^>]*>.*?</(script|style)>', '\\1>', 'gs')"


@query(
    "element_tag_counts",
    f"""
SELECT page_id, tag, count(*) AS n FROM (
  SELECT page_id, unnest(regexp_extract_all({VISIBLE}, '<([a-z][a-z0-9]*)[ />]', 1)) AS tag
  FROM pages)
GROUP BY page_id, tag""",
)
def element_tag_counts(spark, sf_dir):
    found = elements(table(spark, sf_dir, "pages"), Reading(content=False))
    return found.groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "page_links",
    f"""
SELECT title, '{BASE_URL}' || href AS url, page_id FROM (
  SELECT page_id, {UNESCAPED.format("m[1]")} AS href, {UNESCAPED.format("m[2]")} AS title, i
  FROM (SELECT page_id, generate_subscripts(a, 1) AS i, unnest(a) AS l FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS a FROM pages)),
  LATERAL (SELECT [regexp_extract(l, '"([^"]*)"', 1), trim(regexp_extract(l, '>([^<]*)<', 1))] AS m)
)
WHERE title <> '' AND regexp_matches(href, '^/[a-z]+')
QUALIFY row_number() OVER (PARTITION BY href ORDER BY page_id, i) = 1""",
)
def links(spark, sf_dir):
    found = elements(table(spark, sf_dir, "pages"), Reading(("a",)))
    return page_links(found, BASE_URL, "^/[a-z]+").select("title", "url", "page_id")
