"""Stored tables, lists and settings written, read back and compared with SQL; registrations; role patterns."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from bindings.common import table
from bindings.pages import LINES, ROLES
from shelfmark.operators.quality import registration_reasons, split_by_reason
from shelfmark.operators.shape import first_matches
from shelfmark.operators.synth import mixture, mixture_rules
from shelfmark.plans.extract import ROLE_PATTERNS
from shelfmark.schemas import COLUMNS
from shelfmark.session import fresh_dir
from shelfmark.sources.readers import read_json_settings, read_text_csv
from shelfmark.sources.sinks import merge_csv, write_empty_csv, write_url_list
from shelfmark.sources.store import merge_store, read_store

QUERIES = {}
SEED = 42
# Settings in the form a user writes them.
SETTINGS = {
    "prices": {
        "free": {"weight": 1, "value": 0},
        "usual": {"weight": 5, "set": [5, 10, 20]},
        "odd": {"weight": 2, "range": [-7, 90, 8]},
    }
}


def query(name, sql):
    def register(run):
        QUERIES[name] = (run, sql)
        return run

    return register


def people(spark, sf_dir, shift: int):
    """Suppliers as contributors, keys and texts with blanks, tabs and line breaks at their ends."""
    supplier = table(spark, sf_dir, "supplier")
    number = F.col("s_suppkey") - shift
    return supplier.select(
        F.concat(F.lit(" "), (F.floor(number / 2) * 2).cast("string")).alias("moby_id"),
        F.concat(F.lit("  "), "s_name", F.lit("\t")).alias("name"),
        F.concat(F.lit('"a",\n'), F.col("s_nationkey").cast("string")).alias("overview"),
        F.col("s_suppkey").alias("n"),
    )


@query(
    "merge_csv_twice",
    r"""
WITH rows AS (
  SELECT 0 AS b, ' ' || (s_suppkey // 2 * 2) AS moby_id, s_name, s_nationkey, s_suppkey FROM supplier
  UNION ALL
  SELECT 1, ' ' || CAST(floor((s_suppkey - 5) / 2) * 2 AS BIGINT), s_name, s_nationkey, s_suppkey FROM supplier
)
SELECT moby_id, '  ' || s_name || chr(9) AS name, '"a",' || chr(10) || s_nationkey AS overview, '' AS "Related Sites"
FROM rows QUALIFY row_number() OVER (PARTITION BY moby_id ORDER BY b, s_suppkey) = 1""",
)
def merge_csv_twice(spark, sf_dir):
    """An empty table, two different merges and one of the same rows again."""
    path = f"{fresh_dir(spark, 'contributors')}/contributors"
    write_empty_csv(spark, path, "contributors")
    for shift in (0, 5, 5):
        merge_csv(people(spark, sf_dir, shift), path, "contributors", ["n"])
    return read_text_csv(spark, path, COLUMNS["contributors"])


@query(
    "merge_store_twice",
    r"""
WITH rows AS (
  SELECT 0 AS b, ' ' || (s_suppkey // 2 * 2) AS moby_id, s_name, s_nationkey, s_suppkey FROM supplier
  UNION ALL
  SELECT 1, ' ' || CAST(floor((s_suppkey - 5) / 2) * 2 AS BIGINT), s_name, s_nationkey, s_suppkey FROM supplier
)
SELECT moby_id, '  ' || s_name || chr(9) AS name, '"a",' || chr(10) || s_nationkey AS overview, '' AS "Related Sites"
FROM rows QUALIFY row_number() OVER (PARTITION BY moby_id ORDER BY b, s_suppkey) = 1""",
)
def merge_store_twice(spark, sf_dir):
    """The same rows as above into a table by cuts: two different merges and one of the same rows again."""
    path = f"{fresh_dir(spark, 'contributors')}/contributors"
    for shift in (0, 5, 5):
        merge_store(people(spark, sf_dir, shift), path, "contributors", ["n"])
    return read_store(spark, path, "contributors")


@query(
    "url_list",
    """
SELECT '<' || lang || ' "' || doc_id || '" ' AS title, url FROM (
  SELECT *, 'https://' || source || '.example/' || (n_chars % 50) AS url FROM documents)
QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1""",
)
def url_list(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    rows = documents.select(
        F.concat(F.lit("<"), "lang", F.lit(' "'), F.col("doc_id").cast("string"), F.lit('" ')).alias("title"),
        F.concat(F.lit("https://"), "source", F.lit(".example/"), (F.col("n_chars") % 50).cast("string")).alias("url"),
        "doc_id",
    )
    path = fresh_dir(spark, "urls")
    write_url_list(rows, path, ["doc_id"])
    return read_text_csv(spark, path, ["title", "url"])


def _sql_int(stream: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}:{stream}:' || p_partkey), 1, 8) AS BIGINT)"


@query(
    "settings_mixture",
    f"""
SELECT p_partkey, CAST(CASE WHEN u < 0.125 THEN 0 WHEN u < 0.75 THEN [5, 10, 20][h % 3 + 1] ELSE -7 + h % 13 * 8 END AS BIGINT) AS price
FROM (SELECT p_partkey, {_sql_int("price")} / 4294967296.0 AS u, {_sql_int("price value")} AS h FROM part)""",
)
def settings_mixture(spark, sf_dir):
    path = fresh_dir(spark, "settings")
    spark.createDataFrame([(json.dumps(SETTINGS, indent=1),)], "value string").coalesce(1).write.text(path)
    rules = mixture_rules(read_json_settings(spark, path), "prices")
    order = {name: rules[name] for name in SETTINGS["prices"]}
    return table(spark, sf_dir, "part").select("p_partkey", mixture("p_partkey", SEED, "price", order).alias("price"))


REGISTERED = r"""
WITH asked AS (
  SELECT s_suppkey AS n, CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE 'name' || (s_suppkey % 40) END AS username,
    CASE s_suppkey % 6 WHEN 0 THEN 'Short1!' WHEN 1 THEN 'lower case 1!' WHEN 2 THEN 'UPPER CASE 1!'
      WHEN 3 THEN 'No number!' WHEN 4 THEN 'NoSpecial1' ELSE 'Good pass 1!' END AS password
  FROM supplier
), judged AS (
  SELECT *, CASE WHEN username = '' THEN 'missing field'
    WHEN n % 6 = 0 THEN 'Password must be at least 8 characters.'
    WHEN n % 6 = 1 THEN 'Password must include at least one uppercase letter.'
    WHEN n % 6 = 2 THEN 'Password must include at least one lowercase letter.'
    WHEN n % 6 = 3 THEN 'Password must include at least one number.'
    WHEN n % 6 = 4 THEN 'Password must include at least one special character.'
    WHEN n % 40 < 10 THEN 'name taken' END AS failed
  FROM asked
), final AS (
  SELECT *, coalesce(failed, CASE WHEN row_number() OVER (PARTITION BY username, failed IS NULL ORDER BY n) > 1
    THEN 'name taken' END) AS reason FROM judged
)
SELECT n, username, sha256(password) AS password_hash, coalesce(reason, 'accepted') AS verdict FROM final"""


@query("registrations", REGISTERED)
def registrations(spark, sf_dir):
    supplier, n = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    words = ["Short1!", "lower case 1!", "UPPER CASE 1!", "No number!", "NoSpecial1", "Good pass 1!"]
    name = F.concat(F.lit("\tname"), (n % 40).cast("string"), F.lit(" "))
    asked = supplier.select(
        n.alias("n"),
        F.when(n % 11 == 0, F.lit("")).otherwise(name).alias("username"),
        F.element_at(F.array(*[F.lit(w) for w in words]), (n % 6 + 1).cast("int")).alias("password"),
    )
    users = supplier.select(F.concat(F.lit("name"), (n % 10).cast("string")).alias("username"))
    accepted, rejected = split_by_reason(registration_reasons(asked, users, ["n"]))
    accepted = accepted.withColumn("verdict", F.lit("accepted"))
    return accepted.unionByName(rejected.withColumnRenamed("reason", "verdict"))


def _flag(k: int) -> str:
    return f"CASE (l_orderkey + l_linenumber) % {len(ROLES)} " + " ".join(f"WHEN {i} THEN {r[k]}" for i, r in enumerate(ROLES)) + " END = 1"


@query(
    "first_match_titles",
    f"""WITH {LINES}, flagged AS (SELECT *, {_flag(1)} AS a, {_flag(2)} AS b, {_flag(3)} AS c FROM lines),
ds AS (SELECT l_orderkey, min(l_linenumber) FILTER (a) AS d FROM flagged GROUP BY l_orderkey),
ps AS (SELECT l_orderkey, any_value(d) AS d, min(l_linenumber) FILTER (b AND l_linenumber IS DISTINCT FROM d) AS p
  FROM flagged JOIN ds USING (l_orderkey) GROUP BY l_orderkey),
vs AS (SELECT l_orderkey, any_value(d) AS d, any_value(p) AS p,
    min(l_linenumber) FILTER (c AND l_linenumber IS DISTINCT FROM d AND l_linenumber IS DISTINCT FROM p) AS v
  FROM flagged JOIN ps USING (l_orderkey) GROUP BY l_orderkey)
SELECT l_orderkey, d AS director_line, p AS producer_line, v AS developer_line FROM vs WHERE coalesce(d, p, v) IS NOT NULL""",
)
def first_match_titles(spark, sf_dir):
    """The role patterns of credits pages on titles of the lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    title = F.element_at(F.array(*[F.lit(t) for t, *_ in ROLES]), ((F.col("l_orderkey") + F.col("l_linenumber")) % len(ROLES) + 1).cast("int"))
    rules = {role: title.rlike(pattern) for role, pattern in ROLE_PATTERNS.items()}
    found = first_matches(lines, ["l_orderkey"], "l_linenumber", rules, [])
    return found.select("l_orderkey", *[F.col(f"{r}_l_linenumber").alias(f"{r}_line") for r in ROLE_PATTERNS])
