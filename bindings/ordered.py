"""Ordered-row operators, merges, validation, matching and draws on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import table
from shelfmark.operators.frontier import link_closure
from shelfmark.operators.match import first_band_match
from shelfmark.operators.ordered import position_block, shifted, time_block
from shelfmark.operators.quality import ReviewReferences, review_reasons, split_by_reason
from shelfmark.operators.shape import fill_down_pivot, first_matches, tiered_fallback
from shelfmark.operators.synth import (
    ARITH_BOUNDARY,
    ARITH_SMALL,
    ARITH_SPECIAL,
    ARITH_WEIGHTS,
    CATEGORY_WEIGHTS,
    OFFSET_LIMITS,
    OFFSET_WEIGHTS,
    SYMBOLIC_BASES,
    SYMBOLIC_FRACTION,
    arithmetic_value,
    dependent_draw,
    memory_offset,
    pick_members,
    upper_value,
    weighted_category,
)
from shelfmark.operators.throttle import asof_carry, throttle
from shelfmark.operators.topk import keep_first, sample_per_group
from shelfmark.operators.trace import adjacent_dependencies, dependency_counts, run_kpis
from shelfmark.session import fresh_dir
from shelfmark.sources.readers import distinct_urls, parse_keyed_lines, read_text_csv
from shelfmark.sources.sinks import manifest, merge_keep_first, write_csv

QUERIES = {}
DAY = 86_400
# Stretch of event time within which one user's rows may share a task.
EVENT_BLOCK_SECONDS = 300


def query(name, sql=None):
    def register(run):
        QUERIES[name] = (run, sql)
        return run

    return register


def event_block():
    return time_block("ts", EVENT_BLOCK_SECONDS)


# ---------------------------------------------------------------- sources, merges


@query(
    "seed_list",
    """
SELECT url, min(page_id) AS page_id FROM (
  SELECT page_id, url FROM pages
  UNION ALL SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) FROM pages)
WHERE url IS NOT NULL GROUP BY url""",
)
def seed_list(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    found = F.explode(F.concat(F.array("url"), F.coalesce(links, F.array())))
    return distinct_urls(pages.select("page_id", found.alias("url")), "url", ["page_id"])


@query(
    "csv_all_string",
    """
SELECT CAST(doc_id AS VARCHAR) AS moby_id, lang AS name, text AS overview,
  CASE WHEN n_chars % 3 = 0 THEN '' ELSE source END AS "Related Sites"
FROM documents""",
)
def csv_all_string(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    rows = documents.select(
        F.col("doc_id").cast("string").alias("moby_id"),
        F.col("lang").alias("name"),
        F.col("text").alias("overview"),
        F.when(F.col("n_chars") % 3 != 0, F.col("source")).alias("Related Sites"),
    )
    path = fresh_dir(spark, "csv")
    write_csv(rows, path)
    return read_text_csv(spark, path, rows.columns)


@query(
    "merge_keep_first",
    """
SELECT CAST(o_custkey AS VARCHAR) AS moby_id, o_orderstatus AS platform,
  o_orderpriority AS "Business Model", '' AS min_os
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus
  ORDER BY o_orderdate >= TIMESTAMP '1998-01-01', o_orderkey) = 1""",
)
def merge(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("moby_id"),
        F.col("o_orderstatus").alias("platform"),
        F.col("o_orderpriority").alias("Business Model"),
        "o_orderkey",
        (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).alias("recent"),
    )
    columns, keys = ["moby_id", "platform", "Business Model", "min_os"], ["moby_id", "platform"]
    stored = merge_keep_first(None, orders.where("not recent"), columns, keys, ["o_orderkey"])
    return merge_keep_first(stored, orders.where("recent"), columns, keys, ["o_orderkey"])


KV_LINES = r"""
WITH raw AS (
  SELECT event_id + 1 AS line_no, trim(CASE event_id % 8
    WHEN 0 THEN '; note ' || event_id WHEN 1 THEN '   ' WHEN 2 THEN 'x' || user_id
    WHEN 3 THEN (70000 + user_id) || ': 1' WHEN 4 THEN user_id || '=' || (event_id * 7)
    WHEN 5 THEN user_id || ' : -' || (event_id * 4) WHEN 6 THEN '  ' || user_id || ': ' || event_id
    ELSE '// c' END) AS line FROM events
), kept AS (
  SELECT *, regexp_matches(line, '^([0-9]+)\s*[:=]\s*(-?[0-9]+)$') AS ok,
    regexp_extract(line, '^([0-9]+)\s*[:=]\s*(-?[0-9]+)$', 1) AS a,
    regexp_extract(line, '^([0-9]+)\s*[:=]\s*(-?[0-9]+)$', 2) AS v
  FROM raw WHERE line <> '' AND line NOT LIKE ';%' AND line NOT LIKE '//%'
), judged AS (
  SELECT *, CASE WHEN NOT ok THEN 'Invalid format. Expected "address: value" or "address=value"'
    WHEN TRY_CAST(a AS BIGINT) > 65535 THEN 'Address ' || a || ' out of range (0-65535)'
    WHEN TRY_CAST(v AS BIGINT) NOT BETWEEN -32768 AND 65535
      THEN 'Value ' || v || ' out of range (-32768 to 65535)' END AS reason
  FROM kept
)"""


def keyed_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    e, u = F.col("event_id"), F.col("user_id").cast("string")
    kind = e % 8
    line = (
        F.when(kind == 0, F.concat(F.lit("; note "), e.cast("string")))
        .when(kind == 1, F.lit("   "))
        .when(kind == 2, F.concat(F.lit("x"), u))
        .when(kind == 3, F.concat((F.col("user_id") + 70000).cast("string"), F.lit(": 1")))
        .when(kind == 4, F.concat(u, F.lit("="), (e * 7).cast("string")))
        .when(kind == 5, F.concat(u, F.lit(" : -"), (e * 4).cast("string")))
        .when(kind == 6, F.concat(F.lit("  "), u, F.lit(": "), e.cast("string")))
        .otherwise(F.lit("// c"))
    )
    return parse_keyed_lines(events.select((e + 1).alias("line_no"), line.alias("line")))


@query(
    "kv_lines_ok",
    KV_LINES
    + """
SELECT CAST(a AS BIGINT) AS address,
  arg_max((CAST(v AS BIGINT) + 65536) % 65536, line_no) AS value
FROM judged WHERE reason IS NULL GROUP BY 1""",
)
def kv_lines_ok(spark, sf_dir):
    return keyed_lines(spark, sf_dir).rows


@query(
    "kv_lines_rejects",
    KV_LINES + "SELECT line_no, line, reason FROM judged WHERE reason IS NOT NULL",
)
def kv_lines_rejects(spark, sf_dir):
    return keyed_lines(spark, sf_dir).rejects


# ---------------------------------------------------------------- ordered rows


@query(
    "keep_first_per_key",
    """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def keep_first_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    first = keep_first(events, ["user_id", "event_type"], ["ts", "event_id"])
    return first.select("user_id", "event_type", "event_id", "value")


@query(
    "sample_per_group",
    """
SELECT source, doc_id FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('7:' || doc_id), doc_id) <= 15""",
)
def sampled(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("source", "doc_id")
    return sample_per_group(documents, ["source"], ["doc_id"], 15, seed=7)


# Role patterns that occur in the driver's invented text.
TEXT_ROLES = {"director": "(?i)tion", "producer": "(?i)ment|ing", "developer": "(?i)ation|ent|en"}


@query(
    "first_match_roles",
    """
WITH flagged AS (
  SELECT conv_id, turn, role, regexp_matches(text, '(?i)tion') AS d,
    regexp_matches(text, '(?i)ment|ing') AS p, regexp_matches(text, '(?i)ation|ent|en') AS v
  FROM conversations
), ds AS (
  SELECT conv_id, min(turn) FILTER (WHERE d) AS dt FROM flagged GROUP BY conv_id
), ps AS (
  SELECT conv_id, any_value(dt) AS dt,
    min(turn) FILTER (WHERE p AND turn IS DISTINCT FROM dt) AS pt
  FROM flagged JOIN ds USING (conv_id) GROUP BY conv_id
), vs AS (
  SELECT conv_id, any_value(dt) AS dt, any_value(pt) AS pt,
    min(turn) FILTER (WHERE v AND turn IS DISTINCT FROM dt AND turn IS DISTINCT FROM pt) AS vt
  FROM flagged JOIN ps USING (conv_id) GROUP BY conv_id
)
SELECT conv_id, dt AS director_turn, a.role AS director_role, pt AS producer_turn,
  b.role AS producer_role, vt AS developer_turn, c.role AS developer_role
FROM vs LEFT JOIN conversations a ON a.conv_id = vs.conv_id AND a.turn = dt
LEFT JOIN conversations b ON b.conv_id = vs.conv_id AND b.turn = pt
LEFT JOIN conversations c ON c.conv_id = vs.conv_id AND c.turn = vt
WHERE COALESCE(dt, pt, vt) IS NOT NULL""".replace("conv_id, dt AS", "vs.conv_id, dt AS"),
)
def first_match_roles(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    rules = {r: F.col("text").rlike(p) for r, p in TEXT_ROLES.items()}
    return first_matches(turns, ["conv_id"], "turn", rules, ["role"])


@query(
    "fill_down_pivot",
    """
WITH placed AS (
  SELECT *, COALESCE(max(turn) FILTER (WHERE role = 'user')
    OVER (PARTITION BY conv_id ORDER BY turn), -1) AS section_pos
  FROM conversations
)
SELECT conv_id, section_pos, COALESCE(arg_max(text, turn) FILTER (WHERE role = 'user'), '')
    AS section,
  COALESCE(arg_max(text, turn) FILTER (WHERE role <> 'user' AND length(text) < 300), '')
    AS short_answer,
  COALESCE(arg_max(text, turn) FILTER (WHERE role <> 'user' AND length(text) >= 300), '')
    AS long_answer
FROM placed GROUP BY conv_id, section_pos
HAVING short_answer <> '' OR long_answer <> ''""",
)
def sections(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    label = F.when(F.length("text") < 300, F.lit(" Short: ")).otherwise(F.lit("LONG:"))
    return fill_down_pivot(
        turns,
        ["conv_id"],
        "turn",
        F.col("role") == "user",
        F.col("text"),
        label,
        F.col("text"),
        {"short": "short_answer", "long": "long_answer"},
        position_block("turn"),
    )


@query(
    "tiered_fallback",
    """
SELECT o_custkey, o_orderkey, tier FROM (
  SELECT *, min(tier) OVER (PARTITION BY o_custkey) AS best FROM (
    SELECT o_custkey, o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1
      WHEN '2-HIGH' THEN 2 ELSE 3 END AS tier FROM orders))
WHERE tier = best""",
)
def fallback(spark, sf_dir):
    priority = F.col("o_orderpriority")
    tier = F.when(priority == "1-URGENT", 1).when(priority == "2-HIGH", 2).otherwise(3)
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", tier.alias("tier"))
    return tiered_fallback(orders, ["o_custkey"], "tier", ["o_orderkey"])


INSTRUCTIONS = """
rows AS (
  SELECT user_id, ts, event_id, event_type AS type,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 8 AS rd,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 7 AS INTEGER) END AS rs1,
    CAST(event_id % 3 AS INTEGER) AS rs2
  FROM events
)"""


def instructions(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        "user_id",
        "ts",
        "event_id",
        F.col("event_type").alias("type"),
        (F.regexp_extract("props", "[0-9]+", 0).cast("int") % 8).alias("rd"),
        F.when(F.col("event_id") % 5 != 0, (F.col("event_id") % 7).cast("int")).alias("rs1"),
        (F.col("event_id") % 3).cast("int").alias("rs2"),
    )


@query(
    "adjacent_dependency",
    f"""
WITH {INSTRUCTIONS}, seen AS (
  SELECT *, lag(rd, 1) OVER w AS rd1, lag(rd, 2) OVER w AS rd2, lag(type, 1) OVER w AS type1
  FROM rows WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), near AS (
  SELECT *, CASE WHEN rd1 <> 0 AND rd1 = rs1 THEN 1 WHEN rd2 <> 0 AND rd2 = rs1 THEN 2 ELSE 0 END
    AS a,
    CASE WHEN rd1 <> 0 AND rd1 = rs2 THEN 1 WHEN rd2 <> 0 AND rd2 = rs2 THEN 2 ELSE 0 END AS b
  FROM seen
)
SELECT user_id, count(*) FILTER (WHERE a = 1 OR b = 1) AS raw_distance_1,
  count(*) FILTER (WHERE a = 2 OR b = 2) AS raw_distance_2,
  count(*) FILTER (WHERE rd1 = rd) AS waw,
  count(*) FILTER (WHERE type1 = 'purchase' AND (a = 1 OR b = 1)) AS load_use
FROM near GROUP BY user_id""",
)
def adjacent_dependency(spark, sf_dir):
    flagged = adjacent_dependencies(
        instructions(spark, sf_dir), ["user_id"], ["ts", "event_id"], event_block(), "purchase"
    )
    return dependency_counts(flagged, ["user_id"])


@query(
    "run_kpis",
    """
WITH trace AS (
  SELECT user_id, event_type, 1 + date_diff('hour', TIMESTAMP '2024-01-01', ts) AS cycle,
    event_type = 'signup' AS flushed, value < 10 AS mispredicted
  FROM events
), counted AS (
  SELECT user_id, count(*) AS issued,
    count(*) FILTER (WHERE event_type <> 'error' AND NOT flushed) AS committed,
    max(cycle) AS cycles, count(*) FILTER (WHERE event_type = 'click') AS branches,
    count(*) FILTER (WHERE event_type = 'click' AND mispredicted) AS mispredictions
  FROM trace GROUP BY user_id
)
SELECT *,
  CASE WHEN committed > 0 AND cycles > 0
    THEN ((2000 * committed + cycles) // (2 * cycles)) / 1000.0 ELSE 0.0 END AS ipc,
  CASE WHEN committed > 0 THEN ((2000 * cycles + committed) // (2 * committed)) / 1000.0 END AS cpi,
  CASE WHEN branches > 0
    THEN ((20000 * (branches - mispredictions) + branches) // (2 * branches)) / 100.0 END
    AS branch_accuracy,
  CASE WHEN branches > 0
    THEN ((20000 * mispredictions + branches) // (2 * branches)) / 100.0 ELSE 0.0 END
    AS misprediction_rate
FROM counted""",
)
def kpis(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    start = F.lit("2024-01-01").cast("timestamp")
    cycle = F.floor(
        (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(start)) / 3_600_000_000
    ) + 1
    trace = events.select(
        "user_id",
        F.when(F.col("event_type") == "click", "branch").otherwise(F.col("event_type")).alias("type"),
        cycle.alias("issued_cycle"),
        F.when(F.col("event_type") != "error", cycle).alias("commit_cycle"),
        (F.col("event_type") == "signup").alias("flushed"),
        (F.col("value") < 10).alias("mispredicted"),
    )
    return run_kpis(trace, ["user_id"])


# ---------------------------------------------------------------- matching, closure


@query(
    "band_match",
    """
SELECT p.o_orderkey, min(s.o_orderkey) AS match_orderkey
FROM orders p LEFT JOIN orders s ON s.o_custkey = p.o_custkey
  AND abs(s.o_totalprice - p.o_totalprice) < 5000
  AND abs(date_diff('day', s.o_orderdate, p.o_orderdate)) < 50
  AND s.o_orderkey < p.o_orderkey
GROUP BY p.o_orderkey""",
)
def band_match(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.datediff("o_orderdate", F.lit("1970-01-01")).alias("day"),
    )
    matched = first_band_match(
        orders,
        orders,
        ["o_custkey"],
        {"o_totalprice": 5000, "day": 50},
        ["o_orderkey"],
        [],
        ["o_orderkey"],
        earlier_than=["o_orderkey"],
    )
    return matched.select("o_orderkey", F.col("match.o_orderkey").alias("match_orderkey"))


def line_block():
    """Stretch of an order's lines: a line number and ten thousand parts."""
    return F.struct("l_linenumber", F.floor(F.col("l_partkey") / 10_000).alias("parts"))


@query(
    "link_closure",
    """
WITH RECURSIVE steps AS (
  SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst
  FROM lineitem
), edges AS (SELECT DISTINCT src, dst FROM steps WHERE dst IS NOT NULL AND src <> dst),
reach(node, hop) USING KEY (node) AS (
  SELECT CAST(0 AS BIGINT), 0
  UNION
  SELECT dst, min(hop) + 1 FROM reach JOIN edges ON src = node
  WHERE dst NOT IN (SELECT node FROM recurring.reach) GROUP BY dst
)
SELECT node, CAST(hop AS INTEGER) AS hop FROM reach""",
)
def closure(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    steps = shifted(
        lines,
        ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey"],
        line_block(),
        {"dst": (F.col("l_partkey"), -1)},
    )
    edges = steps.where(F.col("dst").isNotNull()).select(F.col("l_partkey").alias("src"), "dst")
    seeds = spark.createDataFrame([(0,)], "node long")
    return link_closure(edges, seeds)


# ---------------------------------------------------------------- validation

SUBMITTED = """
WITH submitted AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_tax = 0.08 THEN '' ELSE 'user' || l_suppkey END AS username,
    l_partkey AS moby_id, l_returnflag AS platform,
    CASE WHEN l_discount = 0.1 THEN 'five' ELSE CAST(l_quantity / 9 AS VARCHAR) END AS score
  FROM lineitem
), checked AS (
  SELECT s.*, TRY_CAST(score AS DOUBLE) AS number,
    s_acctbal > 0 AND l_suppkey % 7 <> 3 AS password_ok,
    p_size > 5 AS game_ok, p_size % 4 <> 0 OR platform = 'A' AS platform_ok
  FROM submitted s LEFT JOIN supplier ON username = 'user' || s_suppkey
  LEFT JOIN part ON p_partkey = moby_id
), judged AS (
  SELECT *, CASE WHEN username = '' THEN 'missing field'
    WHEN number IS NULL THEN 'score is not a number'
    WHEN NOT number BETWEEN 0 AND 5 THEN 'score out of range'
    WHEN NOT COALESCE(password_ok, false) THEN 'wrong user or password'
    WHEN NOT game_ok THEN 'unknown game'
    WHEN NOT platform_ok THEN 'platform not valid for game' END AS failed
  FROM checked
), final AS (
  SELECT *, COALESCE(failed, CASE WHEN row_number() OVER (
      PARTITION BY username, moby_id, platform, failed IS NULL
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) > 1
    THEN 'already reviewed' END) AS reason
  FROM judged
)"""
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


REVIEW_FIELDS = ["l_tax", "l_returnflag", "l_discount", "l_quantity"]


def submissions(lines):
    """Line items as submitted reviews, some of them faulty."""
    user = F.concat(F.lit("user"), F.col("l_suppkey").cast("string"))
    wrong = F.when(F.col("l_suppkey") % 7 == 3, F.lit("?")).otherwise(F.lit(""))
    return lines.select(
        *LINE_ID,
        F.when(F.col("l_tax") == 0.08, F.lit("")).otherwise(user).alias("username"),
        F.concat(F.lit("pass"), F.col("l_suppkey").cast("string"), wrong).alias("password"),
        F.col("l_partkey").cast("string").alias("moby_id"),
        F.col("l_returnflag").alias("platform"),
        F.when(F.col("l_discount") == 0.1, F.lit("five"))
        .otherwise((F.col("l_quantity") / 9).cast("string"))
        .alias("score"),
    )


def references(spark, sf_dir):
    """Suppliers with money as users, larger parts as games."""
    supplier = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part").where("p_size > 5")
    number = F.col("s_suppkey").cast("string")
    users = supplier.where("s_acctbal > 0").select(
        F.concat(F.lit("user"), number).alias("username"),
        F.sha2(F.concat(F.lit("pass"), number), 256).alias("password_hash"),
    )
    game = F.col("p_partkey").cast("string").alias("moby_id")
    flags = F.when(F.col("p_size") % 4 != 0, F.array(F.lit("A"), F.lit("N"), F.lit("R"))).otherwise(
        F.array(F.lit("A"))
    )
    platforms = part.select(game, F.explode(flags).alias("platform"))
    return ReviewReferences(users, part.select(game), platforms)


def judged_reviews(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ID, *REVIEW_FIELDS)
    submitted = submissions(lines)
    return split_by_reason(review_reasons(submitted, references(spark, sf_dir), LINE_ID))


@query(
    "validated_accepts",
    SUBMITTED + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, username, CAST(moby_id AS VARCHAR) AS moby_id,
  platform FROM final WHERE reason IS NULL""",
)
def validated_accepts(spark, sf_dir):
    return judged_reviews(spark, sf_dir)[0].drop("score")


@query(
    "validated_rejects",
    SUBMITTED + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, username, CAST(moby_id AS VARCHAR) AS moby_id,
  platform, reason FROM final WHERE reason IS NOT NULL""",
)
def validated_rejects(spark, sf_dir):
    return judged_reviews(spark, sf_dir)[1].drop("score")


# ---------------------------------------------------------------- throttle, carry

THROTTLED = """
WITH RECURSIVE emitted AS (
  SELECT user_id, min(ts) AS at_ts, 0 AS n FROM events GROUP BY user_id
  UNION ALL
  SELECT e.user_id, min(e.ts), any_value(n) + 1
  FROM emitted m JOIN events e ON e.user_id = m.user_id AND e.ts >= m.at_ts + INTERVAL 1 DAY
  GROUP BY e.user_id
)
SELECT e.user_id, e.event_id, e.event_type
FROM emitted m JOIN events e ON e.user_id = m.user_id AND e.ts = m.at_ts WHERE n > 0"""


@query("throttle_events", THROTTLED)
def throttle_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    emitted = throttle(events, ["user_id"], "ts", ["event_id"], DAY)
    return emitted.select("user_id", "event_id", "event_type")


@query(
    "asof_carry_forward",
    """
SELECT e.event_id, CASE WHEN abs(p.value - e.value) < 20
  THEN 'purchase ' || CAST(p.event_id AS VARCHAR) ELSE 'Processing...' END AS label
FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
  ON e.user_id = p.user_id AND e.ts >= p.ts""",
)
def asof_carry_forward(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    label = F.concat(F.lit("purchase "), F.col("event_id").cast("string"))
    return asof_carry(
        events,
        ["user_id"],
        ["ts", "event_id"],
        F.col("event_type") == "purchase",
        "value",
        20.0,
        event_block(),
        label,
    ).select("event_id", "label")


# ---------------------------------------------------------------- draws

SEED = 42


def sql_int(stream: str, row_id: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}:{stream}:' || {row_id}), 1, 8) AS BIGINT)"


def sql_uniform(stream: str, row_id: str) -> str:
    return f"({sql_int(stream, row_id)} / 4294967296.0)"


def sql_weighted(u: str, weights: dict[str, float]) -> str:
    total, running, parts = sum(weights.values()), 0.0, []
    for key, weight in weights.items():
        running += weight
        parts.append(f"WHEN {u} < CAST({running / total!r} AS DOUBLE) THEN '{key}'")
    return f"CASE {' '.join(parts[:-1])} ELSE '{list(weights)[-1]}' END"


def sql_set(h: str, values: list[int]) -> str:
    return f"([{', '.join(map(str, values))}])[CAST({h} % {len(values)} + 1 AS INTEGER)]"


def sql_range(h: str, low: int, high: int, step: int = 1) -> str:
    return f"({low} + ({h} % {(high - low) // step + 1}) * {step})"


@query(
    "weighted_categories",
    f"""
SELECT o_orderkey, {sql_weighted(sql_uniform("category", "o_orderkey"), CATEGORY_WEIGHTS)}
  AS category FROM orders""",
)
def weighted_categories(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", weighted_category("o_orderkey", SEED).alias("category"))


_A, _AV = sql_uniform("arith", "o_orderkey"), sql_int("arith value", "o_orderkey")
_O, _OV = sql_uniform("offset", "o_orderkey"), sql_int("offset value", "o_orderkey")
_U, _UV = sql_uniform("upper", "o_orderkey"), sql_int("upper value", "o_orderkey")


@query(
    "mixture_values",
    f"""
SELECT o_orderkey,
  CAST(CASE {sql_weighted(_A, ARITH_WEIGHTS)} WHEN 'small' THEN {sql_set(_AV, ARITH_SMALL)}
    WHEN 'boundary' THEN {sql_set(_AV, ARITH_BOUNDARY)} WHEN 'medium' THEN {sql_range(_AV, -32, 32)}
    WHEN 'special_pattern' THEN {sql_set(_AV, ARITH_SPECIAL)}
    ELSE {sql_range(_AV, -2048, 2047)} END AS BIGINT) AS immediate,
  CAST(CASE {sql_weighted(_O, OFFSET_WEIGHTS)} WHEN 'near_zero' THEN 0
    {' '.join(f"WHEN '{k}' THEN {sql_range(_OV, lo, hi - 1, 4)}" for k, (lo, hi) in OFFSET_LIMITS.items())}
    END AS BIGINT) AS memory_offset,
  CAST(CASE WHEN {_U} < {SYMBOLIC_FRACTION} THEN {sql_set(_UV, SYMBOLIC_BASES)} >> 12
    ELSE {sql_range(_UV, 0, 2**20 - 1)} END AS BIGINT) AS upper
FROM orders""",
)
def mixture_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        arithmetic_value("o_orderkey", SEED).alias("immediate"),
        memory_offset("o_orderkey", SEED).alias("memory_offset"),
        upper_value("o_orderkey", SEED).alias("upper"),
    )


@query(
    "pick_member",
    f"""
WITH members AS (
  SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS place,
    count(*) OVER (PARTITION BY p_type) AS size
  FROM part
), asked AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'NONE' WHEN o_orderpriority LIKE '2%'
    THEN 'ECONOMY' ELSE 'STANDARD' END AS p_type, {sql_int("member", "o_orderkey")} AS h
  FROM orders
)
SELECT o_orderkey, a.p_type, COALESCE(CAST(p_partkey AS VARCHAR), 'default') AS p_partkey
FROM asked a LEFT JOIN members m ON m.p_type = a.p_type AND m.place = a.h % m.size + 1""",
)
def pick_member(spark, sf_dir):
    priority = F.col("o_orderpriority")
    kind = F.when(priority.startswith("1"), "NONE").when(priority.startswith("2"), "ECONOMY")
    asked = table(spark, sf_dir, "orders").select(
        "o_orderkey", kind.otherwise("STANDARD").alias("p_type")
    )
    part = table(spark, sf_dir, "part").select("p_type", "p_partkey")
    return pick_members(
        asked,
        part,
        "p_type",
        "p_partkey",
        ["o_orderkey"],
        SEED,
        "default",
        position_block("p_partkey"),
    )


@query(
    "dependent_draw",
    f"""
WITH {INSTRUCTIONS}, seen AS (
  SELECT *, lag(rd) OVER w AS rd1, lag(type) OVER w AS type1
  FROM rows WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), drawn AS (
  SELECT *, COALESCE(rd1 <> 0 AND {sql_uniform("raw", "event_id")} < 0.4, false) AS raw,
    COALESCE(rd1 IS NOT NULL AND {sql_uniform("waw", "event_id")} < 0.15, false) AS waw,
    COALESCE(type1 = 'purchase' AND rs1 IS NOT NULL
      AND {sql_uniform("load use", "event_id")} < 0.3, false) AS load_use
  FROM seen
)
SELECT event_id, CASE WHEN waw THEN rd1 ELSE rd END AS rd,
  CASE WHEN load_use OR (raw AND rs1 IS NOT NULL) THEN rd1 ELSE rs1 END AS rs1,
  CASE WHEN raw AND rs1 IS NULL THEN rd1 ELSE rs2 END AS rs2
FROM drawn""",
)
def dependent(spark, sf_dir):
    drawn = dependent_draw(
        instructions(spark, sf_dir),
        ["user_id"],
        ["ts", "event_id"],
        event_block(),
        "event_id",
        SEED,
        "purchase",
    )
    return drawn.select("event_id", "rd", "rs1", "rs2")


@query(
    "run_manifest",
    """
SELECT 'catalogue rows' AS generator, '1.0' AS version, CAST(42 AS BIGINT) AS seed,
  sum(n) :: BIGINT AS length, string_agg(event_type || '=' || n, '; ' ORDER BY event_type) AS counters
FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)""",
)
def run_manifest(spark, sf_dir):
    counted = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    row = manifest(counted, "catalogue rows", "1.0", SEED, CATEGORY_WEIGHTS)
    listed = F.transform(
        F.array_sort(F.map_entries("counters")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return row.select(
        "generator", "version", "seed", "length", F.array_join(listed, "; ").alias("counters")
    )
