from decimal import Decimal

from pyspark.sql import functions as F

from shelfmark.functions.lookup import PLATFORM_NAMES, lookup, review_platform, titled_lookup
from shelfmark.functions.text import (
    any_filled,
    ends_in_name,
    explode_list,
    first_id_of_kinds,
    guarded_decimal,
    join_url,
    json_texts,
    known,
    normal_label,
    page_key,
    rank_of_total,
    synthetic_key,
    text_year,
    url_id,
    user_name,
    wrap16,
    year_label,
)


def values(spark, inputs, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    made = make(F.col("v"))
    return [r["out"] for r in df.select("i", made.alias("out")).orderBy("i").collect()]


def test_numeric_guard(spark):
    got = values(spark, ["8.5", "8.", "85%", "8x5", "", None, "-3", "12345.6"], guarded_decimal)
    assert got == [Decimal("8.50"), Decimal("8.00"), None, None, None, None, None, None]


def test_url_ids(spark):
    assert values(spark, ["/game/12/x/", "/game/x/", "h/game/7"], url_id) == ["12", "", ""]
    hrefs = ["/user/3/a", "/person/2/b?u=/user/9", "/company/1", "/genre/4", None]
    assert values(spark, hrefs, first_id_of_kinds) == ["3", "2", "1", None, None]


def test_user_name(spark):
    urls = ["https://h/user/7/ann/", "https://h/p/bob?x=1", "cat", "", None, " https://h/user/8/eve "]
    assert values(spark, urls, user_name) == ["ann", "bob", "cat", None, None, "eve"]


def test_dates(spark):
    dates = ["October 3, 2023", "2023", "soon", None]
    assert values(spark, dates, text_year) == [2023, None, None, None]
    assert values(spark, dates, lambda c: text_year(c, year_only=True)) == [2023, 2023, None, None]
    labels = values(spark, dates, lambda c: year_label(text_year(c)))
    assert labels == ["2023", "No Year", "No Year", "No Year"]


def test_rank(spark):
    texts = ["#12 of 345", "12 of 345", "#12", "Rank #1 of 2 of 3"]
    assert values(spark, texts, lambda c: rank_of_total(c)[0]) == ["12", "", "", "1"]
    assert values(spark, texts, lambda c: rank_of_total(c)[1]) == ["345", "", "", "2 of 3"]


def test_labels_and_lists(spark):
    assert values(spark, [" Media Type: ", "Min RAM ::"], normal_label) == ["media type", "min ram"]
    df = spark.createDataFrame([(1, "a; b;c ;; "), (2, ""), (3, None)], "id int, v string")
    got = explode_list(df, "v", "part").select("id", "part").collect()
    assert [tuple(r) for r in got] == [(1, "a"), (1, "b"), (1, "c")]


def test_links(spark):
    base = F.lit("https://h.example/a/b?x=1#y")
    hrefs = ["/c", "d", "http://o/e", "//o/f", "#g", "?q"]
    assert values(spark, hrefs, lambda c: join_url(base, c)) == [
        "https://h.example/c",
        "https://h.example/a/d",
        "http://o/e",
        "https://o/f",
        "https://h.example/a/b?x=1#g",
        "https://h.example/a/b?q",
    ]
    assert values(spark, ["h/a?x", "h/a//"], page_key) == ["h/a/", "h/a/"]


def test_json_text_or_array(spark):
    docs = ['{"p": "x"}', '{"p": ["x", "y"]}', '{"q": 1}', "not json", None]
    got = values(spark, docs, lambda c: json_texts(c, "$.p"))
    assert got == [["x"], ["x", "y"], None, None, None]


def test_lookup(spark):
    got = values(spark, ["ios", "a-b", "playstation-5"], lambda c: titled_lookup(c, PLATFORM_NAMES))
    assert got == ["iOS", "A B", "PlayStation 5"]
    assert values(spark, ["x", None], lambda c: lookup(c, {"x": "y"}, F.lit("z"))) == ["y", "z"]
    urls = ["/game/1/reviews/xbox-one/", "/game/1/reviews/", "/game/1/"]
    title = F.lit("Some Reviews (Stadia, 2020)")
    assert values(spark, urls, lambda c: review_platform(c, title)) == ["Xbox One", "Stadia", "Stadia"]
    assert values(spark, ["/game/1/"], lambda c: review_platform(c, F.lit("none"))) == [""]


def test_small_ones(spark):
    assert values(spark, ["a"], lambda c: synthetic_key("g_", c)) == ["g_0cc175b9c0"]
    assert values(spark, [-1, 5, -32768], wrap16, "int") == [65535, 5, 32768]
    assert values(spark, ["", "N/A", None, "x"], known) == [False, False, False, True]
    assert values(spark, ["h/u/ann", "h/u/ann/", "ann", "h/joann", "h/u/a%n"],
                  lambda c: ends_in_name(c, "ann")) == [True, True, True, False, False]
    row = spark.sql("SELECT '' AS a, CAST(NULL AS STRING) AS b, 'x' AS c")
    assert row.select(any_filled(["a", "b"]), any_filled(["a", "b", "c"])).first() == (False, True)


def test_dot_parts_and_empty_links(spark):
    base = "https://h.example/a/b/c?x=1#y"
    links = ["../d", "./d", ".", "..", "/e/../f", "../../../../g", "", "d?q=/../z", "x/./y/", "/..", "g;x=1/../y"]
    from urllib.parse import urljoin

    assert values(spark, links, lambda c: join_url(F.lit(base), c)) == [urljoin(base, x) or base for x in links]
    assert values(spark, ["d", "", "?q", "/x"], lambda c: join_url(F.lit("https://h.example"), c)) == [
        "https://h.example/d", "https://h.example", "https://h.example?q", "https://h.example/x",
    ]


def test_white_space_of_any_kind_goes(spark):
    assert values(spark, ["ann\t", "\n ann \r", "\u00a0ann\u3000", "a n"], user_name) == ["ann", "ann", "ann", "a n"]
    assert values(spark, ["\tGenre:\n", "A :"], normal_label) == ["genre", "a"]
