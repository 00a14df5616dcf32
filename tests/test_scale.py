"""Work that grows with the input stays in the rows of its pages."""

import re

import pytest

from bindings import reports as bound
from shelfmark.operators import skew
from shelfmark.plans import extract, reports
from shelfmark.plans.tables import parsed

HOST = "https://catalogue.example"
EXTRACTORS = {
    "overview": [extract.overview, extract.release_dates],
    "specs": [extract.specs],
    "prices": [extract.prices],
    "reviews": [lambda e: extract.player_reviews(e, HOST)],
}


@pytest.mark.parametrize("store", [True, False])
@pytest.mark.parametrize("kind", EXTRACTORS)
def test_extraction_shuffles_no_element(spark, kind, store):
    pages = spark.createDataFrame([(1, f"{HOST}/game/1/g/", "<h1>x</h1>")], "page_id long, url string, html string")
    for extractor in EXTRACTORS[kind]:
        plan = extractor(parsed(pages, store)[kind])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan


def test_rows_of_nested_tables_stay_apart(spark):
    html = "<table>" + "<tr><td>S</td><td>p</td><td>f</td><td><table><tr><td>in</td></tr></table></td><td>n</td><td>d</td></tr>" * 2 + "</table>"
    pages = spark.createDataFrame([(1, f"{HOST}/game/1/g/stores/", html)], "page_id long, url string, html string")
    got = extract.prices(parsed(pages, False)["prices"]).collect()
    assert [(r["store"], r["platform"], r["updated_date"]) for r in got] == [("S", "p", "d")] * 2


@pytest.mark.parametrize("name", ["pair_collaborations", "top_devs_by_genre"])
def test_parts_to_aggregate_grow_in_number_with_the_input(spark, monkeypatch, name):
    """A task aggregates its part of the input, whatever number of partitions the session names."""
    parts = []
    for size in (1 << 16, 1 << 14):
        monkeypatch.setattr(skew, "PART_BYTES", size)
        df = getattr(bound, name)(spark, "/root/testdata/sf0.001")
        text = df._jdf.queryExecution().executedPlan().toString()
        parts.append([int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\), REPARTITION_BY_NUM", text)])
        lowest = max(text.splitlines(), key=lambda line: "REPARTITION_BY_NUM" in line and line.index("Exchange"))
        assert "HashAggregate" not in text.split(lowest)[1]
    assert len(parts[0]) == len(parts[1]) == 2
    assert all(few > 4 and 3.4 < many / few <= 4 for few, many in zip(*parts))


def test_games_of_a_pair_count_once(spark):
    rows = [("a ", "b", k % 300) for k in range(900)] + [("a", " b", 5), ("a", "b", None), ("c", "d", 1), ("c", "d", 1)]
    credits = spark.createDataFrame(rows, "director string, developer string, game int")
    got = reports.pair_collaborations(credits, "director", "developer", "game")
    assert [tuple(r) for r in got.collect()] == [("a", "b", 300)]
