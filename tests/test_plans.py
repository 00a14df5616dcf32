"""Physical plans: what must and must not be in them."""

import re

import pytest

import __spark_entry__ as driver
from bindings.registry import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = driver.queries()
STREAMS = {"stream_distinct", "throttle_stream", "stream_reviews", "carry_forward_stream"}
PAGES = {"page_title_h1", "element_tag_counts", "page_links"}
TOP_K = [
    "top_rated_critics",
    "top_rated_players",
    "top_by_two_facets",
    "top_devs_by_genre",
    "consensus_profile",
    "keep_first_per_key",
    "sample_per_group",
    "merge_keep_first",
    "first_match_roles",
    "page_links",
]

pytestmark = pytest.mark.usefixtures("no_broadcast")


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(all_queries()) - STREAMS))
def test_no_cross_joins_and_no_row_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert ("MapInArrow" in text) == (name in PAGES)


@pytest.mark.parametrize("name", TOP_K)
def test_groups_are_cut_before_the_exchange(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, name))


@pytest.mark.parametrize(
    "name", ["top_by_distinct_volume", "pair_collaborations"]
)
def test_global_top_k_needs_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "year_range_filter")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate.*LessThan\(o_orderdate", text)
    assert "PushedFilters: [IsNotNull(p_type), EqualTo(p_type,ECONOMY)" in plan(spark, "facet_filter_type")
    for name, wide in [
        ("top_by_distinct_volume", "l_quantity"),
        ("platform_stats", "l_orderkey"),
        ("pair_collaborations", "l_partkey"),
        ("user_history", "l_extendedprice"),
        ("link_closure", "l_shipdate"),
        ("unpivot_ids", "l_shipdate"),
    ]:
        assert not re.search(rf"ReadSchema: \S*{wide}", plan(spark, name))


def test_row_level_exchanges(spark):
    """Blocks are exchanged once; the summaries' exchanges are of other rows."""
    text = plan(spark, "asof_carry_forward")
    assert text.count("SortMergeJoin") + text.count("ShuffledHashJoin") == 1
    row_exchanges = re.findall(r"Exchange hashpartitioning\(_key#\d+, \d+\)", text)
    assert 2 <= len(row_exchanges) <= 3
