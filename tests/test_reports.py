from decimal import Decimal

import pytest

import __spark_entry__ as driver

from shelfmark.plans import reports
from shelfmark.plans.catalog import Catalog
from tests.conftest import tuples


@pytest.fixture(scope="module")
def tables(spark):
    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    pairs = "game_moby_id string, {} string"
    return Catalog(
        {
            "game": make(
                "moby_id string, name_ string, mobyscore string, releasedate string",
                ("1", "A", "8.5", "October 3, 2023"), ("2", "B", "8.5", "October 9, 2023"),
                ("3", "C", "85%", "2023"), ("4", "D", "9.", "2022"), ("5", "E", "7.0", ""), ("6", "F", None, None),
            ),
            "game_genre": make(pairs.format("genre_name"), ("1", "Puzzle"), ("2", "Puzzle"), ("3", "Puzzle"),
                               ("4", "Puzzle"), ("5", "Puzzle"), ("1", "Farm"), ("4", None)),
            "game_setting": make(pairs.format("setting_name"), ("1", "Moon"), ("4", "Sea"), ("1", "Mars")),
            "game_publishers": make(pairs.format("publisher_name"), ("1", "P"), ("2", "Q")),
            "game_developers": make(pairs.format("developer_name"), ("1", "X"), ("2", "X"), ("4", "Y"), ("3", "Z")),
            "player_reviews": make(
                "username_pk string, title string, body string, score string, platform string, date string, moby_id string",
                ("h/user/1/ann/", "t", "b", "4", "PC", "2023-01-02", "1"), ("ann", "t", "b", "3", "PC", "2023-01-03", "2"),
                ("h/user/1/ann", "t", "b", "bad", "PC", "2023-01-01", "9"), ("h/joann", "t", "b", "5", "PC", "2023-01-04", "2"),
                ("bo", "t", "b", "2.5", "PC", "2023-01-05", "3"), ("bo", "t", "b", "", "PC", "2023-01-06", "4"),
            ),
            "release_date_per_platform": make("moby_id string, release_platform string", ("1", "PC"), ("1", "PC"),
                                              ("2", "PC"), ("3", "PC"), ("4", "Mac"), ("77", "Mac")),
            "credits": make("moby_id string, director string, developer string", ("1", "Ann", "Ed"), ("2", " Ann ", "Ed"),
                            ("2", "Ann", "Ed"), ("3", "Bo", "N/A"), ("4", "Bo", "Fay"), ("5", "", "Fay"), ("6", "Bo", None),
                            ("7", "Bo", "Fay")),
        }
    )


def test_top_rated(tables):
    critics = reports.top_rated_by_critics(tables, 1)
    assert tuples(critics, "genre", "year_label", "moby_id", "score") == [
        ("Farm", "2023", "1", Decimal("8.50")), ("Puzzle", "2023", "1", Decimal("8.50")),
        ("Puzzle", "No Year", "4", Decimal("9.00")), ("Unknown", "No Year", "4", Decimal("9.00")),
    ]
    dated = reports.top_rated_by_critics(tables, 1, year_only=True)
    assert ("Puzzle", "2022", "4") in tuples(dated, "genre", "year_label", "moby_id")
    players = reports.top_rated_by_players(tables, 5)
    assert tuples(players, "genre", "year_label", "moby_id", "score") == [
        ("Farm", "2023", "1", Decimal("4.00")), ("Puzzle", "2023", "1", Decimal("4.00")),
        ("Puzzle", "2023", "2", Decimal("4.00")), ("Puzzle", "No Year", "3", Decimal("2.50")),
    ]


def test_genre_setting_and_developers(tables):
    best = reports.top_games_by_genre_setting(tables, 1)
    assert tuples(best, "genre_name", "setting_name", "moby_id") == [
        ("Farm", "Mars", "1"), ("Farm", "Moon", "1"), ("Puzzle", "Mars", "1"), ("Puzzle", "Moon", "1"),
        ("Puzzle", "Sea", "4"), ("Puzzle", "Unknown Setting", "2"), ("Unknown Genre", "Sea", "4"),
    ]
    makers = reports.top_developers_by_genre(tables, 1)
    assert tuples(makers, "genre", "developer", "avg_critic_score", "games_count") == [
        ("Farm", "X", Decimal("8.500"), 1), ("Puzzle", "Y", Decimal("9.000"), 1), ("Unknown", "Y", Decimal("9.000"), 1),
    ]


def test_consensus(tables):
    got = reports.consensus_profile(tables, best_games=2, list_size=1)
    assert tuples(got, "facet", "winner", "top_list") == [
        ("developer", "X", "X"), ("genre", "Puzzle", "Puzzle"), ("publisher", "P", "P"), ("setting", "Mars", "Mars"),
    ]


def test_people(tables):
    assert tuples(reports.top_by_volume(tables.credits, "director", "moby_id", 1)) == [("Bo", 4)]
    pairs = reports.pair_collaborations(tables.credits, "director", "developer", "moby_id")
    assert [tuple(r) for r in pairs.collect()] == [("Ann", "Ed", 2), ("Bo", "Fay", 2)]


def test_platforms(tables):
    got = [tuple(r) for r in reports.platform_stats(tables).collect()]
    assert [(g[0], g[1], float(g[2]), g[3] and float(g[3])) for g in got] == [
        ("PC", 3, 8.5, 3.5), ("Mac", 2, 9.0, None)
    ]


def test_filters_and_history(tables):
    assert tuples(reports.games_for_facet(tables, "genre", "Farm"), "moby_id") == [("1",)]
    assert tuples(reports.games_for_facet(tables, "platform", "PC"), "name_") == [("A",), ("B",), ("C",)]
    assert reports.games_for_facet(tables, "colour", "red").count() == 0
    assert reports.facet_options(tables, "colour").count() == 0
    assert [r[0] for r in reports.facet_options(tables, "platform").collect()] == ["Mac", "PC"]
    history = reports.user_history(tables, " ann ")
    assert [(r["date"], r["game_name"]) for r in history.collect()] == [
        ("2023-01-03", "B"), ("2023-01-02", "A"), ("2023-01-01", None)
    ]
    assert reports.user_history(tables).count() == 6


@pytest.mark.parametrize(
    "name, keys, falling",
    [
        ("platform_stats", ["games_count", "platform"], 1),
        ("facet_filter_type", ["name_", "moby_id"], 0),
        ("user_history", ["date", "username_pk", "moby_id"], 1),
        ("top_by_distinct_volume", None, 1),
    ],
)
def test_rows_come_in_order(spark, name, keys, falling):
    """The first `falling` keys fall, the others rise."""
    df = driver.queries()[name](spark, "/root/testdata/sf0.001")
    if keys is None:  # the count falls, names rise
        counts = [c for c, t in df.dtypes if t in ("bigint", "int")]
        rows = [r[counts[-1]] for r in df.collect()]
        assert rows == sorted(rows, reverse=True)
        return
    present = [k for k in keys if k in df.columns]
    rows = [tuple(r[k] for k in present) for r in df.collect()]
    again = sorted(rows, key=lambda r: r[min(falling, len(present)) :])
    if falling:
        again = sorted(again, key=lambda r: r[0], reverse=True)
    assert [r[: len(present)] for r in rows] == again
