"""Reports over the relational copy.

Facts are averaged or made distinct per game before they meet a bridge, so a
game with a third of all reviews is one row by the time of the join. Ranks tie
on the id. Means are exact decimals, as in the source system's DECIMAL columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import (
    ends_in_name,
    guarded_decimal,
    known,
    text_year,
    year_label,
)
from shelfmark.operators.skew import salt, spread
from shelfmark.operators.topk import top_k, top_per_group
from shelfmark.plans.catalog import Catalog

# Labels of missing groups; facet -> (table, id column, value column).
UNKNOWN, UNKNOWN_GENRE, UNKNOWN_SETTING = "Unknown", "Unknown Genre", "Unknown Setting"
# Parts that the games of a pair are counted in.
GAME_SALTS = 64
FACETS = {
    "genre": ("game_genre", "game_moby_id", "genre_name"),
    "platform": ("release_date_per_platform", "moby_id", "release_platform"),
    "publisher": ("game_publishers", "game_moby_id", "publisher_name"),
    "developer": ("game_developers", "game_moby_id", "developer_name"),
    "setting": ("game_setting", "game_moby_id", "setting_name"),
}


def facet_pairs(catalog: Catalog, facet: str) -> DataFrame:
    table, key, value = FACETS[facet]
    return getattr(catalog, table).select(F.col(key).alias("moby_id"), F.col(value).alias("value"))


def facet_options(catalog: Catalog, facet: str) -> DataFrame:
    """Sorted distinct values of a facet; none for an unknown facet."""
    if facet not in FACETS:
        return catalog.game.sparkSession.createDataFrame([], "value string")
    return facet_pairs(catalog, facet).select("value").distinct().orderBy("value")


def games_for_facet(catalog: Catalog, facet: str, value: str) -> DataFrame:
    """Games with one facet value, by name; none for an unknown facet."""
    games = catalog.game.select("moby_id", "name_")
    if facet not in FACETS:
        return games.where(F.lit(False)).withColumn("value", F.lit(None).cast("string"))
    pairs = facet_pairs(catalog, facet).where(F.col("value") == F.lit(value))
    if facet == "platform":
        pairs = pairs.distinct()
    return pairs.join(games, "moby_id").select("moby_id", "name_", "value").orderBy(
        "name_", "moby_id"
    )


def games_released(
    games: DataFrame, date: str, first_year: int, last_year: int, exclude: Sequence[Column], score: str
) -> DataFrame:
    """Games of a range of years without the excluded kinds, best score first.

    The range is a pair of bounds on the date column itself, so that it reaches
    the scan or prunes partitions.
    """
    kind = games.schema[date].dataType
    kept = (F.col(date) >= F.lit(f"{first_year}-01-01").cast(kind)) & (
        F.col(date) < F.lit(f"{last_year + 1}-01-01").cast(kind)
    )
    for flag in exclude:
        kept = kept & ~F.coalesce(flag, F.lit(False))
    return games.where(kept).orderBy(F.desc(score), *[c for c in games.columns if c != score])


def mean_player_score(catalog: Catalog, precision: int = 6, name: str = "score") -> DataFrame:
    """Mean guarded score of each reviewed game, one row per game."""
    score = guarded_decimal("score", precision, 2)
    return (
        catalog.player_reviews.select("moby_id", score.alias("_score"))
        .where(F.col("_score").isNotNull())
        .groupBy("moby_id")
        .agg(F.avg("_score").alias(name))
    )


def _dated_games(catalog: Catalog, year_only: bool) -> DataFrame:
    dated = catalog.game.where(F.col("releasedate").isNotNull() & (F.col("releasedate") != ""))
    return dated.withColumn("year", text_year("releasedate", year_only))


def top_rated_by_critics(
    catalog: Catalog, n: int = 10, year_only: bool = False, precision: int = 5
) -> DataFrame:
    """Best critic scores of each genre and year."""
    games = _dated_games(catalog, year_only).select(
        "moby_id", "name_", "year", guarded_decimal("mobyscore", precision, 2).alias("score")
    ).where(F.col("score").isNotNull())
    return _best_of_genre_year(catalog, games, n)


def top_rated_by_players(
    catalog: Catalog, n: int = 10, year_only: bool = False, precision: int = 5
) -> DataFrame:
    """Best mean player scores of each genre and year."""
    means = mean_player_score(catalog, precision).withColumn("score", F.round("score", 2))
    games = _dated_games(catalog, year_only).select("moby_id", "name_", "year")
    return _best_of_genre_year(catalog, games.join(means, "moby_id"), n)


def _best_of_genre_year(catalog: Catalog, games: DataFrame, n: int) -> DataFrame:
    genres = catalog.game_genre.select(
        F.col("game_moby_id").alias("moby_id"),
        F.coalesce("genre_name", F.lit(UNKNOWN)).alias("genre"),
    ).distinct()
    rows = genres.join(games, "moby_id")
    best = top_per_group(rows, ["genre", "year"], [F.desc("score"), "moby_id"], n)
    return best.select(
        "genre", "year", year_label("year").alias("year_label"), "moby_id", "name_", "score"
    )


def top_games_by_genre_setting(catalog: Catalog, n: int = 5, precision: int = 5) -> DataFrame:
    """Best critic scores per genre and setting, games without either included."""
    games = catalog.game.select(
        "moby_id", "name_", guarded_decimal("mobyscore", precision, 2).alias("score")
    ).where(F.col("score").isNotNull())
    genres = catalog.game_genre.withColumnRenamed("game_moby_id", "moby_id")
    settings = catalog.game_setting.withColumnRenamed("game_moby_id", "moby_id")
    rows = games.join(genres, "moby_id", "left").join(settings, "moby_id", "left").select(
        F.coalesce("genre_name", F.lit(UNKNOWN_GENRE)).alias("genre_name"),
        F.coalesce("setting_name", F.lit(UNKNOWN_SETTING)).alias("setting_name"),
        "moby_id",
        "name_",
        "score",
    )
    return top_per_group(rows, ["genre_name", "setting_name"], [F.desc("score"), "moby_id"], n)


def top_developers_by_genre(catalog: Catalog, n: int = 5) -> DataFrame:
    """Developers of each genre by mean critic score, with their count of games."""
    games = catalog.game.select(
        "moby_id", guarded_decimal("mobyscore", 6, 2).alias("score")
    ).where(F.col("score").isNotNull())
    genres = catalog.game_genre.select(F.col("game_moby_id").alias("moby_id"), "genre_name")
    makers = catalog.game_developers.select(F.col("game_moby_id").alias("moby_id"), "developer_name")
    rated = (
        makers.join(games, "moby_id")
        .join(genres, "moby_id")
        .select(
            F.coalesce("genre_name", F.lit(UNKNOWN)).alias("genre"),
            F.col("developer_name").alias("developer"),
            "moby_id",
            "score",
        )
    )
    means = (
        spread(rated, "genre", "developer", "moby_id")
        .groupBy("genre", "developer")
        .agg(
            F.round(F.avg("score"), 3).alias("avg_critic_score"),
            F.countDistinct("moby_id").alias("games_count"),
        )
    )
    return top_per_group(means, ["genre"], [F.desc("avg_critic_score"), "developer"], n)


def consensus_profile(
    catalog: Catalog,
    facets: Sequence[str] = ("developer", "publisher", "genre", "setting"),
    best_games: int = 50,
    list_size: int = 10,
) -> DataFrame:
    """What the best-rated games have in common: winner and top list per facet."""
    scores = mean_player_score(catalog, 6)
    best = top_k(scores, [F.desc("score"), "moby_id"], best_games).select("moby_id")
    pairs = None
    for facet in facets:
        one = facet_pairs(catalog, facet).select(F.lit(facet).alias("facet"), "moby_id", "value")
        pairs = one if pairs is None else pairs.unionByName(one)
    pairs = pairs.join(best, "moby_id", "left_semi")
    counts = pairs.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))
    leaders = top_per_group(counts, ["facet"], [F.desc("n"), "value"], list_size, rank="place")
    listed = leaders.groupBy("facet").agg(
        F.min(F.struct("place", "value")).getField("value").alias("winner"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("place", "value"))), lambda e: e["value"]
            ),
            "; ",
        ).alias("top_list"),
    )
    return listed.withColumn(
        "recommended_based_on", F.lit(f"Top {best_games} player-rated games aggregated")
    )


def top_by_volume(credits: DataFrame, person: str, game: str, n: int = 5) -> DataFrame:
    """People with the most distinct games."""
    counts = (
        credits.where(known(person, [""]))
        .groupBy(person)
        .agg(F.countDistinct(game).alias("games_count"))
    )
    return top_k(counts, [F.desc("games_count"), person], n)


def pair_collaborations(
    credits: DataFrame, first: str, second: str, game: str, n: int = 10, at_least: int = 2
) -> DataFrame:
    """Pairs with the most distinct games together, grouped on trimmed names."""
    named = credits.where(known(first) & known(second))
    named = named.select(F.trim(first).alias(first), F.trim(second).alias(second), game)
    # A pair's games are made distinct and counted per salt, so a pair with much of the data is spread.
    part = [first, second, "_salt"]
    games = spread(named.select("*", salt(named, [game], GAME_SALTS)), *part).distinct()
    games = games.groupBy(*part).agg(F.count(game).alias("_games"))
    counts = (
        spread(games.drop("_salt"), first, second)
        .groupBy(first, second)
        .agg(F.sum("_games").alias("games_count"))
        .where(F.col("games_count") >= at_least)
    )
    return top_k(counts, [F.desc("games_count"), first, second], n)


def platform_stats(catalog: Catalog) -> DataFrame:
    """Per platform: games, mean critic score and mean of the games' player means."""
    releases = catalog.release_date_per_platform.select("moby_id", "release_platform").distinct()
    games = catalog.game.select("moby_id", guarded_decimal("mobyscore", 6, 2).alias("critic"))
    players = mean_player_score(catalog, 6, "player")
    return (
        releases.join(games, "moby_id", "left")
        .join(players, "moby_id", "left")
        .groupBy(F.col("release_platform").alias("platform"))
        .agg(
            F.count("moby_id").alias("games_count"),
            F.avg("critic").alias("avg_critic_score"),
            F.avg("player").alias("avg_player_score_over_games"),
        )
        .orderBy(F.desc("games_count"), "platform")
    )


def user_history(catalog: Catalog, username: str | None = None) -> DataFrame:
    """Reviews with game names, newest first; of one user or of all."""
    reviews = catalog.player_reviews
    if username is not None:
        reviews = reviews.where(ends_in_name("username_pk", username.strip()))
    names = catalog.game.select("moby_id", F.col("name_").alias("game_name"))
    return (
        reviews.join(names, "moby_id", "left")
        .select("username_pk", "moby_id", "game_name", "platform", "score", "title", "body", "date")
        .orderBy(F.desc("date"), "username_pk", "moby_id")
    )
