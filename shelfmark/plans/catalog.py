"""The relational copy of the catalogue that the reports read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.functions.text import explode_list

# Tables and columns of the relational copy.
RELATIONS = {
    "game": ["moby_id", "name_", "mobyscore", "releasedate"],
    "game_genre": ["game_moby_id", "genre_name"],
    "game_setting": ["game_moby_id", "setting_name"],
    "game_publishers": ["game_moby_id", "publisher_name"],
    "game_developers": ["game_moby_id", "developer_name"],
    "player_reviews": ["username_pk", "title", "body", "score", "platform", "date", "moby_id"],
    "release_date_per_platform": ["moby_id", "release_platform"],
    "credits": ["moby_id", "director", "developer"],
}


@dataclass
class Catalog:
    """Tables by name; a report touches only those it needs."""

    tables: Mapping[str, DataFrame]

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.tables[name]
        except KeyError:
            raise AttributeError(f"the catalogue has no table {name}") from None


def bridge(game: DataFrame, column: str, value: str) -> DataFrame:
    """(game_moby_id, value) pairs of a multi-valued game column."""
    pairs = explode_list(game.select("moby_id", column), column, value)
    return pairs.select(F.col("moby_id").alias("game_moby_id"), value).distinct()


def catalog_from_bronze(bronze: Mapping[str, DataFrame]) -> Catalog:
    """Relational copy of the text tables that the page jobs write."""
    tables: dict[str, DataFrame] = {}
    if "game" in bronze:
        game = bronze["game"]
        tables["game"] = game.select(
            "moby_id", F.col("name").alias("name_"), "mobyscore", "releasedate"
        )
        tables["game_genre"] = bridge(game, "genre", "genre_name")
        tables["game_setting"] = bridge(game, "Setting", "setting_name")
        tables["game_publishers"] = bridge(game, "publishers", "publisher_name")
        tables["game_developers"] = bridge(game, "developers", "developer_name")
    if "player_review" in bronze:
        tables["player_reviews"] = bronze["player_review"].withColumnRenamed(
            "username pk", "username_pk"
        )
    if "release_date_per_platform" in bronze:
        tables["release_date_per_platform"] = bronze["release_date_per_platform"].select(
            "moby_id", "release_platform"
        )
    if "credits" in bronze:
        tables["credits"] = bronze["credits"].select("moby_id", "director", "developer")
    return Catalog(tables)


def load_catalog(spark: SparkSession, source: Mapping[str, str]) -> Catalog:
    """Tables over JDBC (options incl. `url`) or from `path/<table>` Parquet folders.

    Connection options come from the caller's configuration. For JDBC, options
    prefixed with a table name apply to that table only, e.g.
    `game.partitionColumn`, so that large tables are read in parallel.
    """
    tables = {}
    for name in RELATIONS:
        if "url" in source:
            common = {k: v for k, v in source.items() if "." not in k}
            own = {k.split(".", 1)[1]: v for k, v in source.items() if k.startswith(f"{name}.")}
            reader = spark.read.format("jdbc").options(**common, **own)
            tables[name] = reader.option("dbtable", name).load().select(*RELATIONS[name])
        else:
            tables[name] = spark.read.parquet(f"{source['path']}/{name}").select(*RELATIONS[name])
    return Catalog(tables)
