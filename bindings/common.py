"""Driver tables under the names and shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.operators.skew import spread
from shelfmark.plans.catalog import Catalog
from shelfmark.session import prepare

BASE_URL = "https://catalogue.example"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_name", "n_name"
    )


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """part as game, its type and brand as genre and setting, suppliers as developers."""
    part = table(spark, sf_dir, "part")
    lineitem = table(spark, sf_dir, "lineitem")
    game_id = F.col("p_partkey").alias("game_moby_id")
    sold = lineitem.select(F.col("l_partkey").alias("moby_id"), F.col("l_suppkey").alias("s_suppkey"))
    sold_by = (
        spread(sold, "moby_id", "s_suppkey")
        .distinct()
        .join(supplier_nations(spark, sf_dir), "s_suppkey")
    )
    nations = sold_by.select("moby_id", "n_name").distinct()
    return Catalog(
        {
            "game": part.select(
                F.col("p_partkey").alias("moby_id"),
                F.col("p_name").alias("name_"),
                F.col("p_retailprice").cast("string").alias("mobyscore"),
            ),
            "game_genre": part.select(game_id, F.col("p_type").alias("genre_name")),
            "game_setting": part.select(game_id, F.col("p_brand").alias("setting_name")),
            "game_developers": sold_by.select(
                F.col("moby_id").alias("game_moby_id"), F.col("s_name").alias("developer_name")
            ),
            "game_publishers": nations.select(
                F.col("moby_id").alias("game_moby_id"), F.col("n_name").alias("publisher_name")
            ),
            "release_date_per_platform": nations.withColumnRenamed("n_name", "release_platform"),
            "player_reviews": lineitem.select(
                F.col("l_partkey").alias("moby_id"),
                F.col("l_quantity").cast("string").alias("score"),
            ),
        }
    )


def editions(spark: SparkSession, sf_dir: str) -> Catalog:
    """A part's shipments of one year as a game released on the first of them."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    lineitem = table(spark, sf_dir, "lineitem")
    edition = (F.col("l_partkey") * 10000 + F.year("l_shipdate")).alias("moby_id")
    shipped = lineitem.select(edition, "l_partkey", "l_shipdate", "l_quantity")
    first = shipped.groupBy("moby_id", "l_partkey").agg(F.min("l_shipdate").alias("released"))
    named = first.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return Catalog(
        {
            "game": named.select(
                "moby_id",
                F.col("p_name").alias("name_"),
                F.date_format("released", "MMMM d, yyyy").alias("releasedate"),
                F.col("p_retailprice").cast("string").alias("mobyscore"),
            ),
            "game_genre": named.select(
                F.col("moby_id").alias("game_moby_id"), F.col("p_type").alias("genre_name")
            ),
            "player_reviews": shipped.select(
                "moby_id", F.col("l_quantity").cast("string").alias("score")
            ),
        }
    )


# DuckDB fragments for exact decimal means: sum of cents `s` over `n` rows, half up.
def mean6(s: str, n: str) -> str:
    """Mean in millionths."""
    return f"((2 * ({s}) * 10000 + ({n})) // (2 * ({n})))"


def to_places(millionths: str, places: int) -> str:
    """Millionths rounded half up to decimal places, as a double."""
    step = 10 ** (6 - places)
    return f"(((2 * ({millionths}) + {step}) // {2 * step}) / {float(10**places)})"
