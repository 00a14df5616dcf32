"""Validation with reject reasons, and dimensions derived from facts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.functions.text import as_column, empty_to_null, sha256_hex, strip, user_name
from shelfmark.operators.skew import mark_first, skew_join
from shelfmark.session import cut_lineage, staged

# The strength rules in order, as (pattern that must occur, message),
# after the rule on length.
MIN_LENGTH = 8
LENGTH_MESSAGE = "Password must be at least 8 characters."
STRENGTH_RULES = [
    (r"[A-Z]", "Password must include at least one uppercase letter."),
    (r"[a-z]", "Password must include at least one lowercase letter."),
    (r"[0-9]", "Password must include at least one number."),
    (r'[!@#$%^&*(),.?":{}|<>]', "Password must include at least one special character."),
]
MAX_NAME = 100
# A score as text: a decimal number; Java's number suffixes are no part of one.
SCORE_TEXT = r"(?i)^[+-]?([0-9]+[.]?[0-9]*(e[+-]?[0-9]+)?|[.][0-9]+(e[+-]?[0-9]+)?|nan|inf|infinity)$"


def first_failure(rules: Sequence[tuple[Column, str]]) -> Column:
    """Message of the first rule that does not hold; null when all hold."""
    chain = None
    for holds, message in rules:
        fails = ~F.coalesce(holds, F.lit(False))
        chain = F.when(fails, message) if chain is None else chain.when(fails, message)
    return chain


def strength_failure(c: Column | str) -> Column:
    c = as_column(c)
    patterns = [(c.rlike(p), message) for p, message in STRENGTH_RULES]
    return first_failure([(F.length(c) >= MIN_LENGTH, LENGTH_MESSAGE), *patterns])


def split_by_reason(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Accepted rows without the reason column, and rejected rows with it."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def orphans(df: DataFrame, reference: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the reference table."""
    return df.join(reference.select(*on).distinct(), list(on), "left_anti")


@dataclass
class ReviewReferences:
    """Tables that reviews are checked against.

    users(username, password_hash) and games(moby_id) have one row per key;
    platforms(moby_id, platform) and reviewed(username, moby_id, platform) may
    repeat.
    """

    users: DataFrame
    games: DataFrame
    platforms: DataFrame
    reviewed: DataFrame | None = None


REVIEW_KEY = ["username", "moby_id", "platform"]


def _present(df: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    return df.select(*on).distinct().withColumn(flag, F.lit(True))


def review_reasons(
    submitted: DataFrame, refs: ReviewReferences, order: Sequence[str]
) -> DataFrame:
    """Submitted reviews with the reason of their first failed check, or null.

    `submitted` has username, password, moby_id, platform, score and the `order`
    columns, which identify a row. Of several good reviews of one user, game and
    platform the first in order is accepted. The password is not kept.
    """
    required = F.lit(True)
    for c in ["username", "password", "moby_id", "platform"]:
        required = required & empty_to_null(c).isNotNull()
    kept = [c for c in submitted.columns if c != "password"]
    # Each in a step of its own, so that no text is matched twice.
    rows = submitted.select("*", required.alias("_complete"), strip(F.col("score").cast("string")).alias("_text"))
    rows = rows.withColumn("_score", F.when(F.col("_text").rlike(SCORE_TEXT), F.col("_text").try_cast("double")))
    own_rules = [
        (F.col("_complete"), "missing field"),
        (F.col("_score").isNotNull(), "score is not a number"),
        ((F.col("_score") >= 0) & (F.col("_score") <= 5), "score out of range"),
    ]
    rows = rows.withColumn("_reason", first_failure(own_rules))
    # What a join does not need stays behind; a digest travels as bytes, half as long as its text.
    digest = F.when(F.col("_reason").isNull(), F.unhex(sha256_hex("password")))
    rows = rows.select(*kept, "_reason", digest.alias("_digest"))
    for c in REVIEW_KEY:
        rows = rows.withColumn(c, strip(c))

    users = refs.users.select("username", F.col("password_hash").alias("_hash"))
    same = F.coalesce(F.col("_hash") == F.lower(F.hex("_digest")), F.lit(False))
    wrong = F.when(~same, F.lit("wrong user or password"))
    rows = skew_join(rows, users, ["username"]).select(*kept, F.coalesce("_reason", wrong).alias("_reason"))
    games = refs.games.select("moby_id", F.lit(True).alias("_game"))
    valid = skew_join(_present(refs.platforms, ["moby_id", "platform"], "_listed"), games, ["moby_id"])
    valid = valid.select("moby_id", "platform", F.coalesce("_game", F.lit(False)).alias("_valid"))
    rows = skew_join(rows, valid, ["moby_id", "platform"]).select(*kept, "_reason", "_valid")

    # Read several times below. Only good rows, and those without a valid platform, go on to further joins.
    rows = staged(rows, "reviews-judged")
    open_, known_game = F.col("_reason").isNull(), F.col("_valid").isNotNull()
    other = skew_join(rows.where(open_ & ~known_game).select(*kept), games, ["moby_id"])
    no_platform = F.when(F.col("_game"), F.lit("platform not valid for game")).otherwise(F.lit("unknown game"))
    judged = [
        rows.where(~open_).select(*kept, F.col("_reason").alias("reason")),
        rows.where(open_ & ~F.col("_valid")).select(*kept, F.lit("unknown game").alias("reason")),
        other.select(*kept, no_platform.alias("reason")),
    ]
    good, already = rows.where(open_ & F.col("_valid")).select(*kept), F.lit("already reviewed")
    if refs.reviewed is not None:
        met = skew_join(good, _present(refs.reviewed, REVIEW_KEY, "_old"), REVIEW_KEY)
        judged.append(met.where(F.col("_old")).select(*kept, already.alias("reason")))
        good = met.where(F.col("_old").isNull()).select(*kept)
    good = mark_first(good, REVIEW_KEY, order, F.lit(True), "_first")
    judged.append(good.select(*kept, F.when(~F.col("_first"), already).alias("reason")))
    return reduce(DataFrame.unionByName, judged)


def registration_reasons(
    submitted: DataFrame, users: DataFrame, order: Sequence[str]
) -> DataFrame:
    """Registrations with the reason of their first failed check, or null.

    Of several good registrations of one name the first in order is accepted.
    Accepted and rejected rows carry the password's digest, not the password.
    """
    rows = submitted.select(
        "*",
        (empty_to_null("username").isNotNull() & empty_to_null("password").isNotNull()).alias(
            "_complete"
        ),
        strength_failure("password").alias("_weak"),
        sha256_hex("password").alias("password_hash"),
    ).withColumn("username", strip("username"))
    rows = skew_join(rows, _present(users, ["username"], "_taken"), ["username"])
    own_rules = first_failure(
        [
            (F.col("_complete"), "missing field"),
            (F.length("username") <= MAX_NAME, "name too long"),
        ]
    )
    taken = F.when(F.col("_taken"), F.lit("name taken"))
    kept = [*[c for c in submitted.columns if c != "password"], "password_hash"]
    rows = cut_lineage(rows.select(*kept, F.coalesce(own_rules, F.col("_weak"), taken).alias("_reason")))
    rows = mark_first(rows, ["username"], order, F.col("_reason").isNull(), "_first")
    again = F.when(~F.col("_first"), F.lit("name taken"))
    return rows.select(*kept, F.coalesce("_reason", again).alias("reason"))


def derive_users(facts: DataFrame, url: str) -> DataFrame:
    """Distinct user names found in a fact table's profile URLs."""
    names = facts.select(user_name(url).alias("username"))
    return names.where(
        empty_to_null("username").isNotNull() & (F.length("username") <= MAX_NAME)
    ).distinct()
