import hashlib

import pytest
from shelfmark.operators.quality import (
    ReviewReferences,
    derive_users,
    orphans,
    registration_reasons,
    review_reasons,
    split_by_reason,
    strength_failure,
)
from tests.conftest import tuples

pytestmark = pytest.mark.usefixtures("no_broadcast")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_strength(spark):
    words = ["abc", "abcdefgh", "ABCDEFGH", "Abcdefgh", "Abcdefg1", "Abcdef1!", "ÄÖÜäöü1!", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    got = [r["m"] for r in df.select("i", strength_failure("w").alias("m")).orderBy("i").collect()]
    assert got == [
        "Password must be at least 8 characters.",
        "Password must include at least one uppercase letter.",
        "Password must include at least one lowercase letter.",
        "Password must include at least one number.",
        "Password must include at least one special character.",
        None,
        "Password must include at least one uppercase letter.",
        "Password must be at least 8 characters.",
    ]


def test_review_reasons(spark):
    users = spark.createDataFrame([("ann", digest("pw")), ("bob", digest("pw2"))], "username string, password_hash string")
    games = spark.createDataFrame([("1",), ("2",)], "moby_id string")
    platforms = spark.createDataFrame([("1", "PC"), ("1", "PC"), ("2", "Mac")], "moby_id string, platform string")
    reviewed = spark.createDataFrame([("bob", "2", "Mac")], "username string, moby_id string, platform string")
    rows = [
        (0, " ann ", "pw", "1", "PC", "5"),
        (1, "ann", "pw", "1", "PC", "4"),
        (2, "", "pw", "1", "PC", "4"),
        (3, "ann", None, "1", "PC", "4"),
        (4, "ann", "pw", "1", "PC", "good"),
        (5, "ann", "pw", "1", "PC", "5.5"),
        (6, "ann", "pw", "1", "PC", "nan"),
        (7, "ann", "no", "1", "PC", "3"),
        (8, "cy", "pw", "1", "PC", "3"),
        (9, "ann", "pw", "9", "PC", "3"),
        (10, "ann", "pw", "1", "Mac", "3"),
        (11, "bob", "pw2", "2", "Mac", "0"),
        (12, "bob", "pw2", "1", "PC", "0"),
        (13, "ann", "pw", "1", "PC", None),
        (14, "bob\t", "pw2", "1\n", "\u00a0PC", " 3 "),
        (15, "ann", "pw", "1", "PC", "4f"),
        (16, "ann", "pw", "1", "PC", "4d"),
    ]
    df = spark.createDataFrame(rows, "n int, username string, password string, moby_id string, platform string, score string")
    judged = review_reasons(df, ReviewReferences(users, games, platforms, reviewed), ["n"])
    accepted, rejected = split_by_reason(judged)
    assert tuples(accepted, "n", "username") == [(0, "ann"), (12, "bob")]
    assert dict(tuples(rejected, "n", "reason")) == {
        1: "already reviewed",
        2: "missing field",
        3: "missing field",
        4: "score is not a number",
        5: "score out of range",
        6: "score out of range",
        7: "wrong user or password",
        8: "wrong user or password",
        9: "unknown game",
        10: "platform not valid for game",
        11: "already reviewed",
        13: "score is not a number",
        14: "already reviewed",
        15: "score is not a number",
        16: "score is not a number",
    }
    assert "password" not in judged.columns


def test_registrations(spark):
    users = spark.createDataFrame([("ann",)], "username string")
    good = "Abcdef1!"
    rows = [(0, "ann", good), (1, " bob ", good), (2, "bob", good), (3, "", good), (4, "x" * 101, good),
            (5, "cy", "weak"), (6, "cy", good)]
    df = spark.createDataFrame(rows, "n int, username string, password string")
    got = registration_reasons(df, users, ["n"])
    assert dict(tuples(got, "n", "reason")) == {
        0: "name taken", 1: None, 2: "name taken", 3: "missing field", 4: "name too long",
        5: "Password must be at least 8 characters.", 6: None,
    }
    assert got.where("n = 1").first()["password_hash"] == digest(good)


def test_orphans_and_users(spark):
    facts = spark.createDataFrame([("https://h/user/1/ann/",), ("https://h/user/2/bob",), ("https://h/user/1/ann",),
                                   ("x" * 101,), (None,)], "url string")
    assert tuples(derive_users(facts, "url")) == [("ann",), ("bob",)]
    left = spark.createDataFrame([(1,), (2,)], "id int")
    assert tuples(orphans(left, spark.createDataFrame([(1,), (1,)], "id int"), ["id"])) == [(2,)]


def test_review_joins_carry_only_what_they_need(spark, monkeypatch):
    """Digests and scores stay behind where no later join needs them, and a row is written once, compressed."""
    from shelfmark.operators import quality

    written, staged = [], quality.staged
    monkeypatch.setattr(quality, "staged", lambda df, purpose: written.append(df) or staged(df, purpose))
    schema = "n int, username string, password string, moby_id string, platform string, score string"
    df = spark.createDataFrame([(0, "ann", "pw", "1", "PC", "5"), (1, "ann", "pw", "2", "PC", "5"),
                                (2, "ann", "pw", "1", "Mac", "5"), (3, "ann", "pw", "3", "PC", "5")], schema)
    users = spark.createDataFrame([("ann", digest("pw"))], "username string, password_hash string")
    games = spark.createDataFrame([("1",), ("2",)], "moby_id string")
    platforms = spark.createDataFrame([("1", "PC"), ("2", "PC"), ("3", "PC")], "moby_id string, platform string")
    judged = review_reasons(df, ReviewReferences(users, games, platforms), ["n"])
    assert dict(tuples(judged, "n", "reason")) == {
        0: None, 1: None, 2: "platform not valid for game", 3: "unknown game"
    }
    (facts,) = written
    text = spark._jvm.PythonSQLUtils.explainString(facts._jdf.queryExecution(), "formatted")
    nodes = [part for part in text.split("\n\n") if "Exchange\n" in part.split("Input")[0] and "n#" in part]
    by_game = [part for part in nodes if "hashpartitioning" in part and "moby_id" in part.split("Arguments")[1]]
    assert by_game and not any(c in part for part in by_game for c in ("_hash", "_digest", "_score", "_text"))
    assert "ExistingRDD[n#" not in judged._jdf.queryExecution().executedPlan().toString()
