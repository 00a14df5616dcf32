"""Quality rules as a ledger: every rule is evaluated once per document, policies read the bits.

The ledger holds measurements and one integer whose bit k is set where rule k failed. A policy is a
versioned list of rules; applying one is a bitwise AND with its mask. What a policy would do without
one of its rules needs no texts either: documents are counted per failure pattern, and patterns
are few. Everything runs in SQL expressions on the row itself; texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

#: Rules in the order of their bits: name and the condition that fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 12 * n_words",
}
BASE = ("few_words", "repeated_words")
#: Rules of each version of the policy; versions are never changed, only added.
POLICIES: dict[int, tuple[str, ...]] = {1: BASE, 2: tuple(RULES)}
NEWEST = max(POLICIES)

MEASURES = ("n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def mask_of(rules: tuple[str, ...]) -> int:
    """Bits of the given rules."""
    return sum(1 << k for k, name in enumerate(RULES) if name in rules)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns of docs with the measurements; those of the same name are replaced.

    Null text is empty. Windows of three words are compared by a 64-bit hash. The steps are columns
    of their own, since an expression inside a lambda is evaluated anew for every element.
    """
    kept = [c for c in docs.columns if c.lower() not in MEASURES]
    rows = docs.select(F.struct(*kept).alias("_doc"), F.coalesce(docs[text], F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", F.array_remove(F.split("_text", BLANK), ""))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        "_doc",
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    window = F.expr(
        "CASE WHEN n_words < 3 THEN array() ELSE sort_array(transform(sequence(0, cast(n_words AS int) - 3), "
        "i -> struct(xxhash64(_words[i], _words[i + 1], _words[i + 2]) AS h, i AS i))) END"
    )
    rows = rows.withColumn("_windows", window).drop("_words")
    again = F.expr(
        "sort_array(transform(filter(_windows, (x, k) -> "
        "x.h <=> get(_windows, k - 1).h OR x.h <=> get(_windows, k + 1).h), x -> x.i))"
    )
    rows = rows.withColumn("_again", again).drop("_windows")
    covered = F.expr(
        "aggregate(_again, struct(0L AS n, 0 AS upto), "
        "(a, i) -> struct(a.n + i + 3 - greatest(i, a.upto) AS n, i + 3 AS upto), a -> a.n)"
    )
    rows = rows.withColumn("n_repeat_words", covered)
    return rows.select(*[F.col("_doc").getField(c).alias(c) for c in kept], *MEASURES)


def rule_ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns of docs but for the text, the measurements, and `failed`: bit k for rule k.

    Null and empty texts have no words, fail `few_words` and no other rule. Equal rows have equal
    entries. Columns of docs that bear a result's name are replaced.
    """
    rows = measured(docs, text).drop(text, "failed")
    failed = F.lit(0).cast("long")
    for k, condition in enumerate(RULES.values()):
        failed = failed.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return rows.withColumn("failed", failed)


def fails(rules: tuple[str, ...]) -> Column:
    """Whether a ledger row fails any of the rules."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(rules))) != 0


def apply_policy(ledger: DataFrame, version: int = NEWEST) -> DataFrame:
    """The ledger with `base_failed` and `kept` under a version of the policy."""
    return ledger.withColumn("base_failed", fails(BASE)).withColumn("kept", ~fails(POLICIES[version]))


def ablations(ledger: DataFrame, version: int = NEWEST) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that would be kept without it.

    One row per rule, also over an empty ledger.
    """
    rules = POLICIES[version]
    patterns = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(mask_of(rules))).alias("bits")).agg(F.count("*").alias("c"))
    one = lambda name: F.lit(mask_of((name,))).cast("long")
    sums = [
        F.struct(
            F.lit(name).alias("rule"),
            F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(one(name)) != 0, F.col("c"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == one(name), F.col("c"))), F.lit(0)).alias("n_failed_alone"),
            F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(one(name))) == 0, F.col("c"))), F.lit(0)).alias(
                "n_kept_without"
            ),
        )
        for name in rules
    ]
    return patterns.agg(F.array(*sums).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
