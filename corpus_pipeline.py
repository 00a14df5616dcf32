"""The corpus pipeline: toxic documents go, repeated lines and near copies go, long repeats are cut
out, and what is left is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and its result is written as Parquet and read again as the next
one's docs. All but the last return the columns of `documents`; n_chars follows the text. Rows of
documents that lose all their text in a stage stay, with an empty text: only toxicity and near copies drop
documents. A null text stays null while nothing is taken from it. Other columns may have any names, those of an
operator's results too, and come back as they were; repeated rows, and rows that share an id, are documents
of their own. Texts are read whole, whatever their length, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm.blocks import ready, staged
from shelfmark.llm.jaccard_join import near_dedup
from shelfmark.llm.line_dedup import line_dedup
from shelfmark.llm.packing import pack
from shelfmark.llm.substring_dedup import substring_dedup
from shelfmark.llm.toxicity import fit, held_out, toxicity

TOXIC = 0.5


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with private names for all columns but doc_id and text, so that no result of an operator takes the place
    of a column that happens to have its name; and the private name of each."""
    names = {c: c if c in ("doc_id", "text") else f"_column_{k}" for k, c in enumerate(docs.columns)}
    return docs.select(*[docs[c].alias(n) for c, n in names.items()]), names


def _back(rows: DataFrame, names: dict[str, str], changed: str | None = None) -> DataFrame:
    """Columns of documents under their own names, the text replaced where the stage took something from it."""
    values = {c: F.col(n) for c, n in names.items()}
    if changed is not None:
        cut = F.col(changed) > 0
        values["text"] = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
        if "n_chars" in names:
            values["n_chars"] = F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col(names["n_chars"]))
    return rows.select(*[v.alias(c) for c, v in values.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC; learned from the labels of rows that are not held out."""
    labels = ready(spark).read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    apart, names = _apart(docs)
    scored = toxicity(apart, fit(apart, labels, ~held_out()))
    return _back(scored.where(F.col("score") < TOXIC), names)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds too are taken out."""
    ready(spark)
    apart, names = _apart(docs)
    return _back(line_dedup(apart), names, "n_dropped")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ready(spark)
    apart, names = _apart(docs)
    return _back(near_dedup(apart), names)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside long windows that start anywhere else too are taken out; the others are joined by blanks."""
    ready(spark)
    apart, names = _apart(docs)
    return _back(substring_dedup(apart), names, "n_removed")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    import public_tokenizers

    ready(spark)
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: Nearest examples and tokenizers can't be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read from there."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
