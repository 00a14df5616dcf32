"""The pipeline against plain versions of its stages."""

import os

import awkward as A
import public_tokenizers
import pytest
from test_tokens import check_pieces
from tokenizers import Tokenizer

import corpus_pipeline as C

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and comes out of it."""
    from shelfmark.llm.blocks import staged

    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in C.STAGES:
        after = staged(stage(spark, docs, SF_DIR), name)
        out.append((docs, after))
        docs = after
    return out


def test_columns_stay(stages):
    for before, after in stages[:-1]:
        assert after.schema == before.schema


def test_clean_documents_stay(spark, stages):
    docs, kept = by_id(stages[0][0]), by_id(stages[0][1])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    clean = [i for i, y in labels.items() if y == 0]
    assert all(docs[i] == kept[i] for i in kept)
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)


def test_lines_go(stages):
    docs, kept = by_id(stages[1][0]), by_id(stages[1][1])
    ids = list(docs)
    for i, (_, text) in zip(ids, A.plain_lines([(i, docs[i].text) for i in ids]), strict=True):
        assert kept[i].text == text and kept[i].n_chars == len(text) and kept[i].source == docs[i].source


def test_near_copies_go(stages):
    docs, kept = by_id(stages[2][0]), by_id(stages[2][1])
    ids = list(docs)
    groups = A.plain_groups([(i, docs[i].text) for i in ids])
    assert set(kept) == {c for _, c, _ in groups}
    assert all(kept[i] == docs[i] for i in kept)


def test_long_repeats_go(stages):
    docs, kept = by_id(stages[3][0]), by_id(stages[3][1])
    ids = list(docs)
    for i, (n, words) in zip(ids, A.plain_substring([docs[i].text for i in ids], 35), strict=True):
        assert kept[i].text == (docs[i].text if len(words) == n else " ".join(words))
        assert kept[i].n_chars == len(kept[i].text)


def test_all_is_packed(spark, stages):
    docs, pieces = stages[4]
    assert sum(r.length for r in pieces.collect()) == sum(r.doc_tokens for r in pieces.where("start = 0").collect())
    rows = pack_of(docs)
    pad, total = check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    assert pad < 0.01 * total


def pack_of(docs):
    from shelfmark.llm.packing import pack

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()


def test_run_gives_the_same(spark, stages):
    got = C.run(spark, SF_DIR).drop("sequence_id", "offset").collect()
    want = stages[4][1].drop("sequence_id", "offset").collect()
    assert sum(r.length for r in got) == sum(r.length for r in want)
    assert {r.doc_id for r in got} == {r.doc_id for r in want}


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, "", "en", "x", 0), (None, None, None, None, None), (1, None, None, None, None)]])
def test_blank_tables(spark, tmp_path, rows):
    folder = str(tmp_path)
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert C.run(spark, folder).count() == len(rows)


def test_clashing_columns_and_awkward_rows(spark, tmp_path):
    """Columns named as results come back as they were, through every stage; repeated rows and ids pass."""
    from pyspark.sql import functions as F

    names = ["score", "evidence", "n_lines", "n_dropped", "kept_text", "n_removed", "n_words", "component_id", "block", "held_out"]
    docs = A.frame(spark).select("doc_id", "text", "lang", "source", "n_chars", F.xxhash64("doc_id", "text").alias("tag"))
    docs = docs.select("*", *[F.concat(F.lit(n), F.col("tag").cast("string")).alias(n) for n in names])
    spark.createDataFrame([(1, 1, 0), (2, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    known = {r.tag for r in docs.collect()}
    for name, stage in C.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        rows = after.collect()
        assert rows and all(r[n] == f"{n}{r.tag}" for r in rows for n in names) and {r.tag for r in rows} <= known
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
        docs = spark.createDataFrame(rows, after.schema)
    assert C.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= docs.count()
