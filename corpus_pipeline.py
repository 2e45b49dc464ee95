"""Corpus pipeline: quality, near copies, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs.  All but the last return the
columns of documents, with n_chars counting the text as it now is.

Defined cases: null and empty texts pass every stage (an empty text is scored
like any other); of the rows of one group of near copies one stays, whether
their doc_ids are equal or not; unlike texts with equal doc_id stay; rows with a
null doc_id are never dropped as near copies; an empty table gives an empty
result; further columns of any name pass through, up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.llm import jaccard, packing, pii, quality, substring_dedup
from tradelens.llm.frames import packed_row, prepare, quoted, stored, text_key, unpacked_row, unused
from tradelens.llm.q_tokens import tokenizer_path

#: Near copies: sets of five-word shingles at least 0.8 alike (op5_jaccard_join has numbers of its own).
NEAR = jaccard.Rule(words=5, percent=80)
#: Learned scores, FM-index search and packing have no SQL form; see tests/llm.
ORACLE_SQL = None


#: A text with a word.
WORD = r"[^\x20\x09-\x0D]"


def _recounted(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, n_chars (if it has one) counted anew."""
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*map(quoted, docs.columns))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network accepts."""
    prepare(spark)
    p = quality.Params()
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), p)
    score = unused(docs.columns, "_score")
    return quality.score(docs, model, docs.columns, score).where(F.col(score) >= p.threshold).drop(score)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that the n-gram Jaccard join links under ``NEAR``.

    It has the group's least doc_id; of unlike texts with that doc_id the one of
    least hash, and of rows with that text the one whose other columns come
    first as JSON.  Rows without a doc_id or a word are linked with nothing.
    """
    prepare(spark)
    alone = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    linked = docs.where(~alone)
    stays = jaccard.groups(linked, NEAR).where("key = keeper").select(F.col("key").alias("own"), F.col("least").alias("id"))
    rows = linked.select(packed_row(docs.columns), F.col("doc_id").cast("long").alias("id"), text_key(F.col("text")).alias("key"))
    twice = stored(rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .join(stays.withColumnRenamed("own", "key"), ["id", "key"], "left_semi").select("id", "key"), "near-copies-twice")
    once = stays.join(twice.withColumnRenamed("key", "own"), ["id", "own"], "left_anti").withColumnRenamed("id", "least")
    # dealt out by doc_id alone: as an equality, the comparison of keys would become a second join key
    same_text = F.least("key", "own") == F.greatest("key", "own")
    single = rows.join(once, (F.col("id") == F.col("least")) & same_text, "left_semi").select("row")
    rest = F.to_json(F.struct(*(f"row.c{i}" for i, c in enumerate(docs.columns) if c != "text")))
    double = rows.join(twice, ["id", "key"], "left_semi").groupBy("id", "key").agg(F.min_by("row", rest).alias("row")).select("row")
    return single.union(double).select(*unpacked_row(docs.columns)).union(docs.where(alone))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated windows; a text without any stays as it is."""
    prepare(spark)
    cut = substring_dedup.remove_repeated_words(docs).where("n_removed > 0").select("key", "kept")
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(packed_row(others), text_key(F.col("text")).alias("key"), "text").join(cut, "key", "left")
    return _recounted(rows.select(*unpacked_row(others), F.coalesce("kept", "text").alias("text")), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span of personal data replaced by its kind."""
    prepare(spark)
    return _recounted(pii.redact(docs, [c for c in docs.columns if c != "text"]), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their ids, placed in sequences."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_passages),
    ("PII", personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
