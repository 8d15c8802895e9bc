"""A pipeline over the table ``documents``: language, near duplicates, repeats, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns a DataFrame; ``run``
writes every result to the shared folder and reads it back for the next stage. All but the last return the columns of
``documents``; the last one returns the packed pieces, whose order and places depend on the order in which rows were
written, so no SQL stands beside it.

Rows may hold nulls, empty or very long texts; repeated rows are judged one by one (near duplicates: as copies). A row
with a null doc_id is never removed as a duplicate. Extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, language_id, packing, substring_dedup
from tidemark.llm.workload import table, tokenizer_path
from tidemark.session import settled

#: A prediction with less posterior probability than this is no language.
LEAST_SCORE = 0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(docs: DataFrame, name: str) -> str:
    """The name, behind as many underscores as it takes to differ from the columns of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _renewed(docs: DataFrame, found: DataFrame, cut, ranges: str) -> DataFrame:
    """``docs`` with texts cut where ``found`` (one row for each id and text) has ranges of words; lengths follow."""
    own, cuts = _free(docs, "own_hash"), _free(docs, "cuts")
    keyed = docs.withColumn(own, F.xxhash64("text"))
    found = found.select("doc_id", "text_hash", ranges)
    same = keyed["doc_id"].eqNullSafe(found["doc_id"]) & (keyed[own] == found["text_hash"])
    joined = keyed.join(found, same, "left").select(*(keyed[c] for c in docs.columns), found[ranges].alias(cuts))
    cutting = joined.withColumn("text", F.when(F.col(cuts).isNull(), F.col("text")).otherwise(cut("text", cuts)))
    length = F.when(F.col(cuts).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return cutting.withColumn("n_chars", length).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language: those without letters, or without a clear winner, go."""
    model = language_id.train(docs, tokenizer_path("piece_bpe_32k.model"))
    name = _free(docs, "found_language")
    found = docs.withColumn(name, language_id.predictor(model)("text"))
    sure = (F.col(f"{name}.lang_pred") != language_id.UNDETERMINED) & (F.col(f"{name}.score") >= LEAST_SCORE)
    return found.where(sure).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: that of the smallest id."""
    groups = settled(jaccard_join.linked(docs).where("doc_id is not null").select("doc_id", "component_id"), "groups")
    dropped = groups.where("doc_id <> component_id").select("doc_id")
    # Rows of one id are one group; one row of them stays.
    repeated = settled(groups.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    single = docs.join(dropped.unionByName(repeated), "doc_id", "left_anti").select(*docs.columns)
    once = docs.join(repeated.join(dropped, "doc_id", "left_anti"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(once.select(*docs.columns))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 and more words that an earlier document has."""
    return _renewed(docs, substring_dedup.repeat_marks(docs), substring_dedup.cut, "marks")


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    hits = found.where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_hash"])
    return _renewed(docs, hits, decontaminate.cut, "spans")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed training sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("leaks", leaks),
    ("pack", pack),
]

#: Learned models and places in packed sequences are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
