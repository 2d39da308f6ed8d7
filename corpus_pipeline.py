"""The corpus pipeline: five stages from documents to token ids.

Each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.

Defined results: documents may have further columns of any name (dots and names that the stages
use themselves included), and all columns but the last stage's are kept; null and empty texts
have no letter and go in the first stage; rows without an id are in no group of near copies and
stay, but equal rows (id and text, ids may be null) are one document, of which one stays; rows
that share an id and differ in their text are documents of their own; empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bpe, decontaminate, language, lines, nearcopies
from eventloom.llm.common import cleanup, delete, materialize, table


def numbered(docs: DataFrame) -> DataFrame:
    """The columns of `docs` as c_0, c_1 and so on: names that clash with nothing."""
    return docs.select(*(F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(docs.columns)))


def named(frame: DataFrame, docs: DataFrame, **replaced: Column) -> DataFrame:
    """The columns c_0, c_1 and so on under their names in `docs`."""
    return frame.select(*(replaced.get(c, F.col(f"c_{i}")).alias(c) for i, c in enumerate(docs.columns)))


def place(docs: DataFrame, name: str) -> str:
    return f"c_{docs.columns.index(name)}"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter, texts that two codewords are about as near to, and texts in no language."""
    found = language.identify(docs)
    return named(found.filter((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous") & ~F.col("unfit")), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines of recurring templates out of the texts; every document stays."""
    found = lines.dedup_lines(docs)
    n_chars = {"n_chars": F.coalesce(F.length("kept_text").cast("long"), F.lit(0).cast("long"))} if "n_chars" in docs.columns else {}
    return named(found, docs, text=F.col("kept_text"), **n_chars)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each component of near copies.

    Fingerprints compared bit-sliced give the groups, as in op4; the exact similarity (five-word shingles, 0.8) is checked in them.
    """
    rows, doc_id, text = numbered(docs), F.col(place(docs, "doc_id")), F.col(place(docs, "text"))
    found = nearcopies.near_copies(docs.select("doc_id", "text"))
    # Ids and hashes only: the texts are not shuffled. Rows that are there several times are taken apart.
    first = found.filter(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n"))
    first = materialize(first, "pipeline-firsts")
    same = doc_id.eqNullSafe(F.col("doc_id")) & (F.xxhash64(text) == F.col("row"))
    once = rows.join(first.filter("n = 1"), same, "left_semi")
    repeated = first.filter("n > 1")
    if repeated.isEmpty():
        return named(once, docs)
    # Equal rows are thinned out in each task before any of them is moved.
    several = rows.join(repeated, same, "left_semi").groupBy(doc_id.alias("of"), F.sha2(text, 256).alias("digest")).agg(F.first(F.struct(*rows.columns)).alias("row"))
    return named(once.unionByName(several.select("row.*")), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain an item of the benchmark. Rows without an id are told apart by their text."""
    rows, doc_id, text = numbered(docs), F.col(place(docs, "doc_id")), F.col(place(docs, "text"))
    keyed = docs.select(F.xxhash64(F.col("doc_id"), F.col("text")).alias("doc_id"), "text")
    found = decontaminate.contaminated(keyed, table(spark, sf_dir, "benchmark"))
    hit = materialize(found.select(F.col("doc_id").alias("hit")).distinct(), "pipeline-hits")
    return named(rows.join(hit, F.xxhash64(doc_id, text) == F.col("hit"), "left_anti"), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number and the digest of their decoding."""
    found = bpe.encode(docs.select("doc_id", "text"))
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("bpe", token_ids),
]

#: No SQL expresses language identification, near copies, banded alignment or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage has read and written on its way is deleted once its result stands."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with cleanup(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
            result = made.pop()
        if before:
            delete(spark, before)
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
