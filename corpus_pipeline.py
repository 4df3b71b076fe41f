"""Training-corpus pipeline: five stages over ``documents``, each one of the operators in ``tallgrass.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``docs``, in order.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import bpe, decontam, jaccard, langid, substrings
from tallgrass.llm.common import forget, swept, text_key

#: A document whose best language scores less is rejected. Chosen from held-out texts and junk with letters (see the README).
LEAST_SCORE = 0.7
TOKENIZER = "word_bpe_49k.json"
#: U+FFFD stands for bytes that are no text; MARK keeps the U+FFFD of a text apart from it.
LOST, MARK = "\ufffd", "\x1a"


def aside(docs: DataFrame, *names: str) -> DataFrame:
    """``names`` of ``docs``, and its other columns under numbers, so that none has the name of an operator's column."""
    return docs.select(*names, *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in names))


def restored(out: DataFrame, docs: DataFrame, **made: Column) -> DataFrame:
    """The columns of ``docs`` from rows of ``aside``, some made anew."""
    return out.select(*(made[c].alias(c) if c in made else F.col(f"c{i}" if f"c{i}" in out.columns else c).alias(c) for i, c in enumerate(docs.columns)))


def rows_of(docs: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of ``docs`` with ``side`` (key: struct of doc_id and text hash); ``docs`` may have any other columns."""
    return docs.join(side, F.struct(docs.doc_id, text_key(docs.text).alias("text_hash")).eqNullSafe(side.key), how)


def key_of(found: DataFrame) -> DataFrame:
    """``found`` (doc_id, text_hash) as ``key``."""
    return found.select(F.struct("doc_id", "text_hash").alias("key"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language.

    Null, empty and letterless texts and doubtful ones go; equal rows go or stay alike. Without any labelled text nothing can be
    recognised and all go. An empty table stays empty; all columns, whatever their names, stay as they are.
    """
    out = langid.predict(aside(docs, "text"), langid.train(docs.select("text", "lang")))
    return restored(out.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the smallest id (null last), then the smallest text hash.

    Rows that agree in id and text are one document, of which one row stays, the least by its other columns. Texts without words, null
    ones among them, are in no group and all stay. An empty table stays empty; columns with any names stay as they are.
    """
    with swept(spark) as kept_table:
        found = kept_table(jaccard.near_duplicates(docs))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = found.filter("component is not null").groupBy("component").agg(F.min(order).alias("k")).select("k.doc_id", "k.text_hash")
    kept = rows_of(docs, key_of(first), "left_semi")
    others = aside(kept, "doc_id", "text")
    row = F.struct(*(c for c in others.columns if c not in ("doc_id", "text")), F.lit(0).alias("end"))
    kept = restored(others.groupBy("doc_id", "text").agg(F.min_by(row, F.to_json(row)).alias("row")).select("doc_id", "text", "row.*"), docs)
    alone = found.filter("component is null").select("doc_id", "text_hash").distinct()
    return kept.unionByName(rows_of(docs, key_of(alone), "left_semi"))


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut byte strings that repeat; characters cut in half go whole; documents with nothing left, null and empty texts among them, go.

    Equal rows repeat each other and so lose what they share. ``n_chars``, if there, is counted again. An empty table stays
    empty; all other columns, whatever their names, stay as they are.
    """
    out = substrings.remove_repeats(aside(docs, "doc_id", "text"))
    cut = F.col("kept").cast("string")
    # a byte left over from a cut character is not valid; a U+FFFD that the text itself has is kept aside meanwhile
    marked = F.replace(F.replace(cut, F.lit(MARK), F.lit(MARK + "1")), F.lit(LOST), F.lit(MARK + "2"))
    back = F.replace(F.replace(F.replace(F.make_valid_utf8(marked), F.lit(LOST), F.lit("")), F.lit(MARK + "2"), F.lit(LOST)), F.lit(MARK + "1"), F.lit(MARK))
    out = out.withColumn("text", F.when(F.is_valid_utf8(cut), cut).otherwise(back)).filter(F.length("text") > 0)
    made = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return restored(out, docs, **made)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark.

    Null and empty texts hold none; equal rows go or stay alike. An empty table or benchmark drops nothing; columns with any
    names stay as they are.
    """
    with swept(spark) as kept_table:
        hits = kept_table(decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("n_hit > 0"))
    return rows_of(docs, key_of(hits.select("doc_id", "text_hash").distinct()), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of every text, with digests of them and of what they decode to.

    Null texts are empty; equal rows give equal rows; an empty table gives none. Columns beyond those named here are left out.
    """
    out = bpe.encode_decode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(TOKENIZER))
    digests = [F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")]
    return out.select("doc_id", "lang", "source", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), "token_ids", *digests)


STAGES = [
    ("language_id", language),
    ("ngram_jaccard", near_duplicates),
    ("suffix_array_dedup", repeated_substrings),
    ("decontamination", benchmark_passages),
    ("bpe", tokens),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each stage's table is deleted once the next has read it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        with swept(spark) as kept_table:
            docs = kept_table(stage(spark, docs, sf_dir))
        if before is not None:
            forget(before)
        before = docs
    return docs
