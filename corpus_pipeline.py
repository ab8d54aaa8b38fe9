"""The corpus pipeline: five of the training-data operators, one after the other.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and reads it again for the next stage. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raceline.llm import line_dedup, mixing, ngram_join, packing, quality
from raceline.llm.common import Scratch, read

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts are scored like any others. Repeated rows and ties
    are decided alike, as a score depends on the text only; an empty table
    gives no rows, further columns are left out."""
    scored = quality.quality_rows(docs, read(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts; a document of
    which only blank lines are left goes.

    Null, empty and blank texts stay as they are. Rows that agree in doc_id
    and text are one document and are cut alike; of equal texts under several
    ids the smallest id (null last) is whole. Texts of any length are cut as a
    whole; an empty table gives no rows."""
    cut = line_dedup.remove_repeats(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(line_dedup.WORD)
    cut = cut.where(~F.coalesce(emptied, F.lit(False)))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id
    stays; of several texts with that id, and of rows that agree in id and
    text, one. Documents without words, and groups without an id, stay."""
    found = ngram_join.similar_documents(docs)
    in_group = (F.col("n_shingles") > 0) & F.col("component_id").isNotNull()
    first = found.where(in_group & (F.col("doc_id") == F.col("component_id"))).groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    rest = found.where(~in_group).select("doc_id", "text_key")
    # The hash tells texts of one id apart; the id is compared by value.
    kept = first.unionByName(rest).select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    keyed = docs.select(*COLUMNS, ngram_join.text_key(F.col("text")).alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text_key"]).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them.

    Null and empty texts have no words and are not taken. A null source is a
    source of its own, the last in order. Rows that agree in doc_id, source
    and size are taken equally often; an empty table gives no rows."""
    return mixing.mixed_rows(mixing.mix(docs)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces, as ``op7`` returns them.

    Null and empty texts are a piece of the id 0 alone; a text of more than
    2048 tokens gives several pieces. Repeated rows are packed each; an empty
    table gives no rows."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Trained scores, drawn copies and tokens are not to be had in SQL; tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            scratch.drop(f"stage{i - 1}")
    return docs
