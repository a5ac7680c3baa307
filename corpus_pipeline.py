"""From raw documents to token ids: five stages, each an operator of ``lakecraft.llm``.

``run`` writes the result of every stage as Parquet in the shared folder and reads it again as the next
stage's documents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecraft.llm.decontaminate import drop_contaminated
from lakecraft.llm.mixing import in_mixed_order
from lakecraft.llm.ngram_join import ngram_jaccard_join
from lakecraft.llm.queries import tokenizer_path
from lakecraft.llm.shared import documents, materialise, text_of
from lakecraft.llm.tokenstore import token_digests, write_token_shards
from lakecraft.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; the model is fitted on labelled rows of ``docs``.

    Null and empty texts stay, as do rows without doc_id if their text is clean; repeated rows share their fate. Long
    texts are read whole. Without labels of both kinds nothing goes. Columns of any name pass through; so in all stages.
    """
    return drop_toxic(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest doc_id stays, with all rows that have that id; rows without doc_id stay."""
    classes = ngram_jaccard_join(docs)
    gone = classes.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept").select("doc_id")
    return docs.join(materialise(gone, "near-duplicates"), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go.

    Null and empty texts overlap nothing, an empty benchmark removes nothing, rows without doc_id go by their text,
    repeated rows share their fate. Texts are scanned whole.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: files by their part's number, then rows, are that order.

    A null source is a source of its own, no row is dropped; equal rows are interchangeable. An empty table stays empty.
    """
    return in_mixed_order(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in the order in which ``docs`` stand in their files (by doc_id, if they are in none).

    Files are in the order of their part's number, as names of more than five digits don't sort. A null text has the
    end id only, a null doc_id stays null, repeated rows each get a row. An empty table gives no rows.
    """
    rows = text_of(docs, "doc_id", "text")
    order = ["doc_id"]
    try:
        place = docs.metadataColumn("_metadata")  # that of the files, even beside a column of this name
        part = F.regexp_extract(place["file_name"], r"part-(\d+)", 1).try_cast("long")
        rows = text_of(docs.withColumns({"part": part, "file": place["file_name"], "nth": place["row_index"]}), "doc_id", "text", "part", "file", "nth")
        order = ["part", "file", "nth"]
    except AnalysisException:  # not read from files
        pass
    return token_digests(write_token_shards(rows, tokenizer_path(), order=order))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("token_ids", token_ids)]
# The stages' models, signatures and archives are beyond SQL; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}", arrow_rows=2000)
    return docs
