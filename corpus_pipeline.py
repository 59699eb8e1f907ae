"""A training corpus from raw documents: five of the operators in a row, each over all that its predecessor kept.

Stages hand on the columns of documents; the last returns what its files hold.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orewright.llm.base import id_filter, prepared, stored, table
from orewright.llm.decontamination import contaminated
from orewright.llm.labelled import training_rows
from orewright.llm.mixing import mixed_documents
from orewright.llm.ngram_join import ngram_jaccard_join
from orewright.llm.quality import fit_quality, quality_score
from orewright.llm.token_files import read_token_files, write_token_files
from orewright.session import work_folder

TOKENIZER = "word_bpe_49k.json"


def one_row_an_id(docs: DataFrame) -> DataFrame:
    """Of rows that share an id the one with the longest text, of those the last by text; rows without an id stay as they are.

    Only ids that occur again are looked at: the texts of all others stay where they are.
    """
    again = stored(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again")
    last = Window.partitionBy("doc_id").orderBy(F.length("text").desc_nulls_last(), F.col("text").desc_nulls_last(), F.xxhash64(*docs.columns))
    rest = docs.join(again, "doc_id", "left_semi").withColumn("__place", F.row_number().over(last)).filter("__place = 1")
    return docs.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(rest.select(docs.columns))


def admitted(docs: DataFrame) -> DataFrame:
    """The documents that the pipeline takes: an id names one document, and a row without an id none.

    Its decisions, files and links all go by id, so a row without one could be neither checked nor found again.
    """
    return one_row_an_id(docs.filter("doc_id is not null"))


def refused(docs: DataFrame) -> DataFrame:
    """How many rows `admitted` leaves out, by reason: ``no id`` and ``id repeated``."""
    ids = docs.groupBy("doc_id").count()
    none = F.sum(F.when(F.col("doc_id").isNull(), F.col("count")).otherwise(0))
    more = F.sum(F.when(F.col("doc_id").isNotNull(), F.col("count") - 1).otherwise(0))
    counts = ids.agg(F.coalesce(none, F.lit(0)).alias("no id"), F.coalesce(more, F.lit(0)).alias("id repeated"))
    return counts.unpivot([], ["no id", "id repeated"], "reason", "rows")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Admitted documents that the quality classifier does not reject."""
    docs = admitted(docs)
    model = fit_quality(training_rows(docs, table(prepared(spark), sf_dir, "labels"), "quality"))
    return docs.filter(quality_score(model)(F.col("text").cast("string")) >= model.cut)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates. Rows without an id name no document and stay."""
    docs = one_row_an_id(docs)
    groups = ngram_jaccard_join(docs.filter("doc_id is not null"))
    gone = stored(groups.filter("doc_id <> component_id").select("doc_id"), "gone")
    # Rows that the filter clears go through as they are; only the others meet their ids.
    _, suspect = id_filter(gone, "doc_id")
    named = F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))
    marked = docs.withColumn("__suspect", F.coalesce(suspect(named) & F.col("doc_id").isNotNull(), F.lit(False)))
    rest = marked.filter("__suspect").join(gone, "doc_id", "left_anti")
    return marked.filter("not __suspect").select(docs.columns).unionByName(rest.select(docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = contaminated(docs, table(prepared(spark), sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(stored(found, "found"), "doc_id", "left_anti").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix of sources takes them, repeats as rows of their own."""
    prepared(spark)
    return mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files hold of each document: doc_id, start, n_tokens, ids_crc32."""
    path = work_folder(prepared(spark), "tokens")
    write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
    return read_token_files(spark, path)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("token files", token_stage),
]

# The classifier's weights, the mix's keys and the tokenizer are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs


QUERIES = {"pipeline": run}
SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
