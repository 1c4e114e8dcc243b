"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's documents; all but the last return the columns of ``documents``.

Defined cases: null texts count as empty; rows with null ids are documents like others; an empty
table stays empty; further columns are carried along up to the packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm import decontaminate, harmonic_pack, mph_dedup, nbsvm, ngram_join
from clickmart.llm.common import find_package, materialise, row_key, without_rows

#: Near duplicates: words of a shingle, similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return nbsvm.keep_accepted(docs, nbsvm.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return mph_dedup.keep_winners(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: the smallest id."""
    keyed = docs.select(row_key().alias("key"), "doc_id", "text")
    found = ngram_join.linked_components(keyed.select("key", "text"), NEAR_WORDS, NEAR_PERCENT, id_col="key")
    found = found.select(F.col("doc_id").alias("key"), "component_id")
    ids = keyed.select("key", "doc_id").distinct()
    members = materialise(found.join(ids, "key"), "members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))["key"].alias("first")
    many = members.groupBy("component_id").agg(F.count(F.lit(1)).alias("n"), first).filter("n > 1")
    dropped = members.join(many, "component_id").filter(F.col("key") != F.col("first"))
    return without_rows(docs, dropped)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    keyed = docs.select(row_key().alias("key"), "text")
    found = decontaminate.leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key")
    return without_rows(docs, found.select(F.col("doc_id").alias("key")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their sequences."""
    return harmonic_pack.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("clean", clean),
    ("packed", packed),
]

#: Classifier, perfect hash and tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
