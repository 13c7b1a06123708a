"""The corpus pipeline (part of the llm subpackage): from raw documents to packed training sequences.

STAGES are applied in order, each over all that its predecessor kept, with its result written as
Parquet and read again:

* quality: documents that the classifier rejects go; a null text is scored as an empty one.
* near_duplicates: of the documents linked by shingle similarity, the one with the smallest doc_id
  stays; rows that repeat a doc_id are documents of their own, of which one stays where they are linked
  or equal; rows without doc_id stay.
* substrings: passages that an earlier document holds are cut out; a document that loses every word goes.
* personal_data: entities are replaced by surrogates.
* packing: the documents as pieces with their places in sequences (the last stage's own columns); text_hash,
  Spark's xxhash64 of the text that the stage before left, finds a piece's text also where doc_id is null.

An empty table passes through with no rows; null and empty texts are documents like others; a column that a
stage adds replaces none of the table's own but for that stage's work. What a stage writes is deleted when the
application ends. SQL cannot express the stages (ORACLE_SQL is None): in ``tests/llm`` near duplicates and cut
passages are compared with brute force, surrogates and packing with plain versions of their operators, and
quality with held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.llm import jaccard, packing, pii, quality, substring
from quirework.llm._common import settled, spooled
from quirework.sources import scratch

ORACLE_SQL = None


def _retold(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with n_chars of the new text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, model).where("predicted = 1").select(*docs.columns)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    if docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        found = settled(jaccard.linked(docs).where("doc_id != component_id").select("doc_id").distinct())
        return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
    # ids do not tell the rows apart: each is decided by the component of its set
    known = jaccard.linked(docs, named_sets=True).where("doc_id IS NOT NULL AND n_shingles > 0").select("sid", "component", F.col("component_id").alias("_least")).distinct()
    rows = jaccard.with_sets(docs).join(spooled(known, "known"), "sid", "left").where("doc_id IS NULL OR sid = 0 OR doc_id = _least")
    # what is left of a component are the rows of its smallest doc_id; texts without words are compared as they stand
    order = Window.partitionBy("doc_id", "component", F.when(F.col("sid") == 0, F.col("text"))).orderBy("text")
    first = F.when(F.col("doc_id").isNotNull(), F.row_number().over(order)).otherwise(1)
    return rows.withColumn("_row", first).where("_row = 1").select(*docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = substring.deduplicated(docs).where("n_removed = 0 OR n_removed < n_words")
    return _retold(out, docs.columns)


def replace_entities(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _retold(pii.replaced(docs, pii.key_of(spark)), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), hashed=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_one),
    ("substrings", cut_passages),
    ("personal_data", replace_entities),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    base = scratch.folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
