"""A corpus from raw documents to token ids, in stages that are each written and read again.

Documents that the classifier rejects go; of each group of near copies the one with the smallest id
stays; personal data is replaced by its kind; sources are mixed to target weights; what
is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import bpe, mixing, ngrams, pii, quality
from tallyworks.llm.shared import discard, documents, ship_package, written

SHINGLE = 5      # words
SIMILAR = 80     # per cent


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that the classifier accepts. Empty texts are judged too."""
    judged = quality.scored(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rejected = judged.where("predicted = 0").select("doc_id")
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of similar documents, of the smallest id. Texts without words are similar to none and stay.

    Rows are compared under numbers written beside them: ids may be null, which counts as largest, or repeated.
    """
    rows = written(docs.select(F.monotonically_increasing_id().alias("number"), F.struct(*docs.columns).alias("row")), "numbered")
    groups = ngrams.similar_groups(rows.select(F.col("number").alias("doc_id"), "row.text"), SHINGLE, SIMILAR)
    named = groups.select(F.col("doc_id").alias("number"), "component_id").join(rows.select("number", "row.doc_id"), "number")
    first = named.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "number"))["number"].alias("first"), F.count(F.lit(1)).alias("c")
    ).where("c > 1")
    extra = named.join(first, "component_id").where("number != first").select("number")
    return rows.join(extra, "number", "left_anti").select("row.*")


def replace_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All rows, with personal data replaced in their texts."""
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The rows of the mixture; a document that is used in several epochs stands there as often."""
    return mixing.choose(docs, mixing.words("text"))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every row as token ids: ``(doc_id, lang, source, tokens)``."""
    return bpe.encode_documents(docs, *bpe.default_vocabulary(), keep=("lang", "source"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", replace_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

# The classifier and the transducer have no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs = documents(spark, folder)
    for number, (_, stage) in enumerate(STAGES):
        given, docs = docs, stage(spark, docs, folder)
        if number < len(STAGES) - 1:
            before, docs = given, written(docs, f"stage-{number}")
            discard(before)
    return docs
