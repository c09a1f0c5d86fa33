"""A training corpus in five stages: each keeps, drops or changes documents for the next one.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. ``run`` writes each stage's result as Parquet in the shared folder and reads
it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm import decontaminate, ngram_join, pieces, secrets, toxicity
from barloom.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the given labels, does not call toxic.

    If no feature can be learned from them (no labels, none that match a document outside the
    held-out fold, or a single class), the classifier tells no documents apart and all are kept.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    if not model.keys() - {""}:
        return docs.select(*COLUMNS)
    return toxicity.score(docs.select(*COLUMNS), model, out="_score").where("_score < 0.5").drop("_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of linked documents one text, that of the least id; rows without an id stay.

    Texts are told apart by id and text, so different texts with one id each count for
    themselves; of rows equal in both, the one least in its other columns stays.
    """
    classes = ngram_join.near_duplicates(docs, digests=True)
    # Not made distinct: grouped by digest, all copies of one text would go to one task.
    first = classes.where("doc_id = class_id AND digest = class_digest").select("doc_id", F.col("digest").alias("_digest"))
    rows = docs.select(*COLUMNS)
    # A null text has the digest of an empty one, but is not equal to it.
    same = Window.partitionBy("doc_id", "_digest", F.col("text").isNull()).orderBy("lang", "source", "n_chars")
    named = (
        rows.where("doc_id IS NOT NULL")
        .withColumn("_digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
        .join(first, ["doc_id", "_digest"], "left_semi")
        .withColumn("_nth", F.row_number().over(same))
        .where("_nth = 1")
    )
    return named.select(*COLUMNS).unionByName(rows.where("doc_id IS NULL"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    items = decontaminate.benchmark_items(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.without_leaks(docs.select(*COLUMNS), items)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking credentials masked; n_chars follows the new text."""
    masked = secrets.redact_live(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    import public_tokenizers

    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secret_scan", mask_secrets),
    ("sentencepiece", encode),
]

#: SQL cannot express the classifier, the edit matching and the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
