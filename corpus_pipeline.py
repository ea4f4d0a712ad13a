"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read by the next."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm import bpe, jaccard, mixing, substrings, toxicity
from starmart.llm.common import written
from starmart.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go.

    A null text is scored as an empty one; rows without id are scored, too. Without labels nothing goes.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by similarity the one with the smallest id stays.

    Rows with one id are one document, of which the first by text stays; rows without id stay.
    """
    found = jaccard.join(docs)
    stay = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy(*[F.asc_nulls_first(c) for c in docs.columns if c != "doc_id"])
    one = docs.join(stay, "doc_id", "left_semi").withColumn("_row", F.row_number().over(first)).filter("_row = 1")
    return one.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def drop_repeated_words(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that 13-word windows of smaller documents cover go.

    A null text becomes empty; a text without such words stays as it is, white space included; null
    ids are behind all others.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    left = substrings.dedupe(docs, carry=others).withColumnRenamed("kept", "text")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the null source is a source, equal rows are taken independently."""
    return mixing.emit(mixing.mix(docs), docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids and decoded texts of what is left, as counts and digests."""
    return bpe.encode_decode(docs, vocabulary(), digests=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("jaccard", one_of_similar),
    ("substrings", drop_repeated_words),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

# Nearest examples and BPE merges are beyond SQL; a test compares all rows of run() with plain Python, which
# takes the toxicity scores and the copies of the mix from their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
