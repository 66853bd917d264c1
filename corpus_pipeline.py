"""A corpus pipeline over ``documents``: quality rules, line dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
``documents``. The last adds rate and copies: a document stands for ``copies`` documents of the mixture, and goes if that is 0;
and unreachable, the domains whose target the documents cannot fill, as quality rules may have left none of a domain.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.llm import decontamination, line_dedup, mixing, ngram_join, quality_rules
from txnwatch.llm.common import checkpoint_folder, documents, split_join, text_key


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the rules. Null or empty text fails; repeated rows are judged alike; an empty table stays so."""
    return quality_rules.filter_rules(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their host's boilerplate lines; none goes. A null text stays null, a null source is a host of
    its own, repeated rows are one page."""
    # drop_boilerplate adds n_lines and n_dropped; columns of these names are kept aside.
    inner = docs.select(*[F.col(f"`{c}`").alias(f"_{c}" if c in ("n_lines", "n_dropped") else c) for c in docs.columns])
    out = line_dedup.drop_boilerplate(inner)
    return out.select(*[F.col(f"`_{c}`").alias(c) if c in ("n_lines", "n_dropped") else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates. Null and empty texts are one group; of repeated rows one stays."""
    return ngram_join.one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark passage. Null or empty texts and items meet nothing."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's documents with rate, copies and unreachable (see mixing.mixed). Repeated rows have one rate; documents with
    copies 0 go; an empty table gives none. A column of ``docs`` called like one of the three is replaced."""
    added = ("rate", "copies", "unreachable")
    rates = mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("copies > 0").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), *added)
    rates = rates.dropDuplicates(["_key", "_id"])  # repeated rows have one rate
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in added)).alias("_row"), text_key(F.col("text")).alias("_key"))
    return split_join(rows, rates, ["_key"]).where(F.col("_row.doc_id").eqNullSafe(F.col("_id"))).select("_row.*", *added)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

#: The mixture's rates come from an iterative fit, which SQL can't state; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result is written as Parquet below the shared checkpoint folder and read again."""
    docs = documents(spark, sf_dir)
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
