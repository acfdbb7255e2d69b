"""Corpus pipeline: the stages that turn ``documents`` into a training mix.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame that is
written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import table, written
from domus.llm.op1_mixing import mix
from domus.llm.op3_secrets import without_secrets
from domus.llm.op4_toxicity import without_toxic
from domus.llm.op5_minhash import without_duplicates
from domus.llm.op9_decontamination import without_leaks


#: Bytes of an Arrow batch between Spark and its Python workers: two workers of an executor hold a few of them each.
BATCH_BYTES = 8 << 20


def bounded(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, with its rows handed to Python in batches of bounded size (a session setting, as the stage's frame is
    computed after it returns)."""
    @wraps(stage)
    def run_bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run_bounded


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, a number of its own for each row: place of its file among those of one write, and place in
    the file. Two reads of the table give a row the same number, whatever executors come and go. Rows that
    aren't a table of one write are written first."""
    for attempt in (docs, None):
        if attempt is None:
            attempt = written(docs, "pipeline-rows")
        place = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d{1,9})-", 1).try_cast("long")
        try:
            files = attempt.select(F.col("_metadata.file_path").alias("path"), place.alias("place")).distinct().agg(
                F.count("*").alias("n"), F.count("place").alias("known"), F.count_distinct("place").alias("places")).first()
        except AnalysisException:  # no files behind it
            continue
        if files["n"] == files["known"] == files["places"]:
            break
    return attempt.select("*", (F.shiftleft(place, 33) + F.col("_metadata.row_index")).alias("_row"))


@bounded
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the classifier is fitted on the labelled ones."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


@bounded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return without_duplicates(docs)


@bounded
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


@bounded
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return without_secrets(docs)


@bounded
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``mix_copies`` and their source's ``mix_target`` in words.

    Copies are decided for each row by itself, also where rows share a doc_id or have none, and attached by one
    join at every size of the input."""
    rows = numbered(docs.drop("mix_copies", "mix_target", "_row"))
    taken = mix(rows.select(F.col("_row").alias("doc_id"), "text", "source")).filter("copies > 0").select(
        F.col("doc_id").alias("_row"), F.col("copies").alias("mix_copies"), F.col("target").alias("mix_target"))
    return rows.join(taken.hint("merge"), "_row").drop("_row")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, writing and rereading between them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Stages draw random numbers and train models: SQL can't express the rows (tests hold the stages
#: against plain versions of them on small tables).
ORACLE_SQL = None
