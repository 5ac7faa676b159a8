"""A training-corpus pipeline: language, near duplicates, contamination, secrets, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that it keeps, with the columns of ``docs``; the
last one adds the tokens. ``run`` writes each stage's result as Parquet to the shared scratch folder and reads it again
for the next.

A document is rejected by the language stage if its language is ``und``: its text is null or has no letter. Of near
duplicates one row of a class stays. Documents that hold a window of a benchmark item go. Secrets are replaced in the
texts by a mark. Columns beyond those of ``documents`` are kept; an empty table passes every stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm import bpe_chunks, decontaminate, langid, near_dups, secrets
from seriesflow.llm.common import release, ship_package, table, written
from seriesflow.llm.queries import BATCH_ROWS, tokenizer_path
from seriesflow.session import configure, scratch_path

#: SQL can't express the trained network, the vocabulary's merges and the classes of near duplicates.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Scratch folders of the stages before.
_left: list[str] = []


def _stage(work: Stage) -> Stage:
    """A stage that prepares the session, and frees what earlier stages have left in the scratch folder.

    Their results have been written by then, as ``run`` does; folders that ``docs`` still reads are left alone.
    """

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark)
        ship_package(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        read = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in docs.inputFiles()}
        if not any(folder.rsplit("/", 1)[-1] in read for folder in _left):
            release(spark, *_left)
            _left.clear()
        before = set(written)
        kept = work(spark, docs, sf_dir)
        _left.extend(folder for folder in written if folder not in before)
        return kept

    return run_stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; where none is labelled, those with a letter."""
    network = langid.train(docs)
    if network is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = langid.identify(docs, network)
    return judged.where(F.col("lang_pred") != langid.UNKNOWN).select(*[f"`{c}`" for c in docs.columns])


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dups.keep_one(spark, docs).select(*[f"`{c}`" for c in docs.columns])


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    kept = decontaminate.remove_documents(spark, docs, table(spark, sf_dir, "benchmark"))
    return kept.select(*[f"`{c}`" for c in docs.columns])


@_stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secrets.redact(spark, docs).select(*[f"`{c}`" for c in docs.columns])


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``n_tokens``, ``ids`` and the ``decoded`` text."""
    return bpe_chunks.encode(spark, docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, former = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        # What the stage has read is no longer needed once its own result is there.
        release(spark, *([former] if former else []))
        written.append(path)
        former = path
    return docs
