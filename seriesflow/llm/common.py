"""Helpers that several operators share: row identity, written intermediate tables, connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from contextlib import suppress
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import seriesflow
from seriesflow.session import scratch_path

ROW = "__row"
_ARCHIVE = "seriesflow-package.zip"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that ``materialize`` has written and ``release`` has not emptied.
written: list[str] = []


def materialize(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Empty the folders of tables that ``materialize`` gave (or the folders named), once all that reads them is written.

    Nothing may read them after that: neither a DataFrame made of them nor one that is computed again from there.
    """
    for one in tables:
        if isinstance(one, str):
            paths = {one}
        else:
            paths = {f.rsplit("/", 1)[0] for f in one.inputFiles()}
        for path in paths:
            known = [w for w in written if w.rsplit("/", 1)[-1] == path.rsplit("/", 1)[-1]]
            for folder in known:
                spark.createDataFrame([], "released int").coalesce(1).write.mode("overwrite").parquet(folder)
                written.remove(folder)


_worker_stores: dict[str, dict] = {}


def worker_store(operator: str) -> dict:
    """What this process keeps for an operator from task to task.

    Python workers outlive the stages of a pipeline, so what they have kept for another operator goes, and its memory back
    to the system: beside the JVM of the same executor it would be missing there.
    """
    others = [name for name in _worker_stores if name != operator]
    if others:
        for other in others:
            _worker_stores.pop(other).clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # not every C library has it
            ctypes.CDLL(None).malloc_trim(0)
    return _worker_stores.setdefault(operator, {})


def own_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores until no column of ``df`` has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(spark: SparkSession, df: DataFrame) -> tuple[list[str], DataFrame, str]:
    """The columns of ``df`` as they are to be selected, ``df`` written once with the numbers of its rows in a column
    that it does not have, and that column's name."""
    row = own_name(df, ROW)
    rows = materialize(spark, df.withColumn(row, F.monotonically_increasing_id()), "rows")
    return [f"`{c}`" for c in df.columns], rows, row


def identified(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` with a unique long column ``__row``, for callers that number the rows in one scan only.

    Rows need not have a key: repeated and null ids stay apart. Another scan of the same files may give the rows
    other numbers, as splits follow the cores of the moment. Where several steps read ``__row``, use ``stored``.
    """
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        df = materialize(spark, df, "rows")
    return df.withColumn(ROW, F.monotonically_increasing_id())


def stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` with a unique long column ``__row``, written once, so that every later step reads the same numbers."""
    return materialize(spark, df.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, component)`` of an undirected graph given as ``(a, b)``: the smallest node that links reach.

    Alternates large-star and small-star steps; each step is written, nothing of the graph reaches the driver
    but two sums. A node with very many edges meets its minimum in a join that adaptive execution can split.
    """
    edges = materialize(
        spark,
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )

    def step(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select("a", "b")
        if large:
            both = both.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        joined = both.join(least, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(
            pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )

    before = mark(edges)
    while True:
        edges, former = materialize(spark, step(step(edges, True), False), "edges"), edges
        release(spark, former)
        now = mark(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def sha256_hex(column) -> object:
    """Lowercase hex SHA-256 of a text or binary column."""
    return F.sha2(column, 256)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once for each Spark context."""
    context = spark.sparkContext
    if any(Path(name).name == _ARCHIVE for name in context._python_includes):
        return
    top = Path(seriesflow.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="seriesflow-")) / _ARCHIVE
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(top.rglob("*.py")):
            z.write(path, path.relative_to(top.parent))
    context.addPyFile(str(archive))
