"""Catalog tables over parquet: description, append, full refresh, clustering, file sizes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seriesflow.schemas import TableSpec
from seriesflow.session import path_exists
from seriesflow.sources.landing import landed_files


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: StructType) -> str:
    parts = []
    for f in schema.fields:
        comment = (f.metadata or {}).get("comment")
        parts.append(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {quoted(comment)}" if comment else ""))
    return ", ".join(parts)


def _properties(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    path: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    if_not_exists: bool = True,
    options: Mapping[str, str] | None = None,
) -> None:
    """An external parquet table with comments and properties."""
    statement = f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{table} ({_columns(schema)}) USING parquet"
    if options:
        statement += f" OPTIONS ({_properties(options)})"
    statement += f" LOCATION {quoted(path)}"
    if comment:
        statement += f" COMMENT {quoted(comment)}"
    if properties:
        statement += f" TBLPROPERTIES ({_properties(properties)})"
    spark.sql(statement)


def create_from_spec(
    spark: SparkSession, table: str, spec: TableSpec, path: str, options: Mapping[str, str] | None = None
) -> None:
    create_table(spark, table, spec.schema, path, spec.comment, spec.properties, options=options)


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def append(df: DataFrame, table: str, path: str | None = None) -> None:
    """Append by column name. New columns are added to the table; columns the rows lack are NULL.

    The first append creates the table, over ``path`` if given.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.write.format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(table)
        return
    existing = spark.table(table).schema
    added = StructType([f for f in df.schema.fields if f.name not in existing.names])
    if added.fields:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(added)})")
    target = StructType([*existing.fields, *added.fields])
    rows = df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        )
    )
    rows.write.insertInto(table)


def ranged(df: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partitioned rows: each file holds a narrow range of ``by``. Also for a stream, within each micro-batch.

    The remaining sortable columns end the range key: a hot key is spread over as many partitions as its
    rows differ. For copies that are equal in every column use :func:`sized`. The ranges are sampled in a pass of their
    own over ``df``, so rows are to be counted by ``observe`` after this, not before. Without ``partitions`` AQE merges
    ranges up to the advisory partition size.
    """
    rest = [f.name for f in df.schema.fields if f.name not in by and f.dataType.typeName() not in ("map", "variant")]
    keys = [*by, *rest]
    return df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)


#: Bytes of columnar input for one range: its rows are sorted by one task.
RANGE_BYTES = 32 << 20


def range_count(input_bytes: int, least: int = 1) -> int:
    """How many ranges an input of this size is to be cut into, so that the rows of one don't grow with it."""
    return max(least, -(-input_bytes // RANGE_BYTES))


def clustered(df: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted rows, so that file and row-group statistics skip other keys; see :func:`ranged`."""
    return ranged(df, by, partitions).sortWithinPartitions(*by)


def sized(df: DataFrame, *by: str) -> DataFrame:
    """Files near the advisory partition size: AQE merges small and splits skewed partitions before the write.

    With ``by`` rows of a key stay together as far as the size allows, and are sorted by it.
    """
    balanced = df.hint("rebalance", *by)
    return balanced.sortWithinPartitions(*by) if by else balanced


def refresh(
    df: DataFrame,
    table: str,
    root: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    schema: StructType | None = None,
    versions: int = 2,
) -> str:
    """Full refresh of a materialized view.

    The rows go to a folder that is not in use and the table's location moves only once they are complete:
    readers see the old or the new rows, a failed refresh changes nothing, and ``df`` may read the table.
    ``versions`` folders take turns. With two, a query that began before a refresh ended has until the next
    one starts; keep more where queries run longer than that. ``schema`` may add column comments.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    live = table_location(spark, table).rstrip("/").rsplit("/", 1)[-1] if exists else ""
    turn = (int(live.removeprefix("v")) + 1) % versions if re.fullmatch(r"v\d+", live) else 0
    path = f"{root.rstrip('/')}/v{turn}"
    df.write.mode("overwrite").parquet(path)
    if not exists:
        create_table(spark, table, schema or df.schema, path, comment, properties)
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(path)}")
        if properties:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_properties(properties)})")
    spark.catalog.refreshTable(table)
    return path


def partition_location(spark: SparkSession, table: str, by: str, value: str) -> str | None:
    """Folder of one partition, None if the table lacks it."""
    there = spark.sql(f"SHOW PARTITIONS {table} PARTITION (`{by}` = {quoted(value)})")
    if there.isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (`{by}` = {quoted(value)})")
    return described.filter("col_name = 'Location'").first()["data_type"]


def _partition_files(spark: SparkSession, folder: str) -> set[tuple[str, str]]:
    """(value, name) of the files in the partitions of a folder; their contents are not read."""
    if not path_exists(spark, folder):
        return set()
    listed = landed_files(spark, folder).select(F.split("file_path", "/").alias("at"))
    held = listed.select(F.element_at("at", -2).alias("partition"), F.element_at("at", -1).alias("name"))
    return {(r["partition"].partition("=")[2], r["name"]) for r in held.collect()}


def refresh_partitions(
    df: DataFrame,
    table: str,
    root: str,
    by: str,
    values: Sequence[str],
    comment: str = "",
    properties: Mapping[str, str] | None = None,
    schema: StructType | None = None,
) -> None:
    """Refresh of those partitions of a materialized view whose ``by`` is one of ``values``; the others stay as they are.

    The new rows of a partition go to the one of its two folders that is not in use, and its location moves only when
    all are complete. A failed refresh changes nothing, or leaves some partitions new and the others old; the next
    one takes the folder that the catalog does not name. A value without rows loses its partition. ``values`` are
    few, such as calendar periods; ``df`` ends with ``by`` and may read the table.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        columns = StructType([*(schema or df.drop(by).schema).fields])
        statement = f"CREATE TABLE {table} ({_columns(columns)}, `{by}` STRING) USING parquet PARTITIONED BY (`{by}`)"
        statement += f" LOCATION {quoted(f'{root.rstrip("/")}/t0')} COMMENT {quoted(comment)}"
        spark.sql(statement)
    live = {value: partition_location(spark, table, by, value) for value in values}
    home = {v: f"{root.rstrip('/')}/t{int(bool(at) and at.rstrip('/').rsplit('/', 2)[-2] == 't0')}" for v, at in live.items()}
    filled = set()
    for folder in sorted(set(home.values())):
        own = [v for v in values if home[v] == folder]
        rows = df.where(F.col(by).isin(own))
        before = _partition_files(spark, folder)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(folder)
        # Each write names its files anew, so a value has rows if it has a file that was not there.
        filled |= {held for held, _ in _partition_files(spark, folder) - before}
    for value in values:
        spec = f"PARTITION (`{by}` = {quoted(value)})"
        at = quoted(f"{home[value]}/{by}={value}")
        if value not in filled:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")
        elif live[value] is None:
            spark.sql(f"ALTER TABLE {table} ADD {spec} LOCATION {at}")
        else:
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {at}")
    if properties:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_properties(properties)})")
    spark.catalog.refreshTable(table)


def compact(spark: SparkSession, table: str, root: str, by: Sequence[str] = ()) -> str:
    """Rewrite a table into well-sized files (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).

    For tables written by batch jobs. A folder that a streaming flow appends to stays where the flow and its
    readers expect it.
    """
    if path_exists(spark, f"{table_location(spark, table)}/_spark_metadata"):
        raise ValueError(f"{table} is written by a streaming flow")
    return refresh(sized(spark.table(table), *by), table, root)
