"""The table contract: schemas, keys, comments and quality rules of the landing files and the five tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*columns: tuple[str, DataType, str]) -> StructType:
    return StructType([StructField(n, t, True, {"comment": c} if c else None) for n, t, c in columns])


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# The column names and types of the landing files and the five tables.
LANDING_OBSERVATIONS = _strings("run_timestamp", "series_id", "series_name", "date", "value")

LANDING_METADATA = _strings(
    "run_timestamp",
    "series_id",
    "friendly_name",
    "title",
    "frequency",
    "frequency_short",
    "units",
    "units_short",
    "seasonal_adjustment",
    "seasonal_adjustment_short",
    "observation_start",
    "observation_end",
    "last_updated",
    "popularity",
    "notes",
)

BRONZE_OBSERVATIONS = _struct(
    ("run_timestamp", TimestampType(), "run that delivered the row"),
    ("series_id", StringType(), "series key"),
    ("series_name", StringType(), "friendly name at delivery"),
    ("date", DateType(), "observation date"),
    ("value", DoubleType(), "observed value, null when missing"),
    ("ingestion_timestamp", TimestampType(), "when the row reached this table"),
)

BRONZE_METADATA = LANDING_METADATA

SILVER_METADATA = _struct(
    ("series_id", StringType(), "primary key"),
    ("friendly_name", StringType(), ""),
    ("title", StringType(), ""),
    ("frequency", StringType(), ""),
    ("frequency_short", StringType(), ""),
    ("units", StringType(), ""),
    ("units_short", StringType(), ""),
    ("seasonal_adjustment", StringType(), ""),
    ("seasonal_adjustment_short", StringType(), ""),
    ("observation_start", DateType(), "first date the provider offers"),
    ("observation_end", DateType(), "last date the provider offers"),
    ("last_updated", TimestampType(), "provider's last change"),
    ("popularity", IntegerType(), ""),
    ("notes", StringType(), ""),
    ("run_timestamp", TimestampType(), "run that delivered the row"),
    ("updated_at", TimestampType(), "when the row reached this table"),
)

SILVER_OBSERVATIONS = _struct(
    ("series_id", StringType(), "refers to silver_metadata.series_id"),
    ("series_name", StringType(), ""),
    ("date", DateType(), "observation date"),
    ("value", DoubleType(), "observed value"),
    ("run_timestamp", TimestampType(), "run that delivered the row"),
    ("updated_at", TimestampType(), "when the row reached this table"),
)

GOLD_OBSERVATIONS = _struct(
    ("series_id", StringType(), "series key"),
    ("date", DateType(), "observation date"),
    ("value", DoubleType(), "observed value"),
    ("title", StringType(), "full title"),
    ("friendly_name", StringType(), "short name"),
    ("units", StringType(), "measurement units"),
    ("source", StringType(), "data provider"),
)


@dataclass(frozen=True)
class TableSpec:
    """One table of the pipeline."""

    name: str
    schema: StructType
    layer: str
    comment: str
    rules: dict[str, str] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> tuple[str, ...]:
        """Columns that a rule keeps from being NULL."""
        return tuple(f.name for f in self.schema.fields if f"{f.name} IS NOT NULL" in self.rules.values())

    @property
    def constraints(self) -> str:
        """What the keys, references and rules say, as one line."""
        said = [f"key ({', '.join(self.key)})"] if self.key else []
        said += [f"{column} in {target}" for column, target in self.references.items()]
        said += [f"never null: {', '.join(self.required)}"] if self.required else []
        return "; ".join(said)

    @property
    def properties(self) -> dict[str, str]:
        found = {"quality": self.layer}
        if self.constraints:
            found["constraints"] = self.constraints
        return found


TABLES = {
    spec.name: spec
    for spec in (
        TableSpec(
            "bronze_observations",
            BRONZE_OBSERVATIONS,
            "bronze",
            "Observations as landed, typed",
            cluster_by=("series_id", "date"),
        ),
        TableSpec(
            "bronze_metadata",
            BRONZE_METADATA,
            "bronze",
            "Series metadata as landed",
            cluster_by=("series_id",),
        ),
        TableSpec(
            "silver_metadata",
            SILVER_METADATA,
            "silver",
            "Series metadata with proper types",
            rules={"pk_series_id_not_null": "series_id IS NOT NULL"},
            cluster_by=("series_id",),
            key=("series_id",),
        ),
        TableSpec(
            "silver_observations",
            SILVER_OBSERVATIONS,
            "silver",
            "Observations with a value",
            rules={
                "fk_series_id_not_null": "series_id IS NOT NULL",
                "date_not_null": "date IS NOT NULL",
                "value_not_null": "value IS NOT NULL",
            },
            cluster_by=("series_id", "date"),
            references={"series_id": "silver_metadata.series_id"},
        ),
        TableSpec(
            "gold_observations",
            GOLD_OBSERVATIONS,
            "gold",
            "Observations joined to their series",
            cluster_by=("series_id", "date"),
        ),
    )
}
