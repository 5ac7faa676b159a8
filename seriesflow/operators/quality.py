"""Named data-quality rules: warn, drop or fail, pass / fail counts and quarantine.

A rule is a SQL predicate. A row passes only where the predicate is true; NULL counts as failed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from seriesflow.session import scratch_path

MODES = ("warn", "drop", "fail")

FAILED_RULES, OUTCOME = "failed_rules", "_outcome"
KEPT, REJECTED = "kept", "rejected"


class ExpectationError(ValueError):
    """A batch that breaks rules in fail mode; ``broken`` has the number of rows for each rule."""

    def __init__(self, broken: Mapping[str, int]) -> None:
        super().__init__("expectation failed: " + ", ".join(f"{rule} ({n} rows)" for rule, n in broken.items()))
        self.broken = dict(broken)


@dataclass(frozen=True)
class Expectations:
    """A set of rules and what happens to rows that break one."""

    rules: Mapping[str, str] = field(default_factory=dict)
    mode: str = "drop"

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")

    @classmethod
    def not_null(cls, *columns: str, mode: str = "drop") -> Expectations:
        return cls({f"{c}_not_null": f"`{c}` IS NOT NULL" for c in columns}, mode)

    def passes(self, rule: str) -> Column:
        return F.coalesce(F.expr(self.rules[rule]).cast("boolean"), F.lit(False))

    def passes_all(self) -> Column:
        return reduce(and_, map(self.passes, self.rules), F.lit(True))

    def failed_rules(self) -> Column:
        """Names of the rules a row breaks."""
        names = F.array(*(F.when(~self.passes(r), F.lit(r)) for r in self.rules))
        return F.array_except(names, F.array(F.lit(None).cast("string")))

    def enforce(self, df: DataFrame) -> DataFrame:
        """The rows that stay, in the mode of this set; batch or stream."""
        if not self.rules or self.mode == "warn":
            return df
        if self.mode == "drop":
            # A filter drops NULL like false, so the bare predicates can reach the file scan.
            return df.filter(reduce(and_, map(F.expr, self.rules.values())))
        message = F.concat(F.lit("expectation failed: "), F.array_join(self.failed_rules(), ", "))
        # Being non-deterministic, the check is a barrier: no later filter is moved below it, so it sees every row.
        passed = self.passes_all() & (F.spark_partition_id() >= 0)
        return df.filter(F.when(passed, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))

    def gate(self, df: DataFrame) -> DataFrame:
        """The rows of a batch, staged and counted in one pass; none are handed on if the mode is fail and one breaks a rule.

        A filter raises only for rows that are asked for (``limit 1`` reads few). Here all rows are written to the
        scratch folder first, so what is published afterwards has been checked as a whole. Other modes hand on what
        :meth:`enforce` keeps.
        """
        spark, counted = df.sparkSession, Observation()
        path = scratch_path(spark, "staged")
        self.observe(df, counted).write.parquet(path)
        broken = {r: counted.get[f"failed_{r}"] for r in self.rules if counted.get[f"failed_{r}"]}
        if broken and self.mode == "fail":
            raise ExpectationError(broken)
        staged = spark.read.schema(df.schema).parquet(path)
        return self.enforce(staged) if broken else staged

    def sorted_out(self, df: DataFrame) -> DataFrame:
        """All rows with the rules they break and ``_outcome``, kept or rejected; batch or stream."""
        outcome = F.when(self.passes_all(), KEPT).otherwise(REJECTED)
        return df.withColumns({FAILED_RULES: self.failed_rules(), OUTCOME: outcome})

    def _counts(self) -> list[Column]:
        failed = [F.count_if(~self.passes(r)).alias(f"failed_{r}") for r in self.rules]
        return [F.count(F.lit(1)).alias("rows"), *failed]

    def observe(self, df: DataFrame, name: str | Observation) -> DataFrame:
        """Count failures while the rows pass by; no second scan. Comes before :meth:`enforce`."""
        return df.observe(name, *self._counts()) if self.rules else df

    def metrics(self, df: DataFrame) -> DataFrame:
        """(rule, failed, passed) rows from one pass."""
        counted = df.agg(*self._counts())
        entries = [
            F.struct(
                F.lit(r).alias("rule"),
                F.col(f"failed_{r}").alias("failed"),
                (F.col("rows") - F.col(f"failed_{r}")).alias("passed"),
            )
            for r in self.rules
        ]
        return counted.select(F.inline(F.array(*entries)))

    def quarantine(self, df: DataFrame, column: str = "failed_rules") -> DataFrame:
        """The rows that :meth:`enforce` drops, with the names of the rules they break."""
        return df.filter(~self.passes_all()).withColumn(column, self.failed_rules())


def in_range(column: str = "value", low: float = -5, high: float = 25) -> Column:
    return F.col(column).between(low, high)


def not_in_future(column: str = "date", as_of: str | None = None, slack_days: int = 1) -> Column:
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.col(column) <= F.date_add(today, slack_days)


def valid_id(column: str = "series_id") -> Column:
    """Upper-case letters, digits and underscores."""
    return F.col(column).rlike("^[A-Z0-9_]+$")


def is_upper(column: str = "series_id") -> Column:
    return F.upper(F.col(column)) == F.col(column)


def any_null(*columns: str) -> Column:
    """True where at least one of the columns is NULL."""
    return reduce(or_, (F.col(c).isNull() for c in columns))


def key_duplicates(df: DataFrame, key: Sequence[str], count: str = "n") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def primary_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row with the number of rows whose key is NULL and of keys that occur more than once."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    has_null = any_null(*key)
    return per_key.agg(
        F.coalesce(F.sum(F.when(has_null, F.col("_n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.count_if(~has_null & (F.col("_n") > 1)).alias("duplicate_keys"),
    )
