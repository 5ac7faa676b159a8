"""URL filter: sort-merge range join of reversed-host keys with a sorted sweep over nested rules.

A rule ``(host, path, verdict)`` fits its host and all subdomains, for paths that start with its own. Both sides
become keys ``reversed host # path`` (``org.example#/es/``; no host or path holds ``#``), so a rule is the interval
of the keys that it is a prefix of. A url has one key for each of its host's suffixes. Keys are dealt out by range
and swept in order: the last rule that starts at or before a key carries the stack of the rules around it, and the
rules of that stack that are prefixes of the key are active. The stack at the end of a range is carried into the
next ones. Only the carried stacks, one for each range, meet in one task.

Null urls and urls without ``://`` have an empty host and path and fit no rule. Rules with a null or empty host are
ignored, a null path is empty; of equal rules the smallest verdict counts. Of several fitting rules the longest
(host and path) wins, ties go to the longer host. Repeated urls are judged once; every row gets its verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from seriesflow.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
_RULE = "struct<key:string,host:string,path:string,verdict:string>"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Rules with ``stack``: the rules that their interval lies in, themselves included, outermost first."""
    own = (
        rules.where("host IS NOT NULL AND host <> ''")
        .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .withColumn("key", F.concat(_reversed(F.split("host", r"\.")), F.lit("#"), F.col("path")))
    )
    outer = own.select(F.struct("key", "host", "path", "verdict").alias("outer"), F.col("key").alias("prefix"))
    prefixes = own.select(
        "key", F.explode(F.expr("transform(sequence(1, length(key)), n -> substring(key, 1, n))")).alias("prefix")
    )
    return (
        prefixes.join(outer, "prefix")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct(F.length("prefix").alias("n"), "outer"))).alias("s"))
        .select("key", F.expr("transform(s, x -> x.outer)").alias("stack"))
    )


def sweep(spark: SparkSession, keys: DataFrame, rules: DataFrame) -> DataFrame:
    """``keys`` (a column ``key`` and others) with ``active``: the rules whose interval holds the key."""
    names = [c for c in keys.columns if c != "key"]
    kind = f"array<{_RULE}>"
    events = rule_stacks(rules).select(
        "key", F.col("stack").cast(kind), F.lit(True).alias("is_rule"), *[F.lit(None).alias(c) for c in names]
    ).unionByName(keys.withColumns({"stack": F.lit(None).cast(kind), "is_rule": F.lit(False)}))
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = events.repartitionByRange(count, "key", F.desc("is_rule"), *names)
    # The ranges are drawn from a sample, so they are fixed by writing them before they are read twice.
    dealt = materialize(spark, dealt.withColumn("block", F.spark_partition_id()), "sweep")
    ends = dealt.where("is_rule").groupBy("block").agg(F.max_by("stack", "key").alias("end"))
    blocks = dealt.select("block").distinct().join(ends, "block", "left")
    # One row for each range, however many keys there are.
    carried = blocks.select(
        "block",
        F.last("end", True).over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)).alias("carried"),
    )
    order = W.partitionBy("block").orderBy("key", F.desc("is_rule")).rowsBetween(W.unboundedPreceding, 0)
    return (
        dealt.withColumn("stack", F.last("stack", True).over(order))
        .where("NOT is_rule")
        .join(carried, "block", "left")
        .select(
            "key",
            *names,
            F.expr("filter(coalesce(stack, carried, array()), r -> startswith(key, r.key))").alias("active"),
        )
    )


def judge(spark: SparkSession, pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the winner, else null) and ``verdict``.

    Columns of ``pages`` with these names are replaced.
    """
    pages = pages.drop(*({"host", "path", "rule", "verdict", "rule_verdict"} - {url}))
    urls = pages.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    parted = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where(
        "host <> ''"
    )
    labels = F.split("host", r"\.")
    suffixes = parted.select("url", "path", labels.alias("labels")).select(
        "url",
        F.explode(
            F.expr(
                "transform(sequence(1, size(labels)), n ->"
                " concat(array_join(reverse(slice(labels, -n, n)), '.'), '#', path))"
            )
        ).alias("key"),
    )
    best = (
        sweep(spark, suffixes, rules)
        .where("size(active) > 0")
        .select("url", F.element_at("active", -1).alias("r"))
        .groupBy("url")
        .agg(
            F.max_by(
                F.struct(F.concat("r.host", "r.path").alias("rule"), F.col("r.verdict").alias("rule_verdict")),
                F.struct(F.length("r.host") + F.length("r.path"), F.length("r.host"), F.col("r.key")),
            ).alias("w")
        )
        .select(F.col("url").alias("__url"), "w.rule", "w.rule_verdict")
    )
    joined = pages.join(best, F.col(url) == F.col("__url"), "left")
    out = joined.withColumns(
        {
            "host": host_of(F.col(url)),
            "path": path_of(F.col(url)),
            "verdict": F.coalesce("rule_verdict", F.lit(default)),
        }
    )
    return out.drop("__url", "rule_verdict")
