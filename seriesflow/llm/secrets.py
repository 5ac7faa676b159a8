"""Secret scan with multipart credential linking.

Base kinds are found by pattern: ``assign`` (a value of 8 or more characters assigned to a name such as password),
``access`` (an access key id of 16 or more), ``hex`` (32 or more hexadecimal digits); matches are leftmost and
non-overlapping within a kind. Weak kinds are looked for as well: ``id`` (a user or client name that is assigned),
``key`` (a mixed token of 20 or more characters) and ``endpoint`` (the address of a service). An interval join within
scopes of ``reach`` characters around a candidate reports a weak one only where its complementary parts co-occur:
an ``id`` beside a secret, a ``key`` beside an identifier, an ``endpoint`` beside both. A weak candidate that overlaps
a base span is not reported again.

Matching is done in built-in functions: the lengths of matches and of the pieces between them give the positions,
in code points. The interval join is an equality join on row and block of the text, so that a candidate meets only
its neighbours, with the ranges compared exactly. A text without matches has no spans; null is the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesflow.llm.common import ROW, materialize, numbered, own_name, sha256_hex, stored

#: Distance in code points within which parts belong together, and the width of the join's blocks.
REACH = 200
BLOCK = 512

#: The base patterns; the names match in either case.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
BASE = ("assign", "access", "hex")
WEAK = ("id", "key", "endpoint")

IDS = ("username", "user", "login", "account", "client_?id")
SCHEMES = ("https", "http", "ftp", "ssh", "postgresql", "postgres", "mysql", "mongodb", "redis", "amqp", "s3")


def either_case(name: str) -> str:
    """A pattern for the letters of ``name`` in either case, ASCII only."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


def _assigned(names: tuple[str, ...], value: str) -> str:
    listed = "|".join(map(either_case, names))
    return rf"""({listed})["']?\x20*[:=]\x20*["']?({value})"""


ASSIGN = _assigned(NAMES, "[A-Za-z0-9+/_.=-]+")
ID = _assigned(IDS, "[A-Za-z0-9._@+-]{3,}")
KEY = "[A-Za-z0-9+/_-]{20,}"
ENDPOINT = rf"(?:{'|'.join(SCHEMES)})://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "id": ID, "key": KEY, "endpoint": ENDPOINT}
KINDS = (*BASE, *WEAK)


def _passes(kind: str) -> str:
    """SQL: which matches ``m`` (with group 2 ``v``) count."""
    if kind == "assign":
        return "length(v) >= 8"
    if kind == "key":
        return "m RLIKE '[a-z]' AND m RLIKE '[A-Z]' AND m RLIKE '[0-9]'"
    return "true"


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(__row, k, start, stop)``: all matches of the base and weak kinds; ``k`` is the kind's place in KINDS."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        ROW,
        body.alias("body"),
        *[F.regexp_extract_all(body, F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in PATTERNS.items()],
    )

    def matches(kind: str) -> Column:
        m = f"m_{kind}"
        value = F.regexp_extract_all("body", F.lit(PATTERNS[kind]), F.lit(2)) if kind == "assign" else F.col(m)
        zipped = F.arrays_zip(F.col(m).alias("m"), value.alias("v"), F.split("body", PATTERNS[kind], -1).alias("gap"))
        # One piece more than matches: the last has no match and is left out.
        rows = F.transform(
            F.slice(zipped, F.lit(1), F.size(m)),
            lambda x, i: F.struct(
                F.lit(KINDS.index(kind)).alias("k"), i.alias("i"), F.length(x["gap"]).alias("gap"),
                F.length(x["m"]).alias("size"), x["m"].alias("m"), x["v"].alias("v"),
            ),
        )
        return F.when(F.size(m) > 0, rows).otherwise(F.array().cast("array<struct<k:int,i:int,gap:int,size:int,m:string,v:string>>"))

    passing = " ".join(f"WHEN k = {i} THEN {_passes(kind)}" for i, kind in enumerate(KINDS))
    flat = (
        found.where(" OR ".join(f"size(m_{k}) > 0" for k in KINDS))
        .select(ROW, F.explode(F.concat(*map(matches, KINDS))).alias("x"))
        .select(ROW, "x.*")
        .select(ROW, "k", "i", (F.col("gap") + F.col("size")).alias("step"), "size", F.expr(f"CASE {passing} END").alias("ok"))
    )
    order = W.partitionBy(ROW, "k").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    return (
        flat.withColumn("stop", F.sum("step").over(order))
        .where("ok")
        .select(ROW, "k", (F.col("stop") - F.col("size")).alias("start"), "stop")
    )


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak candidates among ``spans`` whose complementary parts lie within ``reach``."""
    first_weak, (is_id, is_key, is_endpoint) = len(BASE), (KINDS.index(k) for k in WEAK)

    def blocks(low: str, high: str) -> Column:
        return F.explode(F.expr(f"sequence(cast(floor(({low}) / {BLOCK}) AS int), cast(floor(({high}) / {BLOCK}) AS int))"))

    weak = spans.where(F.col("k") >= first_weak).select(
        ROW, "k", "start", "stop", blocks(f"start - {reach}", f"stop + {reach}").alias("block")
    )
    parts = spans.select(
        ROW, F.col("k").alias("pk"), F.col("start").alias("ps"), F.col("stop").alias("pe"), blocks("start", "stop - 1").alias("block")
    )
    apart = "(ps >= stop OR pe <= start)"
    secret = f"pk IN ({KINDS.index('assign')}, {KINDS.index('hex')}, {is_key})"
    name = f"pk IN ({KINDS.index('access')}, {is_id})"
    return (
        weak.join(parts, [ROW, "block"])
        .where(f"ps < stop + {reach} AND pe > start - {reach}")
        .groupBy(ROW, "k", "start", "stop")
        .agg(
            F.expr(f"bool_or({apart} AND {secret})").alias("has_secret"),
            F.expr(f"bool_or({apart} AND {name})").alias("has_name"),
            F.expr(f"bool_or(NOT {apart} AND pk < {first_weak})").alias("known"),
        )
        .where(
            f"NOT known AND CASE k WHEN {is_id} THEN has_secret WHEN {is_key} THEN has_name"
            f" WHEN {is_endpoint} THEN has_secret AND has_name END"
        )
        .select(ROW, "k", "start", "stop")
    )


def find(spark: SparkSession, docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """``(__row, spans)`` of the rows of ``docs`` (with ``__row``) that have any: structs ``(start, k, stop)`` in order."""
    spans = materialize(spark, candidates(docs, text), "spans")
    every = spans.where(F.col("k") < len(BASE)).unionByName(linked(spans, reach))
    return every.groupBy(ROW).agg(F.sort_array(F.collect_list(F.struct("start", "k", "stop"))).alias("spans"))


def _listed(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat(array({names})[s.k], ':', s.start, ':', s.stop)), ',')"


def report(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, their digest and all spans of each document."""
    docs = stored(spark, docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    base = f"filter(spans, s -> s.k < {len(BASE)})"
    counts = [
        F.expr(f"cast(size(filter(spans, s -> s.k = {i})) AS bigint)").alias(f"n_{k}") for i, k in enumerate(BASE)
    ]
    return (
        docs.select(ROW, "doc_id")
        .join(find(spark, docs), ROW, "left")
        .select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:bigint,k:int,stop:bigint>>")).alias("spans"))
        .select("doc_id", *counts, sha256_hex(F.expr(_listed(base))).alias("base_sha256"), F.expr(_listed("spans")).alias("spans"))
    )


def redact(spark: SparkSession, docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark``; overlapping spans become one."""
    columns, docs, row = numbered(spark, docs)
    hidden = own_name(docs, "spans")
    folded = f"""aggregate(`{hidden}`, struct('' AS out, 0L AS at),
        (acc, s) -> if(s.stop <= acc.at, acc, struct(
            concat(acc.out, if(s.start >= acc.at, concat(substring(`{text}`, cast(acc.at + 1 AS int), cast(s.start - acc.at AS int)), '{mark}'), '')) AS out,
            s.stop AS at)),
        acc -> concat(acc.out, substring(`{text}`, cast(acc.at + 1 AS int))))"""
    found = find(spark, docs.select(F.col(row).alias(ROW), F.col(text).alias("text")))
    found = materialize(spark, found.select(F.col(ROW).alias(row), F.col("spans").alias(hidden)), "found")
    redacted = F.when(F.col(hidden).isNull(), F.col(text)).otherwise(F.expr(folded))
    return docs.join(found, row, "left").withColumn(text, redacted).select(*columns)
