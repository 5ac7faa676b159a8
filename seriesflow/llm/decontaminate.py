"""Benchmark decontamination: a broadcast hash set of normalised test n-grams scans the windows of the documents.

Words are maximal runs of digits, letters a-z and characters beyond ASCII, after A-Z are lower-cased. A window is
``size`` consecutive words of an item; an item of fewer words is one window. The hashes of all windows become a bit
set with two probes, a literal of the plan, that every window of a document is tested against where it is read. Only
windows that pass carry their words further, where an equality join with the windows themselves verifies them. The
set and the join's broadcast are bounded by ``most_windows`` distinct windows; beyond it all document windows are
joined with the item windows on their words, and the planner picks the join. The text is never shuffled.

Null and empty texts have no words and no hits. Rows with equal ids stay apart in ``scan``. Items of one id are one
item, items with a null id mark words but are not counted. An empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm.common import ROW, identified, materialize, numbered, own_name, sha256_hex
from seriesflow.llm.url_rules import LOWER, UPPER

SIZE = 10
#: Most distinct item windows for the bit set (some 24 bits each) and the broadcast (some 100 bytes each).
MOST_WINDOWS = 200_000
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text; an empty array for null."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, _BREAKS, -1), "")


_WORD_HASHES = "transform(w, x -> xxhash64(x))"


def _starts(size: int, condition: str | None = None) -> str:
    """SQL: the first positions of windows of ``size`` words whose hash ``h`` meets the condition."""
    every = f"if(size(w) >= {size}, sequence(1, size(w) - {size - 1}), array())"
    if condition is None:
        return every
    hashed = f"transform(slice(array(xxhash64(slice(wh, i, {size}))), 1, 1), h -> {condition})[0]"
    return f"filter({every}, i -> {hashed})"


def item_windows(bench: DataFrame, id_column: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``(item_id, n, gram, h)``: the windows of the items; ``n`` is their number of words."""
    short = F.expr(f"if(size(w) = 0, array(), if(size(w) < {size}, array(1), {_starts(size)}))")
    return (
        bench.select(F.col(id_column).alias("item_id"), words(F.col(text)).alias("w"))
        .select("item_id", "w", F.expr(_WORD_HASHES).alias("wh"))
        .select("item_id", "w", "wh", F.least(F.size("w"), F.lit(size)).alias("n"), F.explode(short).alias("i"))
        .selectExpr("item_id", "n", "array_join(slice(w, i, n), ' ') AS gram", "xxhash64(slice(wh, i, n)) AS h")
        .distinct()
    )


def _bit_set(hashes: np.ndarray) -> tuple[str, int]:
    """The set as comma-separated 64-bit words, and the number of bits (a power of two)."""
    bits = 1 << max(6, int(24 * max(len(hashes), 1) - 1).bit_length())
    cells = np.zeros(bits // 64, np.uint64)
    h = hashes.astype(np.int64).view(np.uint64)
    for probe in (h, h >> np.uint64(32)):
        at = probe & np.uint64(bits - 1)
        np.bitwise_or.at(cells, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return ",".join(map(str, cells.view(np.int64).tolist())), bits


def _probe(cells: str, bits: int) -> str:
    """SQL: whether the set may hold ``h``."""
    table = f"cast(split('{cells}', ',') AS array<bigint>)"

    def one(value: str) -> str:
        at = f"({value} & {bits - 1}L)"
        return f"(shiftright({table}[cast(shiftrightunsigned({at}, 6) AS int)], cast({at} & 63L AS int)) & 1L) = 1L"

    return f"{one('h')} AND {one('shiftrightunsigned(h, 32)')}"


def scan(
    spark: SparkSession,
    docs: DataFrame,
    bench: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    most_windows: int = MOST_WINDOWS,
    row: str | None = None,
) -> DataFrame:
    """One row for each document: ``__row``, ``doc_id``, ``n_words``, ``n_hit``, ``items`` and ``spans``.

    ``items`` are the distinct ids as strings in order, ``spans`` the merged hit word ranges ``(first, last)``.
    ``row`` names a column of unique numbers of the rows, if ``docs`` has one that every scan reads alike.
    """
    docs = docs.withColumn(ROW, F.col(row)) if row else identified(spark, docs)
    grams = materialize(spark, item_windows(bench, text="text", size=size), "windows")
    known = grams.groupBy("gram", "n").agg(
        F.collect_set(F.col("item_id").cast("string")).alias("items"), F.first("h").alias("h")
    )
    facts = known.agg(F.count("*").alias("windows"), F.collect_set("n").alias("sizes")).first()
    small = facts["windows"] <= most_windows
    condition = None
    if small:
        hashes = np.array([r[0] for r in known.select("h").collect()], np.int64)
        condition = _probe(*_bit_set(hashes))
        known = F.broadcast(known)
    found = [
        f"transform({_starts(n, condition)}, i -> struct(i AS at, {n} AS n))" for n in sorted(facts["sizes"])
    ] or ["cast(array() AS array<struct<at:int,n:int>>)"]
    # The word hashes are bound to a variable: as a column they would be computed again inside the lambda.
    passing = f"transform(array({_WORD_HASHES}), wh -> concat({', '.join(found)}))[0]"
    rows = (
        docs.select(ROW, F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("w"))
        .select(ROW, "doc_id", "w", F.size("w").cast("long").alias("n_words"), F.expr(passing).alias("c"))
        .select(
            ROW,
            "doc_id",
            "n_words",
            F.explode_outer(
                F.expr("transform(c, c -> struct(c.at AS at, c.n AS n, array_join(slice(w, c.at, c.n), ' ') AS gram))")
            ).alias("c"),
        )
    )
    # A row without candidates has no gram; a key of its own keeps such rows from meeting in one partition.
    keyed = rows.select(
        ROW, "doc_id", "n_words", "c.at", F.coalesce("c.n", F.lit(0)).alias("n"),
        F.coalesce("c.gram", F.concat(F.lit(" "), F.col(ROW).cast("string"))).alias("gram"),
    )
    hits = keyed.join(known.drop("h"), ["gram", "n"], "left")
    merged = """aggregate(array_sort(hits), cast(array() AS array<struct<first:int,last:int>>),
        (acc, x) -> if(size(acc) > 0 AND x.first <= acc[size(acc) - 1].last + 1,
            concat(slice(acc, 1, size(acc) - 1),
                   array(struct(acc[size(acc) - 1].first AS first, greatest(acc[size(acc) - 1].last, x.last) AS last))),
            concat(acc, array(x))))"""
    return (
        hits.groupBy(ROW, "doc_id", "n_words")
        .agg(
            F.collect_list(F.expr("if(items IS NULL, NULL, struct(at AS first, at + n - 1 AS last))")).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .withColumn("spans", F.expr(merged))
        .withColumn("n_hit", F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)"))
        .select(ROW, "doc_id", "n_words", "n_hit", "items", "spans")
    )


def report(scanned: DataFrame) -> DataFrame:
    """The digest of ``scan``: hit counts, the items' digest and the verdict for each document."""
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove_documents(spark: SparkSession, docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a window of an item."""
    columns, docs, row = numbered(spark, docs)
    hit = scan(spark, docs, bench, row=row, **options).where("n_hit > 0").select(F.col(ROW).alias(row))
    return docs.join(materialize(spark, hit, "hits"), row, "left_anti").select(*columns)


def remove_spans(spark: SparkSession, docs: DataFrame, bench: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words, and what lies between those of one span, cut from their texts."""
    columns, docs, row = numbered(spark, docs)
    hit, words_of = own_name(docs, "spans"), own_name(docs, "pieces")
    spans = scan(spark, docs, bench, text=text, row=row, **options).where("n_hit > 0")
    spans = materialize(spark, spans.select(F.col(ROW).alias(row), F.col("spans").alias(hit)), "spans")
    breaks = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    body = F.regexp_replace(text, rf"\A{breaks}", "")
    # The pieces of the text: each word with the break behind it.
    pieces = F.regexp_extract_all(body, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), F.lit(0))
    kept = f"array_join(filter({words_of}, (p, i) -> NOT exists({hit}, s -> i + 1 BETWEEN s.first AND s.last)), '')"
    return (
        docs.join(spans, row, "left")
        .withColumn(words_of, F.when(F.col(hit).isNotNull(), pieces))
        .withColumn(text, F.when(F.col(hit).isNull(), F.col(text)).otherwise(F.expr(kept)))
        .select(*columns)
    )
