"""Token counts: pieces are counted once per distinct pre-token, then joined to the pre-tokens of the documents.

Texts are cut into pre-tokens in the JVM by the tokenizer's own pattern. Every distinct pre-token of the corpus is
encoded once. The most frequent ``head`` ones (a bounded broadcast) are joined where the text is read, so that a
document leaves the scan as one row with the sum so far and a row for each rare pre-token; those are joined by
shuffle, which has no hot key, as hot pre-tokens are in the head. No ids are kept.

The special string counts as one token wherever it stands, as the library does by default. The JVM's Unicode tables
can be older than the library's: rows with characters that are unassigned there are counted by the library itself.
A null text is empty and has no tokens. Rows with equal ids stay apart.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm.common import ROW, identified, materialize

#: Entries of the broadcast head, and the longest pre-token (in characters) that it takes: at most some 50 MB.
HEAD, HEAD_CHARS = 300_000, 48

#: The pre-token pattern and the special string of the byte-level vocabulary.
PRETOKEN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"

_loaded: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once for each process."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        _loaded[path] = loaded
    return _loaded[path]


def pretokens(text: Column) -> Column:
    """The pre-tokens of a text without its special strings."""
    pattern = F.lit(PRETOKEN)
    apart = F.flatten(
        F.transform(F.split(text, r"<\|endoftext\|>", -1), lambda p: F.regexp_extract_all(p, pattern, F.lit(0)))
    )
    return F.when(text.contains(SPECIAL), apart).otherwise(F.regexp_extract_all(text, pattern, F.lit(0)))


def specials(text: Column) -> Column:
    return F.when(text.contains(SPECIAL), F.size(F.split(text, r"<\|endoftext\|>", -1)) - 1).otherwise(0).cast("long")


def counted(pieces: DataFrame, path: str, column: str) -> DataFrame:
    """``pieces`` with ``n``: the number of tokens of each text in ``column``, special strings as the library does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            texts = batch.column(column).to_pylist()
            counts: list[int] = []
            for i in range(0, len(texts), 2048):
                counts += map(len, own.encode_batch_fast(texts[i : i + 2048], add_special_tokens=False))
            arrays = [*batch.columns, pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "n"])

    from pyspark.sql.types import LongType, StructType

    return pieces.mapInArrow(run, StructType([*pieces.schema.fields]).add("n", LongType()))


def count_tokens(
    spark: SparkSession, docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 512
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of each row of ``docs``."""
    docs = identified(spark, docs).select(ROW, F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    unknown = F.col("text").rlike(r"\p{Cn}")
    known, other = docs.where(~unknown), docs.where(unknown)
    pieces = known.select(F.explode(pretokens(F.col("text"))).alias("piece")).groupBy("piece").count()
    # Special strings were taken out before, so none can arise inside a pre-token.
    dictionary = materialize(spark, counted(pieces, path, "piece"), "pieces")
    head = (
        dictionary.where(F.length("piece") <= HEAD_CHARS).orderBy(F.desc("count"), "piece").limit(HEAD).select("piece", "n")
    )
    head = materialize(spark, head, "head")
    # What the whole text says is taken before its pieces become rows: above, it would be worked out for each piece.
    cut = known.select(
        ROW,
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        specials(F.col("text")).alias("special"),
        pretokens(F.col("text")).alias("pieces"),
    )
    rows = cut.select(ROW, "doc_id", "n_bytes", "special", F.explode_outer("pieces").alias("piece"))
    summed = (
        rows.join(F.broadcast(head), "piece", "left")
        .groupBy(ROW, "doc_id", "n_bytes", "special", F.expr("if(n IS NULL, piece, NULL)").alias("rare"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("times"))
    )
    summed = materialize(spark, summed, "summed")
    rare = (
        summed.where("rare IS NOT NULL")
        .join(dictionary.select(F.col("piece").alias("rare"), F.col("n").alias("each")), "rare")
        .select(ROW, "doc_id", "n_bytes", "special", (F.col("times") * F.col("each")).alias("n"))
    )
    parts = summed.where("rare IS NULL").select(ROW, "doc_id", "n_bytes", "special", "n").unionByName(rare)
    totals = parts.groupBy(ROW, "doc_id", "n_bytes", "special").agg(F.sum("n").alias("n")).select(
        "doc_id", "n_bytes", (F.coalesce("n", F.lit(0)) + F.col("special")).alias("n_tokens")
    )
    direct = counted(other.select("doc_id", "text"), path, "text").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.col("n").alias("n_tokens")
    )
    return totals.unionByName(direct).withColumn("over_limit", F.col("n_tokens") > limit)
