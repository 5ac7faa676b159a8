"""The operators over the driver's tables, with production parameters, and the digests of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm import align, apportion, bpe_chunks, chat, decontaminate, embeddings, langid, near_dups, periodic, secrets, suffixes, token_counts, url_rules
from seriesflow.llm.common import ship_package, table
from seriesflow.session import configure

#: Rows of an Arrow batch: documents can be long.
BATCH_ROWS = "512"

URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
MARKED = "\\### Assistant: </turn> ok"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string")) % 3
    network = langid.train(docs.where(part != 1))
    held_out = F.coalesce(part == 1, F.lit(False)).alias("held_out")
    return langid.identify(docs.select("doc_id", "text", held_out), network).drop("text")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.scan(spark, docs, bench))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.classes(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_chunks.report(bpe_chunks.encode(spark, docs, tokenizer_path("word_bpe_49k.json")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(spark, table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    judged = url_rules.judge(spark, table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], rows.schema)
    return chat.read_back(chat.format_log(chat.as_streamed(rows.unionByName(own))))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffixes.remove_repeated(spark, table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """The documents chosen by the checksum of their id repeat a stretch of their words up to the end."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(periodic.WORD), F.lit(0))
    docs = docs.select("doc_id", "text", checksum.alias("h")).withColumns(
        {"g": F.floor(F.col("h") / 10), "words": F.when(F.col("h") % 10 == 0, words)}
    )
    docs = docs.withColumn("n", F.size("words"))
    chosen = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    chosen = chosen.withColumn("p", period)
    rest = F.col("n") - F.col("a")
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), " ")
    return chosen.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(_with_planted_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.floor(1000 * F.col("strongest.length") / F.col("strongest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.align(spark, docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = apportion.mix(spark, table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


_REGISTERED = (
    op1_language_id,
    op2_decontamination,
    op3_near_duplicates,
    op4_bpe,
    op5_secrets,
    op6_token_counts,
    op7_embeddings,
    op8_url_rules,
    op9_chat,
    op10_suffix_dedup,
    op11_periodic_runs,
    op12_alignment,
    op13_mixing,
)


#: Queries whose result SQL can't express; each has a test against brute force, an exact round trip or held-out labels.
WITHOUT_SQL = frozenset(
    {
        "op1_language_id",
        "op3_near_duplicates",
        "op4_bpe",
        "op6_token_counts",
        "op7_embeddings",
        "op10_suffix_dedup",
        "op11_periodic_runs",
        "op12_alignment",
        "pipeline",
    }
)


def _configured(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        ship_package(spark)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries; ``corpus_pipeline`` imports this module, so it is imported here."""
    import corpus_pipeline

    return {query.__name__: _configured(query) for query in _REGISTERED} | {"pipeline": _configured(corpus_pipeline.run)}
