"""Columns of any name in the input: none is taken for the library's own, none is lost."""

import pytest
from pyspark.sql import functions as F

from seriesflow.llm import decontaminate, langid, near_dups, secrets
from seriesflow.llm.common import materialize, own_name, release, ship_package, written

ITEM = "one two three four five six seven eight nine ten eleven"
TEXTS = [f"Some words. {ITEM} and the end", "user password = longenough12 here", "quite another text", None, "quite another text"]
NAMES = ("__row", "__row_", "spans", "__spans", "pieces", "found", "__found", "hits", "w", "c", "key", "rep", "label", "size", "bands")


@pytest.fixture
def docs(spark):
    ship_package(spark)
    columns = ["doc_id bigint", "text string", *(f"`{n}` bigint" for n in NAMES)]
    # Every document has the same numbers in these columns.
    return spark.createDataFrame([(i, t, *[5] * len(NAMES)) for i, t in enumerate(TEXTS)], ", ".join(columns))


def rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", F.coalesce("text", F.lit("-"))).collect())


def test_near_duplicates(spark, docs):
    classes = near_dups.classes(spark, docs).collect()
    assert {r["doc_id"]: (r["class_id"], r["class_size"]) for r in classes} == {0: (0, 1), 1: (1, 1), 2: (2, 2), 3: (3, 1), 4: (2, 2)}
    kept = near_dups.keep_one(spark, docs)
    assert kept.columns == docs.columns and [r[0] for r in rows(kept)] == [0, 1, 2, 3]


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    scanned = {r["doc_id"]: r["n_hit"] for r in decontaminate.scan(spark, docs, bench).collect()}
    assert scanned == {0: 11, 1: 0, 2: 0, 3: 0, 4: 0}
    whole = decontaminate.remove_documents(spark, docs, bench)
    assert whole.columns == docs.columns and [r[0] for r in rows(whole)] == [1, 2, 3, 4]
    cut = decontaminate.remove_spans(spark, docs, bench)
    assert cut.columns == docs.columns
    assert rows(cut) == [(0, "Some words. and the end"), *[(i, t or "-") for i, t in enumerate(TEXTS)][1:]]


def test_redaction(spark, docs):
    redacted = secrets.redact(spark, docs)
    assert redacted.columns == docs.columns and redacted.where("`__spans` = 5 AND `__row` = 5").count() == 5
    assert rows(redacted)[1] == (1, "user [SECRET] here") and rows(redacted)[2:] == [(i, t or "-") for i, t in enumerate(TEXTS)][2:]


def test_language(spark, docs):
    train = spark.createDataFrame([(i, "abc " * 50, "aa") for i in range(40)] + [(i, "xyz " * 50, "zz") for i in range(40)], "doc_id bigint, text string, lang string")
    judged = langid.identify(docs, langid.train(train, per_language=20))
    assert judged.columns == [*docs.columns, "lang_pred", "score"] and judged.where("`__found` = 5 AND `found` = 5").count() == 5


def test_own_name(spark, docs):
    assert own_name(docs, "SPANS") == "SPANS_" and own_name(docs, "__row") == "__row__"


def test_release(spark, docs):
    kept, gone = materialize(spark, docs, "kept"), materialize(spark, docs, "gone")
    before = len(written)
    release(spark, gone)
    assert len(written) == before - 1 and kept.count() == len(TEXTS)
    release(spark, gone.limit(0), "elsewhere")
    assert len(written) == before - 1
