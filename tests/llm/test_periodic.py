"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from seriesflow.llm import periodic, queries
from seriesflow.llm.common import ship_package


def brute_force(w, length=24, exponent=3):
    found = []
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(length, exponent * q):
                own = w[i : i + size]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found)


def repetitive(rng):
    w, k = [], rng.choice([1, 2, 3, 5])
    size = rng.randint(0, 150)
    while len(w) < size:
        unit = [rng.randrange(k) for _ in range(rng.randint(1, 12))]
        w += unit * rng.choice([1, 1, 2, 3, 5, 9])
    return w


@pytest.mark.parametrize("length, exponent", [(24, 3), (6, 2), (2, 2), (10, 3), (12, 4)])
def test_runs_equal_the_search(length, exponent):
    rng = random.Random(length)
    texts = [repetitive(rng) for _ in range(150)]
    # Texts of one batch don't see each other.
    assert periodic.runs_of_texts(texts, length, exponent) == [brute_force(t, length, exponent) for t in texts]


def test_long_texts():
    assert periodic.runs_of_texts([[i % 7 for i in range(300_000)]]) == [[(0, 300_000, 7)]]
    rng = random.Random(3)
    unit = [rng.randrange(9) for _ in range(40_000)]
    assert (0, 120_000, 40_000) in periodic.runs_of_texts([unit * 3])[0]


def test_ordered_set():
    rng = random.Random(4)
    values = rng.sample(range(10**6), 20_000)
    own, seen = periodic.Positions(values[0]), [values[0]]
    for v in values[1:]:
        before, after = own.add(v)
        if len(seen) < 300:
            assert before == max((x for x in seen if x < v), default=-1)
            assert after == min((x for x in seen if x > v), default=-1)
        seen.append(v)
    assert list(own) == sorted(values) and own.size == len(values)


def test_operator(spark):
    ship_package(spark)
    texts = [None, "", " \t\n", "one", "a b " * 20, " ".join("xyz"[i % 3] for i in range(23)), "x\x1fy z " * 30, "ä " * 500 + "end"]
    rows = [(i // 2 if i else None, t, "c", "r") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, n_words string")
    got = periodic.find(docs).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"]) for r in got) == sorted(
        (i != 0, i // 2, len((t or "").encode().split())) for i, t in enumerate(texts)
    )
    found = {r["n_words"]: r for r in got}
    assert [tuple(x) for x in found[40]["runs"]] == [(0, 40, 2)] and found[40]["collapsed"] == "a b"
    assert not found[23]["runs"] and found[23]["strongest"] is None
    assert found[30]["collapsed"] == "x\x1fy z" and tuple(found[30]["strongest"]) == (0, 30, 1)
    assert found[501]["collapsed"] == "ä end" and tuple(found[501]["strongest"]) == (0, 500, 1)
    assert periodic.find(docs.limit(0)).count() == 0
    assert periodic.find(docs.withColumn("doc_id", F.lit("t"))).first()["doc_id"] == "t"


def test_strongest_ties():
    assert periodic.strongest([(50, 24, 2), (9, 36, 3), (9, 48, 4)]) == (9, 36, 3)
    assert periodic.strongest([(0, 100, 33), (5, 31, 10)]) == (5, 31, 10)


def test_query(spark):
    """The registered query on the smallest table, by the contract's own words."""
    sf_dir = "/root/testdata/sf0.001"
    want = {}
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        w = (row["text"] or "").encode().split()
        h = zlib.crc32(str(row["doc_id"]).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = brute_force(w) if n < 600 else periodic.runs_of_texts([w])[0]
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        best = min(runs, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=None)
        want[row["doc_id"]] = (
            len(runs),
            *(best or (None, None, None)),
            best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest(),
        )
    got = queries.registered()["op11_periodic_runs"](spark, sf_dir)
    assert dict(got.dtypes) == {"doc_id": "bigint", **dict.fromkeys(("n_runs", "start", "length", "period", "exponent_milli"), "bigint"),
                                "runs_sha256": "string", "collapsed_sha256": "string"}
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == want
    assert sum(v[0] for v in want.values()) > 3
