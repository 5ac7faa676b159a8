"""Mixing: targets, seats and the words taken, against plain loops."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from seriesflow.llm import apportion


def filled(sizes, weights, most):
    """Water filling round by round, in fractions."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in held)
        open_ = [s for s in names if s not in held]
        share = {s: Fraction(rest * weight[s], sum(weight[x] for x in open_)) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return {s: share.get(s, Fraction(most * sizes[s])) for s in names}
        held |= set(over)


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}" if i else None: rng.choice([0, 1, 7, 100, 10_000, 123_456_789]) for i in range(rng.randint(1, 12))}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in apportion.targets(frame).collect()}
    want = filled(sizes, apportion.WEIGHTS, apportion.MOST) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
    assert got == pytest.approx({s: float(t) for s, t in want.items()})


@pytest.mark.parametrize("seed", range(4))
def test_seats(spark, seed):
    rng = random.Random(seed)
    rows = []
    for g in range(5):
        seats = rng.choice([0, 1, 2, 17, 1000])
        rows += [(g, f"c{i}", rng.choice([0, 1, 1, 5, 60, 777]), seats) for i in range(rng.randint(1, 30))]
    frame = spark.createDataFrame(rows, "g int, cell string, w bigint, n bigint")
    found = apportion.apportioned(frame, ["g"], ["g", "cell"], "w", "n")
    got = {(r["g"], r["cell"]): r["quota"] for r in found.collect()}
    want = {}
    for g in range(5):
        cells = {c: w for h, c, w, _ in rows if h == g and w}
        seats = next(n for h, _, _, n in rows if h == g) if cells else 0
        won = dict.fromkeys(cells, 0)
        for _ in range(seats):
            won[max(sorted(cells), key=lambda c: Fraction(cells[c], 2 * won[c] + 1))] += 1
        want |= {(g, c): n for c, n in won.items()}
    assert got == want


SCHEMA = "doc_id bigint, text string, source string, rank string, stop string, target string"


def made(spark):
    rng = random.Random(9)
    rows = [(None, "no id", "a"), (1, None, "a"), (1, "", "b"), (2, " \t\x0b ", None), (3, "x " * 30_000, "huge"), (4, "one", "tiny")]
    rows += [(i // 2, "w " * rng.randint(1, 400), rng.choice(["a", "a", "a", "b", "ä", "B", None])) for i in range(10, 600)]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def test_mix(spark):
    docs = made(spark)
    got = apportion.mix(spark, docs).collect()
    assert len(got) == docs.count()
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").encode().split())
    want = {s: float(t) for s, t in filled(sizes, apportion.WEIGHTS, apportion.MOST).items()}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(2 * apportion.BLOCK, 0.01 * t), s
    again = apportion.mix(spark, docs.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_shards(spark, monkeypatch):
    """A large source is many shards, and each gives its part."""
    monkeypatch.setattr(apportion, "SHARD_WORDS", 2_000)
    got = apportion.mix(spark, made(spark)).where("size > 0 AND source = 'a'")
    row = got.agg(F.sum("taken"), F.first("target"), F.sum("size"), F.max(F.expr("taken - 3 * size"))).first()
    assert row[2] > 10 * apportion.SHARD_WORDS and row[3] <= 0
    assert abs(row[0] - row[1]) <= 0.02 * row[1]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert apportion.mix(spark, docs).count() == 0
    silent = spark.createDataFrame([(1, None, "a", "", "", ""), (2, " ", None, "", "", "")], SCHEMA)
    assert [(r["size"], r["target"], r["taken"]) for r in apportion.mix(spark, silent).collect()] == [(0, 0.0, 0)] * 2
