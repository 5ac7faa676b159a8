"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them, one vector of a group kept.

The cells are fitted in numpy on a bounded sample (``SAMPLE`` vectors, more for many cells) and every vector is
assigned. A vector also visits the cells that lie within ``reach`` of the linking distance behind the plane between
that cell and its own. The distances of two linked vectors to the plane between their cells add up to the linking
distance at most, so one of them visits the other's cell if ``reach`` is a half. A link is counted for the vector at
home and, if that one does not visit the visitor's own cell, for the visitor, too. A cell is cut into blocks of some ``BLOCK`` vectors,
and each pair of blocks is a task's unit, so that no cell is gathered. A unit returns the number of links of each
vector and a spanning forest, not the pairs. Equal vectors are compared once.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
different length. Cosine is computed in double precision and compared with ``THRESHOLD``. Rows with equal ids stay
apart. A component is named by its smallest id; null ids are kept apart by ``kept`` being true only for that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm.common import ROW, components, identified, materialize

THRESHOLD, REACH = 0.95, 0.5
PER_CELL, MOST_CELLS, BLOCK = 1000, 4096, 1024
SAMPLE = 20_000
STEPS = 8
#: For rounding: a visitor may lie so much further behind the plane.
SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    x = np.asarray(vectors, np.float64)
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, steps: int = STEPS, seed: int = 0) -> np.ndarray:
    """Centres of length one of the unit vectors ``x``; at most as many as vectors."""
    k = min(k, len(x))
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(steps):
        sums = np.zeros_like(centres)
        for i in range(0, len(x), 4096):
            part = x[i : i + 4096]
            np.add.at(sums, (part @ centres.T).argmax(1), part)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def fit_cells(spark: SparkSession, classes: DataFrame, per_cell: int = PER_CELL) -> dict[int, np.ndarray]:
    """Centres for each length of vectors; the sample is drawn by a hash."""
    counts = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    centres = {}
    for dim, count in counts.items():
        k = max(1, min(MOST_CELLS, -(-count // per_cell)))
        drawn = classes.where(F.col("dim") == dim).select("embedding").orderBy(F.xxhash64("embedding")).limit(max(SAMPLE, 16 * k))
        sample = np.array([r[0] for r in drawn.collect()], np.float64)
        centres[dim] = spherical_kmeans(unit(sample), k)
    return centres


def _assigner(centres: dict[int, np.ndarray], margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, dims = np.array(batch.column("rep").to_pylist(), np.int64), batch.column("dim").to_pylist()
            copies, lists = np.array(batch.column("copies").to_pylist(), np.int64), batch.column("embedding").to_pylist()
            for dim in set(dims):
                at = np.flatnonzero(np.array(dims) == dim)
                x, c = unit(np.array([lists[i] for i in at], np.float64)), centres[dim]
                s = x @ c.T
                home = s.argmax(1)
                apart = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))[home]
                near = s.max(1, keepdims=True) - s <= margin * apart + SLACK
                near[np.arange(len(x)), home] = True
                i, cell = np.nonzero(near)
                # The row at home lists all cells of its vector; these are the runs of ``cell``.
                listed = np.where(cell == home[i], near.sum(1)[i], 0)
                visits = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(listed)].astype(np.int32)), pa.array(cell.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[at][i]), pa.array(copies[at][i]), pa.array(np.full(len(i), dim, np.int32)),
                        pa.array(cell.astype(np.int32)), pa.array(cell == home[i]), pa.array(home[i].astype(np.int32)), visits, pa.array([v.tobytes() for v in x[i]], pa.binary()),
                    ],
                    ["rep", "copies", "dim", "cell", "home", "at", "visits", "unit"],
                )

    return run


def _visited(own: pd.DataFrame, other: pd.DataFrame) -> np.ndarray:
    """For each pair, whether the vector of ``own`` visits the home of that of ``other``."""
    homes, place = np.unique(other["at"].to_numpy(), return_inverse=True)
    cells = np.concatenate(own["visits"].to_list())
    row = np.repeat(np.arange(len(own)), own["visits"].map(len).to_numpy())
    column = np.minimum(np.searchsorted(homes, cells), len(homes) - 1)
    same = homes[column] == cells
    visits = np.zeros((len(own), len(homes)), bool)
    visits[row[same], column[same]] = True
    return visits[:, place]


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """Links between the vectors at home in a block and those of another block of the same cell."""
    own, other = group[group["role"] == 0], group[group["role"] == 1]
    out = {"rep": [], "links": [], "joined": []}
    if len(own) and len(other):
        x, y = (np.frombuffer(b"".join(g["unit"]), np.float64).reshape(len(g), -1) for g in (own, other))
        a, b = own["rep"].to_numpy(), other["rep"].to_numpy()
        near = x @ y.T >= THRESHOLD
        near[a[:, None] == b[None, :]] = False
        links = near @ other["copies"].to_numpy()
        # The cell of such a visitor never sees the vector at home.
        unseen = own["copies"].to_numpy() @ (near & ~_visited(own, other))
        # Smallest names spread along the links until nothing changes: a forest of the block, not its pairs.
        most = np.iinfo(np.int64).max
        la, lb = a.copy(), b.copy()
        while True:
            na = np.minimum(la, np.where(near, lb[None, :], most).min(1))
            nb = np.minimum(lb, np.where(near, na[:, None], most).min(0))
            if (na == la).all() and (nb == lb).all():
                break
            la, lb = na, nb
        out["rep"] = np.concatenate((a, b[near.any(0)]))
        out["links"] = np.concatenate((links, unseen[near.any(0)]))
        out["joined"] = np.concatenate((la, lb[near.any(0)]))
    return pd.DataFrame(out).astype({"rep": "int64", "links": "int64", "joined": "int64"})


def near_duplicates(
    spark: SparkSession,
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    reach: float = REACH,
    per_cell: int = PER_CELL,
    block: int = BLOCK,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of each row; ``reach`` is a half at least."""
    if reach < 0.5:
        raise ValueError("a reach of less than a half misses links")
    rows = identified(spark, vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")))
    sound = (
        "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        " AND exists(embedding, x -> x <> 0)"
    )
    valid = rows.where(F.coalesce(F.expr(sound), F.lit(False)))
    classes = valid.groupBy("embedding").agg(F.min(ROW).alias("rep"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = materialize(spark, classes.withColumn("dim", F.size("embedding")), "classes")
    centres = fit_cells(spark, classes, per_cell)
    margin = reach * float(np.sqrt(2 - 2 * THRESHOLD))
    placed = classes.select("rep", "copies", "dim", "embedding").mapInArrow(
        _assigner(centres, margin), "rep bigint, copies bigint, dim int, cell int, home boolean, at int, visits array<int>, unit binary"
    )
    placed = materialize(spark, placed, "placed")
    # One row for each cell; the number of cells is bounded.
    sizes = placed.groupBy("dim", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / block).cast("int").alias("own"), F.ceil(F.count("*") / block).cast("int").alias("all")
    )
    dealt = placed.join(F.broadcast(sizes.where("own > 0")), ["dim", "cell"])
    picked = F.pmod(F.xxhash64("rep"), F.lit(1 << 30))
    columns = ["dim", "cell", "rep", "copies", "at", "visits", "unit"]
    homes = dealt.where("home").select(
        *columns, F.lit(0).alias("role"), (picked % F.col("own")).cast("int").alias("i"), F.explode(F.expr("sequence(0, all - 1)")).alias("j")
    )
    others = dealt.select(
        *columns, F.lit(1).alias("role"), F.explode(F.expr("sequence(0, own - 1)")).alias("i"), (picked % F.col("all")).cast("int").alias("j")
    )
    compared = (
        homes.unionByName(others.select(homes.columns))
        .groupBy("dim", "cell", "i", "j")
        .applyInPandas(_compare, "rep bigint, links bigint, joined bigint")
    )
    compared = materialize(spark, compared, "compared")
    counts = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    known = components(spark, compared.select(F.col("rep").alias("a"), F.col("joined").alias("b")))
    named = classes.select("rep", "copies", "least", "embedding").join(
        known.select(F.col("node").alias("rep"), "component"), "rep", "left"
    ).withColumn("component", F.coalesce("component", "rep"))
    named = materialize(spark, named.join(counts, "rep", "left"), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = named.join(least, "component").select(
        F.col("embedding").alias("own"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    matched = valid.join(facts, F.col("embedding") == F.col("own")).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(F.expr(sound), F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return matched.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
