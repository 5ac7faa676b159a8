"""Near-duplicate documents by DartMinHash signatures and banded joins.

A document is the multiset of its shingles of five words; similarity is weighted Jaccard over it, and documents link
from ``THRESHOLD`` on. Each occurrence of a shingle is a region of weight one at which hashed darts are thrown: a
Poisson process in time, the same for every document that has the region. Each dart belongs to one of ``K``
coordinates, and the earliest dart of a coordinate is its value, so that two documents agree in a coordinate with
probability equal to their similarity. Only some K ln K darts are thrown, whatever the number of shingles.

Documents of the same words are one class from the start and have one representative. Bands of a signature meet in
buckets. A bucket isn't expanded into pairs: its members are compared with one centre, then those that are still in
different components with the next one, and what is left after ``ROUNDS`` centres block by block inside tasks, which
hand on only the links that join something (``within_cells``). Every comparison is
exact, on the texts; the signatures tell beforehand which pairs are far from similar. Linked documents are one class; each row gets the class and one row of a class is kept.

Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. A text of one to four words is one
shingle; one without words is its own shingle, so equal ones are copies. Null texts link with nothing. Rows with
equal ids stay apart; a class is named by its smallest id. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm.common import ROW, components, materialize, numbered, release, stored, worker_store

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS_PER_BAND = 24, 5
K = BANDS * ROWS_PER_BAND
ROUNDS = 2
#: Members of a bucket, and bytes of their texts, that a block holds on average in the comparison after ``ROUNDS`` centres.
BLOCK, BLOCK_BYTES = 512, 8 << 20
#: Equal coordinates, by one byte each, below which a pair is not looked at: a similarity of THRESHOLD gives 96 of 120,
#: with a deviation of 4.4, so 66 is some seven deviations below.
LEAST_EQUAL = 66
#: Columns of a pair: two rows and the classes that they belong to so far.
PAIR = ["a", "b", "label_a", "label_b"]

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)
_BYTES = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTES[0] = 0
_known_places = np.zeros(0, np.uint64)

#: What a byte counts as in a word: digits, letters in lower case and bytes beyond ASCII; zero for what separates words.
_FORMS = np.arange(256, dtype=np.uint8)
_FORMS[0x41:0x5B] += 0x20
for _low, _high in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
    _FORMS[_low:_high] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def normalised(text: bytes) -> np.ndarray:
    """The words of a UTF-8 text, one zero byte between two; nothing for a text without words."""
    forms = _FORMS[np.frombuffer(text, np.uint8)]
    inside = forms != 0
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    kept = forms[keep]
    return kept[:-1] if len(kept) and not kept[-1] else kept


def _places(n: int) -> np.ndarray:
    """An odd factor for each place of a byte in its word."""
    global _known_places
    if len(_known_places) < n:
        _known_places = mix(_GOLD * np.arange(1, 2 * n + 1, dtype=np.uint64)) | _U(1)
    return _known_places


def word_hashes(kept: np.ndarray) -> np.ndarray:
    """A hash of each word of a normalised text that has any."""
    starts = np.concatenate([[0], np.flatnonzero(kept == 0) + 1])
    lengths = np.diff(starts, append=len(kept))
    place = np.arange(len(kept)) - np.repeat(starts, lengths)
    return mix(np.add.reduceat(_BYTES[kept] * _places(int(lengths.max()))[place], starts))


def shingles(text: bytes, kept: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the shingles of a UTF-8 text."""
    kept = normalised(text) if kept is None else kept
    if not len(kept):
        import xxhash

        return np.array([xxhash.xxh3_64_intdigest(text)], np.uint64)
    h = word_hashes(kept)
    n = min(SHINGLE, len(h))
    return mix(sum(h[j : len(h) - n + 1 + j] * _FACTORS[j] for j in range(n)) + _U(n))


def dart_signature(elements: np.ndarray, weights: np.ndarray, k: int = K) -> np.ndarray:
    """The earliest dart of each coordinate for elements with positive weights."""
    cells = np.ceil(weights).astype(np.int64)
    whole = bool((cells == weights).all())
    owner = np.repeat(np.arange(len(elements)), cells)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    region = mix(elements[owner] + _GOLD * (place + 1).astype(np.uint64))
    covered = np.minimum(weights[owner] - place, 1.0)
    until = (math.log(k) + 2) * k / weights.sum()
    while True:
        times, names = [], []
        live, clock, throw = np.arange(len(region)), np.zeros(len(region)), 0
        many = int(until + 4 * math.sqrt(until) + 2)
        while len(live):
            numbers = np.arange(throw, throw + many, dtype=np.uint64) + _U(1)
            dart = mix(region[live][:, None] + _GOLD * numbers[None, :])
            gap = -np.log(((dart >> _U(11)).astype(np.float64) + 1) * 2.0**-53)
            at = clock[live][:, None] + np.cumsum(gap, 1)
            dart = mix(dart)
            hit = at <= until
            if not whole:
                # A region of less than weight one catches the darts that fall on its part.
                hit &= (dart >> _U(40)).astype(np.float64) * 2.0**-24 < covered[live][:, None]
            times.append(at[hit])
            names.append(dart[hit])
            clock[live] = at[:, -1]
            live = live[at[:, -1] <= until]
            throw += many
        t, d = np.concatenate(times), np.concatenate(names)
        # The last one assigned to a coordinate stays, so the earliest goes last.
        d = d[np.argsort(t, kind="stable")[::-1]]
        coordinates = (d & _U((1 << 40) - 1)) % _U(k)
        earliest, caught = np.zeros(k, np.uint64), np.zeros(k, bool)
        earliest[coordinates], caught[coordinates] = d, True
        if caught.all():
            return earliest
        until *= 2


def _weighted(text: bytes, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    elements, counts = np.unique(shingles(text, kept), return_counts=True)
    return elements, counts.astype(np.float64)


def bands_of(signature: np.ndarray) -> np.ndarray:
    salted = mix((signature.reshape(BANDS, ROWS_PER_BAND) * _FACTORS[:ROWS_PER_BAND]).sum(1) + np.arange(BANDS, dtype=np.uint64))
    return salted.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two multisets of shingles, each as sorted values and counts."""
    _, i, j = np.intersect1d(a[0], b[0], True, True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_store("near_dups")
    for batch in batches:
        keys, sizes, bands, coordinates = [], [], [], []
        for row, text in zip(batch.column(ROW).to_pylist(), batch.column("text").to_pylist(), strict=True):
            if text is None:
                keys.append(hashlib.sha256(b"\r%d" % row).hexdigest())
                sizes.append(0)
                bands.append([])
                coordinates.append(b"")
                continue
            kept = normalised(text)
            # Normalised texts have no line break, so texts with words and without never have the same key.
            keys.append(hashlib.sha256(kept.tobytes() if len(kept) else b"\n" + text).hexdigest())
            elements, weights = _weighted(text, kept)
            signature = dart_signature(elements, weights)
            sizes.append(int(weights.sum()))
            bands.append(bands_of(signature))
            # One byte of each coordinate is enough to estimate by.
            coordinates.append((mix(signature) >> _U(56)).astype(np.uint8).tobytes())
        signed = [pa.array(keys, pa.string()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(coordinates, pa.binary())]
        names = [ROW, "doc_id", "key", "size", "bands", "coordinates"]
        yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), *signed], names)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_store("near_dups")
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, K) for c in ("coordinates_a", "coordinates_b"))
        keep = pa.array((a == b).sum(1) >= LEAST_EQUAL)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in PAIR], PAIR)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_store("near_dups")
    kept: dict[int, tuple] = {}

    def bag(row: int, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        if row not in kept:
            if len(kept) > 256:
                kept.clear()
            kept[row] = np.unique(shingles(text), return_counts=True)
        return kept[row]

    for batch in batches:
        r = batch.to_pydict()
        keep = [
            similarity(bag(a, x), bag(b, y)) >= THRESHOLD
            for a, b, x, y in zip(r["a"], r["b"], r["text_a"], r["text_b"], strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in PAIR], PAIR)


def _both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """``pairs`` with ``column`` of both rows. A row with very many partners is split by the join.

    The table grows with the input, so it is not left to its size in a small run whether it is broadcast.
    """
    left = table.select(F.col(ROW).alias("a"), F.col(column).alias(f"{column}_a")).hint("merge")
    right = table.select(F.col(ROW).alias("b"), F.col(column).alias(f"{column}_b")).hint("merge")
    return pairs.join(left, "a").join(right, "b").select(*PAIR, f"{column}_a", f"{column}_b")


def verified(pairs: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts are similar. Signatures sort out most of the others before a text is fetched."""
    schema = ", ".join(f"{c} bigint" for c in PAIR)
    likely = _both(pairs, signed, "coordinates").mapInArrow(_likely, schema)
    return _both(likely, texts, "text").mapInArrow(_verified, schema)


#: Sizes of documents that can link: the smaller one has at least THRESHOLD of the larger one's shingles.
def _comparable(a: str, b: str) -> str:
    return f"least({a}, {b}) >= {THRESHOLD} * greatest({a}, {b})"


def _regions(text: bytes) -> np.ndarray:
    """The multiset of shingles as a sorted set: one number for each occurrence."""
    elements, counts = np.unique(shingles(text), return_counts=True)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(mix(np.repeat(elements, counts) + _GOLD * (place + 1).astype(np.uint64)))


def _linked_in_cell(bucket: int, cell: list[dict]) -> list[tuple]:
    """Links of a cell that join all that its links join: at most one for each member."""
    same_block = cell[0]["low"] == cell[0]["high"]
    bands = np.array([m["bands"] for m in cell], np.int64)
    coordinates = np.frombuffer(b"".join(m["coordinates"] for m in cell), np.uint8).reshape(-1, K)
    sizes, labels, blocks = (np.array([m[c] for m in cell], np.int64) for c in ("size", "label", "block"))
    roots, regions, out = labels.copy(), {}, []

    def region(i: int) -> np.ndarray:
        if i not in regions:
            regions[i] = _regions(cell[i]["text"])
        return regions[i]

    for i in range(len(cell)):
        others = np.arange(i + 1, len(cell)) if same_block else np.flatnonzero(blocks > blocks[i])
        others = others[roots[others] != roots[i]]
        others = others[np.minimum(sizes[others], sizes[i]) >= THRESHOLD * np.maximum(sizes[others], sizes[i])]
        others = others[(coordinates[others] == coordinates[i]).sum(1) >= LEAST_EQUAL]
        # A pair that meets in several buckets is taken from the first of them.
        others = others[bands[i][(bands[others] == bands[i]).argmax(1)] == bucket]
        if not len(others):
            continue
        own, theirs = region(i), [region(j) for j in others]
        numbers = np.concatenate(theirs)
        at = np.minimum(np.searchsorted(own, numbers), len(own) - 1)
        starts = np.cumsum([0, *(len(r) for r in theirs[:-1])])
        common = np.add.reduceat((own[at] == numbers).astype(np.int64), starts)
        near = others[common / (sizes[others] + sizes[i] - common) >= THRESHOLD]
        joined, first = np.unique(roots[near], return_index=True)
        out += [(cell[i][ROW], cell[j][ROW], cell[i]["label"], cell[j]["label"]) for j in near[first]]
        roots[np.isin(roots, joined)] = roots[i]
    return out


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_store("near_dups")
    key, cell = None, []

    def links_of(cell: list[dict]) -> pa.RecordBatch:
        columns = list(zip(*_linked_in_cell(key[0], cell), strict=True)) or [()] * len(PAIR)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], PAIR)

    for batch in batches:
        for member in batch.to_pylist():
            now = (member["bucket"], member["low"], member["high"])
            if now != key:
                if cell:
                    yield links_of(cell)
                key, cell = now, []
            cell.append(member)
    if cell:
        yield links_of(cell)


def within_cells(open_rows: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the members of each bucket, all of them compared, without a row for each pair.

    A bucket is dealt into blocks of some ``BLOCK`` members or ``BLOCK_BYTES`` of text, and each two blocks, or one with itself, are a cell. A
    task holds one cell at a time, sorts out its pairs by their signatures and compares the others exactly.
    """
    whole = open_rows.select("bucket", ROW, "label", "size").join(signed.select(ROW, "bands", "coordinates").hint("merge"), ROW)
    whole = whole.join(texts.hint("merge"), ROW)
    many = whole.groupBy("bucket", F.xxhash64("bucket").alias("digest")).agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    dealt = whole.join(many.drop("digest"), "bucket").withColumn("block", F.pmod(F.xxhash64(ROW), "blocks").cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", ROW, "label", "size", "bands", "coordinates", "text",
    )
    cells = met.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", ROW)
    return cells.mapInArrow(_cells, ", ".join(f"{c} bigint" for c in PAIR))


def links(spark: SparkSession, signed: DataFrame, docs: DataFrame) -> DataFrame:
    """``(node, component)`` of the ``signed`` representatives that are similar to others; ``docs`` has their texts."""
    bands = signed.select(ROW, "size", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket", F.xxhash64("bucket").alias("digest")).agg(F.count("*").alias("n")).where("n > 1")
    met = materialize(spark, bands.join(shared.drop("digest").hint("merge"), "bucket"), "met")
    # A document that meets many others makes the better centre.
    ranks = met.groupBy(ROW).agg(F.sum("n").alias("rank"))
    labelled = met.join(ranks.hint("merge"), ROW).drop("n").withColumn("label", F.col(ROW))
    texts = materialize(spark, docs.select(ROW, "text").join(met.select(ROW).distinct().hint("merge"), ROW), "texts")
    found: list[DataFrame] = []
    former = met
    for turn in range(ROUNDS + 1):
        groups = labelled.groupBy("bucket").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.struct("rank", (-F.col(ROW)).alias("r"))).alias("c")
        )
        centres = groups.where("low < high").select("bucket", (-F.col("c.r")).alias("centre"))
        open_rows = materialize(spark, labelled.join(centres, "bucket"), "open")
        if turn < 2:
            # The first of these are the large ones.
            release(spark, former)
        former = open_rows
        if open_rows.isEmpty():
            break
        if turn < ROUNDS:
            centre = open_rows.where(F.col(ROW) == F.col("centre")).select(
                "bucket", F.col("label").alias("centre_label"), F.col("size").alias("centre_size")
            )
            pairs = (
                open_rows.join(centre, "bucket")
                .where(f"label <> centre_label AND {_comparable('size', 'centre_size')}")
                .select(F.col(ROW).alias("a"), F.col("centre").alias("b"), F.col("label").alias("label_a"), F.col("centre_label").alias("label_b"))
            )
        else:
            found.append(materialize(spark, within_cells(open_rows, signed, texts), "links"))
            break
        linked = materialize(spark, verified(pairs.distinct(), signed, texts), "links")
        found.append(linked)
        # Labels name the classes as far as known: each centre and what is linked to it take the least of their labels.
        # That only saves comparisons; the classes themselves are worked out from all links at the end.
        stars = linked.groupBy(F.col("label_b").alias("centre_label")).agg(F.least(F.min("label_a"), F.col("label_b")).alias("least"))
        united = (
            linked.join(stars, F.col("label_b") == F.col("centre_label"))
            .select(F.col("label_a").alias("label"), "least")
            .unionByName(stars.select(F.col("centre_label").alias("label"), "least"))
            .groupBy("label")
            .agg(F.min("least").alias("least"))
        )
        rest = open_rows.where(F.col(ROW) != F.col("centre")).drop("centre")
        labelled = rest.join(united, "label", "left").select(
            *(c for c in rest.columns if c != "label"), F.coalesce("least", "label").alias("label")
        )
    release(spark, former, texts)
    if not found:
        return spark.createDataFrame([], "node bigint, component bigint")
    return components(spark, reduce(DataFrame.unionByName, found).select("a", "b"))


def classes(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``__row, doc_id, class_id, class_size, kept``.

    ``row`` names a column of unique numbers of the rows, if ``docs`` has one that every scan reads alike.
    """
    own = [F.col(row).alias(ROW)] if row else []
    docs = docs.select(*own, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if not row:
        docs = stored(spark, docs)
    docs = docs.withColumn("text", F.col("text").cast("string").cast("binary"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = docs.mapInArrow(
        _signed, f"{ROW} bigint, doc_id {kind}, key string, size bigint, bands array<bigint>, coordinates binary"
    )
    signed = materialize(spark, signed, "signed")
    first = signed.groupBy("key", F.xxhash64("key").alias("digest")).agg(F.min(ROW).alias("rep")).drop("digest")
    members = materialize(spark, signed.select(ROW, "doc_id", "key").join(first.hint("merge"), "key").drop("key"), "members")
    singles = members.where(F.col(ROW) == F.col("rep")).select(ROW)
    alone = signed.join(singles.hint("merge"), ROW).where("size > 0").select(ROW, "size", "bands", "coordinates")
    alone = materialize(spark, alone, "representatives")
    release(spark, signed)
    known = links(spark, alone, docs.where(F.col("text").isNotNull()))
    release(spark, alone)
    labelled = members.join(known, members["rep"] == known["node"], "left").select(
        ROW, "doc_id", F.coalesce("component", "rep").alias("label")
    )
    labelled = materialize(spark, labelled, "labelled")
    release(spark, members, known)
    named = labelled.groupBy("label", F.xxhash64("label").alias("digest")).agg(
        F.min("doc_id").alias("class_id"),
        F.count("*").alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(ROW))).alias("first"),
    )
    return labelled.join(named.drop("digest"), "label").select(
        ROW, "doc_id", "class_id", "class_size", (F.col(ROW) == F.col("first")[ROW]).alias("kept")
    )


def keep_one(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class of near duplicates."""
    columns, docs, row = numbered(spark, docs)
    found = classes(spark, docs, doc_id, text, row)
    dropped = materialize(spark, found.where("NOT kept").select(F.col(ROW).alias(row)), "dropped")
    release(spark, found)
    return docs.join(dropped, row, "left_anti").select(*columns)
