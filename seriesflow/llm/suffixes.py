"""Removal of repeated byte strings with a hash-compared suffix sort.

A byte goes if a string of ``SPAN`` bytes that covers it starts anywhere else, too. Every string of ``SPAN`` bytes is
given to one anchor: the leftmost substring of ``CORE`` bytes in it with the smallest hash. That depends on the
string alone, so equal strings have equal anchors at equal places; only suffixes that start at equal anchors need be compared, and the strings of an anchor form one region of the text.

1. Each document gives its anchors with the hashes of core and region. Cores that occur once are done.
2. Regions that occur twice or more are repeated as a whole; counting hashes finds them, however often they occur.
   A region counts as equal by 192 bits: the hash of its core and an independent one of 128 bits of all its bytes.
3. Regions that occur once, though their core is repeated, lie at the edge of a repeated passage. They and one
   example of every repeated region of their core are sorted by the bytes from the core on, and by the bytes before
   it read backwards. The sort is a merge sort whose comparisons find the length of the common extension by binary
   search over prefix polynomial hashes; the extensions of neighbours are then checked byte by byte. Two regions share
   a string if their common extensions to both sides suffice.
4. A core with more than ``MOST`` different regions isn't gathered: its strings are counted one by one by a hash of
   128 bits, spread over the cluster.

Null texts are empty; a text of fewer than ``SPAN`` bytes loses nothing. Rows with equal ids stay apart and count as
repetitions of each other. Matches never cross documents; strings are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm.common import ROW, materialize, stored
from seriesflow.llm.near_dups import mix

SPAN, CORE = 200, 40
#: Starts of strings that one anchor can have.
STARTS = SPAN - CORE + 1
#: Most different regions of a core that are sorted in one task.
MOST = 20_000
#: Bytes of documents whose anchors are found together.
PART = 1 << 21

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def byte_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


_TABLE = byte_table(3)


class PrefixHashes:
    """Polynomial hashes modulo 2^64 of all substrings of a byte array."""

    def __init__(self, data: np.ndarray, table: np.ndarray = _TABLE) -> None:
        n = len(data)
        power = np.full(n + 1, _BASE)
        power[0] = 1
        power = np.multiply.accumulate(power)
        self.inverse = np.full(n + 1, _INVERSE)
        self.inverse[0] = 1
        self.inverse = np.multiply.accumulate(self.inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]

    def cores(self, length: int) -> np.ndarray:
        """Hashes of all substrings of one length."""
        return (self.sums[length:] - self.sums[:-length]) * self.inverse[: len(self.sums) - length]


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For each anchor: place of its text, first start, number of starts, offset of the core from the first start,
    hash of the core, both halves of the hash of the region."""
    import xxhash

    sizes = np.array([len(t) for t in texts], np.int64)
    data = b"".join(texts)
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return (none,) * 7
    hashes = PrefixHashes(np.frombuffer(data, np.uint8)).cores(CORE)
    hashes = mix(hashes)
    # The leftmost core with the smallest hash of each string: what else is in the batch has no say in it.
    low, core = hashes, np.arange(len(hashes))
    width = 1
    while width < STARTS:
        shift = min(width, STARTS - width)
        later = low[shift:] < low[:-shift]
        low, core = np.where(later, low[shift:], low[:-shift]), np.where(later, core[shift:], core[:-shift])
        width += shift
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(core)]
    start = np.arange(len(core))
    inside = start + SPAN <= ends[owner]
    start, core, owner = start[inside], core[inside], owner[inside]
    if not len(start):
        return (none,) * 7
    new = np.flatnonzero(np.r_[True, (core[1:] != core[:-1]) | (owner[1:] != owner[:-1])])
    first, count, core, owner = start[new], np.diff(np.r_[new, len(start)]), core[new], owner[new]
    offset = core - first
    digest = xxhash.xxh3_128_digest
    regions = np.frombuffer(
        b"".join(digest(data[s : s + n], o) for s, n, o in zip(first.tolist(), (count + SPAN - 1).tolist(), offset.tolist(), strict=True)),
        np.int64,
    ).reshape(-1, 2)
    return owner, first - (ends - sizes)[owner], count, offset, hashes[core].view(np.int64), regions[:, 0], regions[:, 1]


def _batched(rows: list[int], texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Rows, offsets and bytes of some ``PART`` bytes; a longer text comes in pieces that share ``SPAN`` - 1 bytes."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for row, text in zip(rows, texts, strict=True):
        for at in range(0, max(1, len(text) - SPAN + 1), PART):
            piece = text[at : at + PART + SPAN - 1]
            if held and size + len(piece) > PART + SPAN:
                yield np.array([h[0] for h in held]), np.array([h[1] for h in held]), [h[2] for h in held]
                held, size = [], 0
            held.append((row, at, piece))
            size += len(piece)
    if held:
        yield np.array([h[0] for h in held]), np.array([h[1] for h in held]), [h[2] for h in held]


# Place of a region in its document: first start, number of starts and offset of the core in one number.
def _pack(first: np.ndarray, count: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return first << 16 | count << 8 | offset


def _unpack(place: int) -> tuple[int, int, int]:
    return place >> 16, place >> 8 & 255, place & 255


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        for rows, at, part in _batched(batch.column(ROW).to_pylist(), texts):
            owner, first, count, offset, core, region, check = anchors(part)
            arrays = [rows[owner], _pack(at[owner] + first, count, offset), core, region, check]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], [ROW, "place", "core", "region", "check"])


def _flat(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices of all given ranges, one after the other."""
    shift = np.repeat(start - (np.cumsum(length) - length), length)
    return np.arange(int(length.sum())) + shift


def suffix_order(data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of byte strings within their groups, and each one's common extension with the one before it.

    ``group`` is in order. The extension is -1 at the first of a group.
    """
    n = len(start)
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[heads, n])
    begin, size = np.repeat(heads, sizes), np.repeat(sizes, sizes)
    seed = 3
    while True:
        hashes = PrefixHashes(data, byte_table(seed))

        def common(x: np.ndarray, y: np.ndarray, hashes: PrefixHashes = hashes) -> np.ndarray:
            low, high = np.zeros(len(x), np.int64), np.minimum(length[x], length[y])
            while (low < high).any():
                mid = (low + high + 1) // 2
                same = hashes.of(start[x], mid) == hashes.of(start[y], mid)
                low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
            return low

        def compared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            """Below, at or above 0 as x sorts before, with or behind y."""
            k = common(x, y)
            end_x, end_y = k == length[x], k == length[y]
            a = np.where(end_x, -1, data[np.minimum(start[x] + k, len(data) - 1)].astype(np.int64))
            b = np.where(end_y, -1, data[np.minimum(start[y] + k, len(data) - 1)].astype(np.int64))
            return a - b

        order, run = np.arange(n), 1
        while n and run < sizes.max():
            at = np.flatnonzero(size > run)
            local = at - begin[at]
            number = local // run
            sibling = begin[at] + (number ^ 1) * run
            end = np.minimum(sibling + run, begin[at] + size[at])
            has = sibling < begin[at] + size[at]
            at, local, number, sibling, end = at[has], local[has], number[has], sibling[has], end[has]
            low, high, right = sibling.copy(), end.copy(), number % 2 == 1
            while (live := np.flatnonzero(low < high)).size:
                mid = (low[live] + high[live]) // 2
                c = compared(order[mid], order[at[live]])
                further = (c < 0) | ((c == 0) & right[live])
                low[live] = np.where(further, mid + 1, low[live])
                high[live] = np.where(further, high[live], mid)
            target = begin[at] + number // 2 * 2 * run + (local - number * run) + (low - sibling)
            merged = order.copy()
            merged[target] = order[at]
            order, run = merged, run * 2
        lcp = np.full(n, -1)
        behind = np.flatnonzero(begin != np.arange(n))
        x, y = order[behind - 1], order[behind]
        lcp[behind] = common(x, y)
        # The bytes decide: a wrong extension means a collision, and another table is drawn.
        k = lcp[behind]
        equal = np.array_equal(data[_flat(start[x], k)], data[_flat(start[y], k)])
        more = (k < length[x]) & (k < length[y])
        if equal and (data[start[x][more] + k[more]] != data[start[y][more] + k[more]]).all():
            return order, lcp
        seed += 1


def shared_starts(regions: list[bytes], count: np.ndarray, offset: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each region and start: whether the string there occurs in another region of the group."""
    n = len(regions)
    lengths = np.array([len(r) for r in regions], np.int64)
    data = np.frombuffer(b"".join(regions), np.uint8)
    start = np.cumsum(lengths) - lengths
    right, right_lcp = suffix_order(data, start + offset, lengths - offset, group)
    ends = start + offset
    backwards = data[::-1]
    left, left_lcp = suffix_order(backwards, len(data) - ends, offset, group)
    flags = np.zeros((n, STARTS), bool)
    block_right, block_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for before in range(STARTS):
        own = np.flatnonzero((before <= offset) & (offset - before < count))
        if len(own) < 2:
            continue
        block_right[right] = np.cumsum(right_lcp < SPAN - before)
        block_left[left] = np.cumsum(left_lcp < before)
        key = block_right[own] * (n + 1) + block_left[own]
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        flags[own, offset[own] - before] = times[inverse] > 1
    return flags


def _cut_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [ROW, "place", "core", "n", "d", "bytes"]
    kinds = [pa.int64()] * 5 + [pa.binary()]
    for batch in batches:
        out: list[tuple] = []
        for r in batch.to_pylist():
            data = (r["text"] or "").encode()
            for w in r["wanted"]:
                first, count, _ = _unpack(w["place"])
                out.append((r[ROW], w["place"], w["core"], w["n"], w["d"], data[first : first + count + SPAN - 1]))
            if len(out) > 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _covers(batch: list[dict], flags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Covered ranges of the regions that occur once."""
    for r, own in zip(batch, flags, strict=True):
        if r["n"] == 1 and own.any():
            first, count, _ = _unpack(r["place"])
            edge = np.diff(np.r_[0, own[:count].astype(np.int8), 0])
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                yield r[ROW], first + a, first + b - 1 + SPAN


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []

    def solve(rows: list[dict]) -> pa.RecordBatch:
        _, group = np.unique(np.array([r["core"] for r in rows], np.int64), return_inverse=True)
        parts = np.array([_unpack(r["place"]) for r in rows], np.int64).reshape(-1, 3)
        flags = shared_starts([r["bytes"] for r in rows], parts[:, 1], parts[:, 2], group)
        found = list(_covers(rows, flags))
        columns = list(zip(*found, strict=True)) if found else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [ROW, "start", "stop"])

    for batch in batches:
        held += batch.to_pylist()
        if len(held) >= 8192:
            last = held[-1]["core"]
            done = [r for r in held if r["core"] != last]
            held = held[len(done) :]
            if done:
                yield solve(done)
    if held:
        yield solve(held)


def _string_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        for r in batch.to_pylist():
            first, count, _ = _unpack(r["place"])
            keys = [xxhash.xxh3_128_digest(r["bytes"][i : i + SPAN]) for i in range(count)]
            arrays = [pa.array(keys, pa.binary()), pa.array([r[ROW]] * count, pa.int64()), pa.array(range(first, first + count), pa.int64()), pa.array([r["n"]] * count, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", ROW, "start", "n"])


def covered(spark: SparkSession, docs: DataFrame, most: int = MOST) -> DataFrame:
    """``(__row, start, stop)``: byte ranges that repeated strings cover, for ``docs`` with ``__row`` and ``text``."""
    rows = docs.select(ROW, "text").mapInArrow(_anchor_rows, f"{ROW} bigint, place bigint, core bigint, region bigint, check bigint")
    # Counted by one more column than the key, so that the join has an exchange of its own and a hot core is split.
    repeated = rows.groupBy("core", F.xxhash64("core").alias("digest")).agg(F.count("*").alias("times")).where("times > 1").select("core")
    met = materialize(spark, rows.join(repeated, "core"), "anchors")
    kinds = met.groupBy("core", "region", "check").agg(F.count("*").alias("n"), F.min(F.struct(ROW, "place")).alias("example"))
    kinds = materialize(spark, kinds, "regions")
    whole = met.join(kinds.where("n > 1").select("core", "region", "check"), ["core", "region", "check"]).selectExpr(
        ROW, "shiftright(place, 16) AS start", f"shiftright(place, 16) + (shiftright(place, 8) & 255) + {SPAN - 1} AS stop"
    )
    mixed = kinds.groupBy("core").agg(F.count("*").alias("d"), F.min("n").alias("least")).where("d > 1 AND least = 1").select("core", "d")
    wanted = (
        kinds.join(mixed, "core")
        .groupBy(F.col(f"example.{ROW}").alias(ROW))
        .agg(F.collect_list(F.struct(F.col("example.place").alias("place"), "core", "n", "d")).alias("wanted"))
    )
    cut = docs.select(ROW, "text").join(materialize(spark, wanted, "wanted"), ROW).mapInArrow(
        _cut_regions, f"{ROW} bigint, place bigint, core bigint, n bigint, d bigint, bytes binary"
    )
    cut = materialize(spark, cut, "cut")
    edges = (
        cut.where(F.col("d") <= most).repartition("core").sortWithinPartitions("core").mapInArrow(_sort_groups, f"{ROW} bigint, start bigint, stop bigint")
    )
    strings = cut.where(F.col("d") > most).mapInArrow(_string_hashes, f"key binary, {ROW} bigint, start bigint, n bigint")
    # At least one example of a string that occurs in several regions; the others hold it, too.
    counts = strings.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key")
    single = strings.where("n = 1").join(counts, "key").select(ROW, "start", (F.col("start") + SPAN).alias("stop"))
    return whole.unionByName(edges).unionByName(single)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed, spans = [], [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            data = (text or "").encode()
            out, at, gone, runs = [], 0, 0, 0
            for start, stop in sorted((r["start"], r["stop"]) for r in ranges or ()):
                if start > at or not runs:
                    out.append(data[at:start])
                    gone += stop - start
                    runs += 1
                elif stop > at:
                    gone += stop - at
                at = max(at, stop)
            out.append(data[at:])
            kept.append(b"".join(out))
            removed.append(gone)
            spans.append(runs)
        rest = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in ("text", "ranges")]
        names = [n for n in batch.schema.names if n not in ("text", "ranges")]
        sizes = [len(k) + g for k, g in zip(kept, removed, strict=True)]
        new = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays([*rest, *new], names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """``(__row, doc_id, n_bytes, n_removed, n_spans, kept)``: ``kept`` holds the remaining bytes of each document."""
    docs = stored(spark, docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    ranges = covered(spark, docs, most).groupBy(ROW).agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    ranges = materialize(spark, ranges, "ranges")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.join(ranges, ROW, "left").mapInArrow(
        _removed, f"{ROW} bigint, doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def removed_brute_force(texts: list[bytes], span: int = SPAN) -> list[tuple[int, int, str]]:
    """For tests: removed bytes, runs and digest of the rest, by looking every string up."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - span + 1):
            seen[t[i : i + span]] = seen.get(t[i : i + span], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                gone[i : i + span] = True
        runs = int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())
        rest = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out
