"""Periodic runs: stretches of words that repeat with a period, as often as a given exponent.

Kruskal's way of uniting suffix classes: the suffixes of a document's words are sorted, and neighbours are united by
decreasing common prefix. A class holds its positions in order. When two classes meet at common prefix L, positions
that become neighbours in the united class, d apart, agree for exactly L words; with d <= L that seeds a run of period
d, and every run of exponent 2 or more is seeded at its own start, since no position between two starts of the same
run can share so long a prefix with them. A seed whose word before agrees, too, lies inside a run seeded already.

A run of at least ``length`` words and ``exponent`` periods needs L >= max((exponent - 1) * d, length - d), so only
words whose next ``least`` words occur again in the document are sorted at all. Smaller position sets are merged into
larger ones, so a document of n such words takes n log n steps, whatever its structure. Texts go one by one: nothing
is gathered over documents.

A word is a run of bytes other than blank and the controls 9 to 13. A null or empty text has no words and no runs.
Equal ids are rows of their own. Columns other than id and text are dropped; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH, EXPONENT = 24, 3
#: Bytes of texts whose words are numbered together; a longer text goes alone.
PART_BYTES = 1 << 21

#: Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"

#: Positions in one piece of an ordered set.
_PIECE = 512


class Positions:
    """An ordered set of positions in pieces of bounded size, so that an insertion moves few of them."""

    def __init__(self, position: int) -> None:
        self.pieces = [[position]]
        self.last = [position]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for piece in self.pieces:
            yield from piece

    def add(self, position: int) -> tuple[int, int]:
        """Insert a position; its neighbours, -1 where there is none."""
        self.size += 1
        k = min(bisect_left(self.last, position), len(self.pieces) - 1)
        piece = self.pieces[k]
        i = bisect_left(piece, position)
        if i:
            before = piece[i - 1]
        else:
            before = self.last[k - 1] if k else -1
        after = piece[i] if i < len(piece) else -1
        piece.insert(i, position)
        if len(piece) > 2 * _PIECE:
            self.pieces[k : k + 1] = [piece[:_PIECE], piece[_PIECE:]]
            self.last[k : k + 1] = [piece[_PIECE - 1], piece[-1]]
        else:
            self.last[k] = piece[-1]
        return before, after


def least_prefix(length: int, exponent: int) -> int:
    """The shortest common prefix of two starts of a run."""
    return min(max((exponent - 1) * d, length - d) for d in range(1, length + 1))


def repeated_starts(words: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """The positions whose next ``least`` words occur again in the same text. May hold others on equal hashes."""
    if len(words) <= least:
        return np.zeros(0, np.int64)
    seeds = np.random.default_rng(least).integers(1, 1 << 63, least + 1, dtype=np.uint64) | np.uint64(1)
    mixed = (words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    size = len(words) - least + 1
    hashes = owner[:size].astype(np.uint64) * seeds[least]
    for k in range(least):
        hashes += mixed[k : k + size] * seeds[k]
    inside = np.flatnonzero(owner[:size] == owner[least - 1 :])
    hashes = hashes[inside]
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    return np.sort(inside[order[np.r_[same, False] | np.r_[False, same]]]) if len(order) else inside


def _ranked(first: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, bool]:
    """Ranks of pairs, equal for equal ones; whether all differ."""
    order = np.argsort(first, kind="stable") if second is None else np.lexsort((second, first))
    new = first[order][1:] != first[order][:-1]
    if second is not None:
        new |= second[order][1:] != second[order][:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.r_[0, np.cumsum(new)]
    return ranks, bool(new.all())


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes, by prefix doubling, and each one's common prefix with the one before it."""
    n = len(words)
    ranks, done = _ranked(words)
    width = 1
    while not done:
        behind = np.full(n, -1, np.int64)
        behind[: n - width] = ranks[width:]
        ranks, done = _ranked(ranks, behind)
        width *= 2
    order = np.empty(n, np.int64)
    order[ranks] = np.arange(n)
    # From one position to the next the common prefix shrinks by one at most.
    text, place, lcp, common = words.tolist(), ranks.tolist(), [0] * n, 0
    before = np.r_[-1, order[:-1]].tolist()
    for i in range(n):
        j = before[place[i]]
        if j < 0:
            common = 0
            continue
        top = n - max(i, j)
        while common < top and text[i + common] == text[j + common]:
            common += 1
        lcp[place[i]] = common
        common = max(0, common - 1)
    return order, np.array(lcp, np.int64)


def runs_at(words: np.ndarray, starts: np.ndarray, length: int, exponent: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a text, by start and period, from its repeated starts."""
    least = least_prefix(length, exponent)
    if not len(starts):
        return []
    # Stretches of such starts with the words that belong to them, and a word of its own behind each.
    head = np.flatnonzero(np.r_[True, starts[1:] - starts[:-1] > least])
    first, stop = starts[head], np.r_[starts[head[1:] - 1], starts[-1]] + least
    sizes = stop - first + 1
    cut = np.cumsum(sizes)
    origin = np.arange(int(cut[-1])) + np.repeat(first - (cut - sizes), sizes)
    part = words[np.minimum(origin, len(words) - 1)]
    part[cut - 1] = int(words.max()) + 1 + np.arange(len(cut))
    order, lcp = suffix_order(part)
    classes: dict[int, int] = {}
    members: dict[int, Positions] = {}

    def root(i: int) -> int:
        while (up := classes.get(i, i)) != i:
            classes[i] = i = classes.get(up, up)
        return i

    found = []
    where, text, order_list = origin.tolist(), words.tolist(), order.tolist()

    def seed(i: int, j: int, common: int) -> None:
        d = j - i
        if 0 <= i < j and common >= (exponent - 1) * d and d + common >= length and (not i or text[i - 1] != text[j - 1]):
            found.append((i, d + common, d))

    by_prefix = np.argsort(-lcp, kind="stable")
    by_prefix = by_prefix[lcp[by_prefix] >= least]
    for k, common in zip(by_prefix.tolist(), lcp[by_prefix].tolist(), strict=True):
        x, y = root(order_list[k - 1]), root(order_list[k])
        large, small = members.pop(x, None) or Positions(where[x]), members.pop(y, None) or Positions(where[y])
        if large.size < small.size:
            large, small, x, y = small, large, y, x
        classes[y] = x
        # In ascending order the place before a new position is settled at once, the one behind it by the next.
        previous, pending = -1, -1
        for position in small:
            before, after = large.add(position)
            if before != previous or previous < 0:
                seed(previous, pending, common)
                seed(before, position, common)
            previous, pending = position, after
        seed(previous, pending, common)
        members[x] = large
    return sorted(found)


def runs_of_texts(texts: list[list], length: int = LENGTH, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    numbers: dict = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    starts = repeated_starts(words, owner, least_prefix(length, exponent))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    begin = np.cumsum(sizes) - sizes
    of = owner[starts]
    cuts = np.r_[np.flatnonzero(np.diff(of, prepend=-1)), len(of)]
    for head, stop in zip(cuts[:-1], cuts[1:], strict=True):
        i = int(of[head])
        own = slice(begin[i], begin[i] + sizes[i])
        out[i] = runs_at(words[own], starts[head:stop] - begin[i], length, exponent)
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods; the smallest start, then period, among equals."""
    return min(runs, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=None)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without the repetitions: of each run the first period stays."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(drop)[:-1] == 0).tolist()])


_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _struct(run: tuple[int, int, int] | None) -> dict | None:
    return run and dict(zip(("start", "length", "period"), run, strict=True))


def _searched(length: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            begin = size = 0
            for i in range(len(texts) + 1):
                if i < len(texts) and (i == begin or size + len(texts[i]) <= PART_BYTES):
                    size += len(texts[i])
                    continue
                if i == begin:
                    continue
                # Splitting bytes cuts at blanks and the controls 9 to 13, at nothing else.
                words = [t.split() for t in texts[begin:i]]
                runs = runs_of_texts(words, length, exponent)
                arrays = [
                    batch.column("doc_id").slice(begin, i - begin),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[_struct(r) for r in found] for found in runs], pa.list_(_RUN)),
                    pa.array([_struct(strongest(found)) for found in runs], _RUN),
                    pa.array([collapsed(w, found) for w, found in zip(words, runs, strict=True)], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "strongest", "collapsed"])
                begin, size = i, len(texts[i]) if i < len(texts) else 0

    return run


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """``(doc_id, n_words, runs, strongest, collapsed)`` of each row of ``docs``.

    ``runs`` are ``(start, length, period)`` in words, by start and period; ``strongest`` is the one with the greatest
    length / period, null without runs; ``collapsed`` is the text's words, joined by blanks, with each run's first
    period only.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    run = "struct<start:bigint,length:bigint,period:bigint>"
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, runs array<{run}>, strongest {run}, collapsed string"
    return docs.mapInArrow(_searched(length, exponent), schema)
