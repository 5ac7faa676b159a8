"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes, and in how many documents.

Both tokenizers cut a text into tokens whose bytes join to the same string. Offsets where tokens of both sides end cut
it into groups; each token of a group is linked with every token of the other side in it. Pairs of ids are counted by
the documents that hold them linked, by external spill counting:

1. Map tasks encode and align a part of the documents at a time. A part's records (left id, right id, document, number
   of links) are sorted, radix-partitioned by the left id and written as zstd runs to the shared folder. A run keeps
   each pair once, with the number of its documents in the part (its head); the documents behind the heads, the
   postings, stay with the part. So a pair that all documents hold is one head for each part.
2. Runs of a radix are merged by a heap, ``FAN`` at a time, which sums the counts of each pair. The last merge is in
   the order of left ids, so that the highest count of each left id is found as it goes by.
3. The counts stream back: each run gets the counts of its heads, and each part adds them up along its postings.

A null or empty text has no tokens, nor has one whose joined tokens differ from the text: zeros and an empty digest.
Rows with equal ids are documents of their own; null ids are kept. Columns other than id and text are dropped. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm.common import materialize

#: Bytes and documents of a part; a longer document is a part of its own.
PART_BYTES, PART_DOCS = 1 << 21, 4096
#: Partitions of the left ids, and runs that one heap merges.
RADIX, FAN = 64, 64
#: Runs of one radix that are answered in one group.
ANSWERED = 512
#: Links that are expanded at a time; a group with more than ``WIDE`` links is reduced to its distinct ids first.
SLICE, WIDE = 1 << 21, 4096

#: Texts of these characters alone are cut alike by every version of Unicode's tables since 6.0.
_SETTLED = re.compile("[\x00-ͯЀ-ԥ‐-‧ぁ-ゖァ-ヺ一-龥]*")

#: Fixed value: the pre-token pattern of the byte-level vocabulary.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Encoder = Callable[[list[str]], list[list[int]]]
_sides: dict[str, tuple[list[bytes], Encoder]] = {}


def _byte_level(path: str) -> tuple[list[bytes], Encoder]:
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    own.encode_special_tokens = True
    # Printable bytes stand for themselves, the others for the code points from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    vocabulary = own.get_vocab(with_added_tokens=False)
    size = max(vocabulary.values(), default=-1) + 1
    table = [b""] * size
    for entry, i in vocabulary.items():
        table[i] = bytes(shown[c] for c in entry) if all(c in shown for c in entry) else entry.encode()
    special = set(own.get_added_tokens_decoder())
    ranks = {b: i for i, b in enumerate(table) if i not in special}
    # Where ids follow the order of the merges, a faster library for such ranks gives the same ids.
    made = [vocabulary["".join(pair)] for pair in json.loads(own.to_str())["model"]["merges"]]
    in_order = made == sorted(made) and max(map(ranks.get, (bytes([b]) for b in range(256)))) < made[0]
    fast = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        out = []
        for text in texts:
            text = " " + text
            if in_order and _SETTLED.fullmatch(text):
                out.append(fast.encode_ordinary(text))
            else:
                out.append(own.encode(text, add_special_tokens=False).ids)
        return out

    return table, encode


def _pieces(path: str) -> tuple[list[bytes], Encoder]:
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for i in range(own.get_piece_size()):
        piece = own.id_to_piece(i)
        table.append(bytes([int(piece[3:5], 16)]) if own.is_byte(i) else piece.replace("▁", " ").encode())
    return table, lambda texts: own.encode(texts, num_threads=1)


def side(path: str) -> tuple[list[bytes], Encoder]:
    """The bytes of each id, and the encoder of texts behind a blank; loaded once for each process."""
    if path not in _sides:
        _sides[path] = _pieces(path) if path.endswith(".model") else _byte_level(path)
    return _sides[path]


def _packed(*arrays: np.ndarray) -> bytes:
    """Equally long arrays as one zstd frame."""
    return zstandard.compress(b"".join(a.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays), 1)


def _unpacked(blob: bytes, count: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(count, 8, -1)
    return [np.ascontiguousarray(p.T).view(np.int64).reshape(-1) for p in planes]


def _heads(keys: np.ndarray, counts: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=0), counts)


def _opened(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = _unpacked(blob, 2)
    return np.cumsum(steps), counts


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(weights, new) if len(new) else weights


class Alignment:
    """The groups and links of some texts."""

    def __init__(self, texts: list[str], left: str, right: str) -> None:
        (table_a, encode_a), (table_b, encode_b) = side(left), side(right)
        docs = len(texts)
        asked = [i for i, t in enumerate(texts) if t]
        some = [texts[i] for i in asked]
        a, b = [[]] * docs, [[]] * docs
        for i, text, ids_a, ids_b in zip(asked, some, encode_a(some), encode_b(some), strict=True):
            whole = b" " + text.encode()
            if b"".join(map(table_a.__getitem__, ids_a)) == whole == b"".join(map(table_b.__getitem__, ids_b)):
                a[i], b[i] = ids_a, ids_b
        self.n_a = np.fromiter(map(len, a), np.int64, docs)
        self.n_b = np.fromiter(map(len, b), np.int64, docs)
        self.a = np.fromiter((i for ids in a for i in ids), np.int64, int(self.n_a.sum()))
        self.b = np.fromiter((i for ids in b for i in ids), np.int64, int(self.n_b.sum()))
        self.doc_a = np.repeat(np.arange(docs), self.n_a)
        # Both sides of a text have the same bytes, so offsets may run on over all texts.
        end_a = np.cumsum(_lengths(left)[self.a])
        end_b = np.cumsum(_lengths(right)[self.b])
        total = int(end_a[-1]) + 1 if len(end_a) else 1
        ends = np.zeros(total, bool)
        ends[end_b] = True
        last_a = ends[end_a]
        ends[:] = False
        ends[end_a] = True
        last_b = ends[end_b]
        self.last_a, self.last_b = last_a, last_b
        self.group_a = np.cumsum(last_a) - last_a
        self.group_b = np.cumsum(last_b) - last_b
        groups = int(last_a.sum())
        self.of_a = np.bincount(self.group_a, minlength=groups)
        self.of_b = np.bincount(self.group_b, minlength=groups)
        self.doc_of = self.doc_a[last_a]
        self.n_groups = np.bincount(self.doc_of, minlength=docs)
        links = np.zeros(docs, np.int64)
        np.add.at(links, self.doc_of, self.of_a * self.of_b)
        self.n_links = links

    def texts(self) -> list[str]:
        """``a1,a2|b1;a3|b2``: the ids of each document's groups."""
        size = int(max(self.a.max(initial=0), self.b.max(initial=0))) + 1
        number = list(map(str, range(size)))
        marked = [n + mark for mark in ",|;" for n in number]
        before_b = np.cumsum(self.of_b) - self.of_b
        until_a = np.cumsum(self.of_a)
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + before_b[self.group_a]] = self.a + self.last_a * size
        codes[np.arange(len(self.b)) + until_a[self.group_b]] = self.b + self.last_b * (2 * size)
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append("".join(map(marked.__getitem__, codes[at : at + n].tolist()))[:-1])
            at += n
        return out

    def _slices(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Left ids, right ids, documents and numbers of links, ``SLICE`` links or one group at a time."""
        start_a = np.cumsum(self.of_a) - self.of_a
        start_b = np.cumsum(self.of_b) - self.of_b
        wide = self.of_a * self.of_b > WIDE
        for g in np.flatnonzero(wide).tolist():
            x, n = np.unique(self.a[start_a[g] : start_a[g] + self.of_a[g]], return_counts=True)
            y, m = np.unique(self.b[start_b[g] : start_b[g] + self.of_b[g]], return_counts=True)
            step = max(1, SLICE // len(y))
            for i in range(0, len(x), step):
                some, times = x[i : i + step], n[i : i + step]
                size = len(some) * len(y)
                yield np.repeat(some, len(y)), np.tile(y, len(some)), np.full(size, self.doc_of[g]), np.outer(times, m).ravel()
        narrow = np.flatnonzero(~wide[self.group_a])
        reps = self.of_b[self.group_a[narrow]]
        cuts = np.searchsorted(np.cumsum(reps), np.arange(SLICE, int(reps.sum()) + SLICE, SLICE), "left") + 1
        begin = 0
        for stop in np.minimum(cuts, len(narrow)).tolist():
            own, times = narrow[begin:stop], reps[begin:stop]
            begin = stop
            if not len(own):
                continue
            shift = np.repeat(start_b[self.group_a[own]] - (np.cumsum(times) - times), times)
            i = np.repeat(own, times)
            yield self.a[i], self.b[np.arange(len(i)) + shift], self.doc_a[i], np.ones(len(i), np.int64)

    def records(self, left: str, right: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key of the pair, document and number of links, in the order of radix, left id, right id and document."""
        docs = max(1, len(self.n_a))
        keys, weights = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a, b, doc, n in self._slices():
            key, n = _summed(pair_keys(a, b, left, right) * docs + doc, n)
            keys, weights = (key, n) if not len(keys) else _summed(np.r_[keys, key], np.r_[weights, n])
        return keys // docs, keys % docs, weights


_lengths_of: dict[str, np.ndarray] = {}


def _lengths(path: str) -> np.ndarray:
    if path not in _lengths_of:
        _lengths_of[path] = np.array([len(b) for b in side(path)[0]], np.int64)
    return _lengths_of[path]


def _spans(left: str, right: str) -> tuple[int, int]:
    """Numbers of left ids of a radix and of right ids."""
    return -(-len(side(left)[0]) // RADIX), len(side(right)[0])


def pair_keys(a: np.ndarray, b: np.ndarray, left: str, right: str) -> np.ndarray:
    per_radix, of_b = _spans(left, right)
    return ((a % RADIX) * per_radix + a // RADIX) * of_b + b


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of at most ``PART_BYTES`` bytes and ``PART_DOCS`` documents."""
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        begin = size = 0
        for i, t in enumerate(texts):
            if i > begin and (size + len(t) > PART_BYTES or i - begin == PART_DOCS):
                yield batch.column("doc_id").slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(t)
        if begin < len(texts):
            yield batch.column("doc_id").slice(begin), texts[begin:]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _spill(left: str, right: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for ids, texts in _parts(batches):
            found = Alignment(texts, left, right)
            keys, docs, links = found.records(left, right)
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.texts()]
            described = pa.StructArray.from_arrays(
                [ids, *(pa.array(getattr(found, n), pa.int64()) for n in _COUNTS), pa.array(digests)],
                names=["doc_id", *_COUNTS, "groups_sha256"],
            )
            new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
            heads, times = keys[new], np.diff(np.r_[new, len(keys)])
            # The part itself: its documents and postings. Then a run for each radix.
            rows = [(number, -1, _packed(docs, links))]
            span = np.prod(_spans(left, right))
            cuts = np.searchsorted(heads, np.arange(RADIX + 1) * span)
            for r in range(RADIX):
                if cuts[r] < cuts[r + 1]:
                    own = slice(cuts[r], cuts[r + 1])
                    rows.append((number, r, _heads(heads[own], times[own])))
            offsets = pa.array([0, *[len(ids)] * len(rows)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)),
                    pa.ListArray.from_arrays(offsets, described),
                ],
                names=["part", "radix", "run", "docs"],
            )
            number += 1

    return run


def _stream(blob: bytes) -> Iterator[tuple[int, int]]:
    keys, counts = _opened(blob)
    for i in range(0, len(keys), 4096):
        yield from zip(keys[i : i + 4096].tolist(), counts[i : i + 4096].tolist(), strict=True)


def merged(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order and their summed counts: a heap merge of sorted runs."""
    keys, counts = [], []
    for key, same in groupby(heapq.merge(*map(_stream, blobs)), lambda head: head[0]):
        keys.append(key)
        counts.append(sum(n for _, n in same))
    return np.array(keys, np.int64), np.array(counts, np.int64)


def _merge_runs(group: pa.Table) -> pa.Table:
    keys, counts = merged(group.column("run").to_pylist())
    return pa.table({"radix": group.column("radix").slice(0, 1), "run": pa.array([_heads(keys, counts)], pa.binary())})


def _answers(of_b: int):
    def run(totals: pa.Table, runs: pa.Table) -> pa.Table:
        keys, counts = _opened(totals.column("run")[0].as_py()) if totals.num_rows else (np.zeros(0, np.int64),) * 2
        ids = keys // of_b
        new = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
        highest = np.repeat(np.maximum.reduceat(counts, new), np.diff(np.r_[new, len(ids)])) if len(ids) else counts
        best = counts == highest
        replies = []
        for blob in runs.column("run").to_pylist():
            own, times = _opened(blob)
            at = np.searchsorted(keys, own)
            replies.append(_packed(times, counts[at], best[at]))
        return pa.table({"part": runs.column("part"), "radix": runs.column("radix"), "reply": pa.array(replies, pa.binary())})

    return run


def _contributions(part: pa.Table, replies: pa.Table) -> pa.Table:
    docs = part.column("docs").combine_chunks().flatten()
    if isinstance(docs, pa.ChunkedArray):
        docs = docs.combine_chunks()
    doc, links = _unpacked(part.column("run")[0].as_py(), 2)
    best, sums = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    begin = 0
    for reply in replies.sort_by("radix").column("reply").to_pylist():
        times, counts, is_best = _unpacked(reply, 3)
        stop = begin + int(times.sum())
        own = slice(begin, stop)
        np.add.at(sums, doc[own], links[own] * np.repeat(counts, times))
        np.add.at(best, doc[own], links[own] * np.repeat(is_best, times))
        begin = stop
    fields = [docs.field(n) for n in ("doc_id", *_COUNTS)]
    names = ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"]
    return pa.table([*fields, pa.array(best), pa.array(sums), docs.field("groups_sha256")], names=names)


def spilled(spark: SparkSession, docs: DataFrame, left: str, right: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written parts and runs of ``docs``: ``(part, radix, run, docs)``, radix -1 for a part itself."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    described = f"array<struct<doc_id:{kind},n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>>"
    rows = docs.mapInArrow(_spill(left, right), f"part bigint, radix int, run binary, docs {described}")
    return materialize(spark, rows, "runs")


def totals(spark: SparkSession, runs: DataFrame, parts: int) -> DataFrame:
    """``(radix, run)``: one run for each radix, with the counts of all parts."""
    runs = runs.where("radix >= 0").select("radix", "run", "part")
    while True:
        groups = -(-parts // FAN)
        lot = F.pmod(F.xxhash64("part"), F.lit(groups)).cast("int")
        runs = runs.groupBy("radix", lot.alias("lot")).applyInArrow(_merge_runs, "radix int, run binary")
        runs = materialize(spark, runs, "merged")
        if groups <= 1:
            return runs
        parts = groups
        runs = runs.withColumn("part", F.monotonically_increasing_id())


def align(spark: SparkSession, docs: DataFrame, left: str, right: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of each row of ``docs``.

    ``n_best`` counts links whose pair has its left id's highest count, ``count_sum`` adds the counts of all links.
    """
    runs = spilled(spark, docs, left, right, doc_id, text)
    parts = runs.where("radix = -1").count()
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    if not parts:
        return spark.createDataFrame([], schema)
    salts = -(-parts // ANSWERED)
    counted = totals(spark, runs, parts).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    asked = runs.where("radix >= 0").select("part", "radix", "run", F.pmod(F.xxhash64("part"), F.lit(salts)).cast("int").alias("salt"))
    by = ("radix", "salt")
    replies = counted.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(
        _answers(_spans(left, right)[1]), "part bigint, radix int, reply binary"
    )
    whole = runs.where("radix = -1").select("part", "run", "docs")
    return whole.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(_contributions, schema)


def pair_counts(spark: SparkSession, docs: DataFrame, left: str, right: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(left, right, documents)`` of each linked pair of ids."""
    runs = spilled(spark, docs, left, right, doc_id, text)
    parts = runs.where("radix = -1").count()
    per_radix, of_b = _spans(left, right)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("run").to_pylist():
                keys, counts = _opened(blob)
                a = keys // of_b
                arrays = [a % per_radix * RADIX + a // per_radix, keys % of_b, counts]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["left", "right", "documents"])

    schema = "left bigint, right bigint, documents bigint"
    return totals(spark, runs, parts).mapInArrow(listed, schema) if parts else spark.createDataFrame([], schema)
