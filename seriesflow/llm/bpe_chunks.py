"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts texts where their content says so, so that texts with a common passage have common chunks. The
chunks that occur most often in the corpus (``hot`` of them, a bounded broadcast) are encoded once for all; every
other chunk is encoded once for each worker that keeps it in its bounded store. A cut can fall inside a word, where
the tokens of two chunks say nothing about the text. Each join is repaired: the text from the last white space before
it to the next one behind it, over as many chunks as that takes, is encoded again between its neighbouring words, and
counts when those have exactly the tokens that they have in their chunks.

Words apart from white space never share tokens in this vocabulary, so a chunk is made of words whose tokens a worker
keeps, too, in a bounded store; the library sees each of those once, many in one text with a mark between two (``MARK``).
A word that differs from another one in capitals of ASCII or in a mark of punctuation at its end has the tokens of that
one (``core``). Nothing is shuffled but chunk hashes.

A null text is empty; empty texts have no tokens. Rows keep all their columns but ``n_tokens, ids, decoded``, which
are replaced. Special strings inside texts are tokens, as the library does by default.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from seriesflow.llm.common import ROW, identified, materialize, worker_store
from seriesflow.llm.token_counts import tokenizer

#: A cut for some 2^CUT_BITS bytes, none within LEAST bytes of the last one.
CUT_BITS, LEAST = 11, 256
#: Chunks encoded once for the whole corpus, and the longest of them in bytes.
HOT, HOT_BYTES = 4096, 16384
#: Bounds of a worker's stores: bytes of chunks, number of words, characters of a stored word.
STORE_BYTES, STORE_WORDS, WORD_CHARS = 24_000_000, 900_000, 64

#: Stands between words that the library gets as one text, so many at a time.
MARK, JOINED = "\x01", 128

#: White space of the tokenizer's pattern (Unicode White_Space); str.split knows four more characters.
_BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SPACE = re.compile(f"[{''.join(map(chr, _BLANKS))}]+")
_MORE = re.compile("[\x1c-\x1f]")
#: A mark of punctuation that no letter or digit before it shares a token with. U+0130 in small letters ends with a combining dot.
_ENDED = re.compile(r"[0-9A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F][.,;:!?]\Z")
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: bytes) -> list[int]:
    """Ends of the content-defined chunks of a text, its own end last."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    b = np.frombuffer(data, np.uint8)
    h = _GEAR[b]
    for shift in (1, 2, 4, 8):  # a hash of the last 16 bytes
        h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift))
    # The next byte must begin a character.
    ends = np.flatnonzero((h[:-1] >> np.uint32(32 - CUT_BITS) == 0) & (b[1:] & 0xC0 != 0x80)) + 1
    out, last = [], 0
    for e in ends.tolist():
        if e - last >= LEAST:
            out.append(e)
            last = e
    if last < n:
        out.append(n)
    return out


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def split_words(text: str) -> list[str]:
    return _SPACE.split(text) if _MORE.search(text) else text.split()


def core(word: str) -> tuple[str, str]:
    """What the library has to see of a word: without capitals of ASCII, and apart from its last mark of punctuation."""
    if word.isascii() and "<|" not in word:  # special strings are told apart by their capitals
        word = word.lower()
    return (word[:-1], word[-1]) if _ENDED.search(word) else (word, "")


class Piece:
    """An encoded chunk: the parts of words at its ends, and the tokens of the whole words between them."""

    __slots__ = ("head", "tail", "whole", "first", "last", "ids")

    def __init__(self, text: str) -> None:
        self.whole = _SPACE.search(text) is None
        if self.whole:
            self.head, self.tail, words = text, "", []
        else:
            words = [w for w in split_words(text) if w]
            self.head = "" if _SPACE.match(text[0]) else words.pop(0)
            self.tail = "" if _SPACE.match(text[-1]) else words.pop()
        self.ids: object = words
        self.first, self.last = (words[0], words[-1]) if words else ("", "")


class Encoder:
    """Encodes batches of texts; keeps words and chunks in bounded stores."""

    def __init__(self, path: str, hot: dict[bytes, Piece] | None = None) -> None:
        self.own, self.hot = tokenizer(path), hot or {}
        marked = self.own.encode(MARK, add_special_tokens=False).ids
        #: The token that stands for the mark, and for nothing else.
        self.mark = marked[0] if len(marked) == 1 else None
        #: What a token is decoded to, where the vocabulary has no decoder and the library puts a space between two.
        self.names = None
        if self.own.decoder is None:
            self.names = np.full(self.own.get_vocab_size(), "", object)
            for name, i in self.own.get_vocab().items():
                self.names[i] = name
        self.words: dict[str, bytes] = {}
        self.store: dict[bytes, Piece] = {}
        self.stored = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Tokens of each text, four bytes each."""
        return [array("I", e.ids).tobytes() for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Tokens of each word. What costs the library the same for every text is paid once for ``JOINED`` words."""
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        texts = [f" {MARK} ".join([*g, ""]) for g in groups]
        if self.mark is None or any(t.count(MARK) != len(g) for t, g in zip(texts, groups, strict=True)):
            return self._encode(words)
        out: list[bytes] = []
        for e in self.own.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(e.ids, np.uint32)
            last, data = 0, ids.tobytes()
            for end in (4 * np.flatnonzero(ids == self.mark)).tolist():
                out.append(data[last:end])
                last = end + 4
        return out

    def words_of(self, new: list[str]) -> dict[str, bytes]:
        """Tokens of words, each core encoded once."""
        cores = [core(w) for w in new]
        fresh = list({x for c in cores for x in c if x}.difference(self.words))
        ids = dict(zip(fresh, self._encode_words(fresh), strict=True))
        for x in {x for c in cores for x in c}.difference(ids):
            ids[x] = self.words[x] if x else b""
        return {w: ids[c] + ids[end] if end else ids[c] for w, (c, end) in zip(new, cores, strict=True)}

    def decode(self, ids: list[bytes]) -> list[str]:
        """As the library decodes, special tokens not skipped."""
        if self.names is None:
            return self.own.decode_batch([array("I", x).tolist() for x in ids], skip_special_tokens=False)
        return [" ".join(self.names[np.frombuffer(x, "<u4")]) for x in ids]

    def pieces(self, wanted: set[bytes]) -> dict[bytes, Piece]:
        """The encoded form of each chunk; new ones are encoded together."""
        found, fresh = {}, {}
        for c in wanted:
            p = self.hot.get(c) or self.store.get(c)
            if p is None:
                fresh[c] = Piece(c.decode())
            else:
                found[c] = p
        if len(self.words) > STORE_WORDS:
            self.words.clear()
        known = self.words
        local = self.words_of(list(set().union(*[p.ids for p in fresh.values()]).difference(known)))
        known.update(local)
        for c, p in fresh.items():
            p.ids = b"".join(map(known.__getitem__, p.ids))
            if self.stored + 3 * len(c) > STORE_BYTES:
                self.store.clear()
                self.stored = 0
            if 3 * len(c) <= STORE_BYTES // 8:
                self.store[c] = p
                self.stored += 3 * len(c)
        for w in [w for w in local if len(w) > WORD_CHARS]:
            del known[w]
        return found | fresh

    def repaired(self, joins: list[tuple[list[str], str, list[str]]]) -> list[bytes]:
        """Tokens of the word at each join, between the whole words before and behind it (nearest last, nearest first).

        The window holds the word and as many neighbours as are known; it agrees if the outer words have the tokens that they have by themselves, which is what their chunks hold.
        """
        texts = [" ".join([*before, word, *behind]) for before, word, behind in joins]
        outer = list({w for before, _, behind in joins for w in (*before, *behind)}.difference(self.words))
        alone = dict(zip(outer, self._encode(outer), strict=True))
        out = []
        for (before, word, behind), ids in zip(joins, self._encode(texts), strict=True):
            left, right = (b"".join([self.words[w] if w in self.words else alone[w] for w in side]) for side in (before, behind))
            if ids.startswith(left) and ids.endswith(right) and len(ids) >= len(left) + len(right):
                out.append(ids[len(left) : len(ids) - len(right)])
            else:  # no agreement: only the text's own white space bounds the word
                out.append(self._encode([word])[0])
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        cut = [chunks(t) for t in texts]
        pieces = self.pieces({c for d in cut for c in d})
        plans, joins = [], []
        for d in cut:
            plan: list = []
            open_word, before = "", ""
            for c in d:
                p = pieces[c]
                if p.whole:
                    open_word += p.head
                    continue
                word = open_word + p.head
                if word:
                    plan.append(len(joins))
                    joins.append(([before] if before else [], word, [p.first] if p.first else []))
                plan.append(p.ids)
                open_word, before = p.tail, p.last
            if open_word:
                plan.append(len(joins))
                joins.append(([before] if before else [], open_word, []))
            plans.append(plan)
        fixed = self.repaired(joins) if joins else []
        return [b"".join([fixed[x] if isinstance(x, int) else x for x in plan]) for plan in plans]


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    worker_store("bpe_chunks")
    for batch in batches:
        rows, hashes = [], []
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for c in chunks((text or "").encode()):
                if len(c) <= HOT_BYTES:
                    rows.append(row)
                    hashes.append(xxhash.xxh3_64_intdigest(c) - (1 << 63))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(hashes, pa.int64())], [ROW, "hash"])


def hot_chunks(spark: SparkSession, docs: DataFrame, text: str, hot: int = HOT) -> list[bytes]:
    """The ``hot`` chunks that occur most often, more than once: at most HOT * HOT_BYTES bytes.

    A chunk that its row doesn't hold when it is read again, as the rows were numbered anew, is left out. Chunks only
    save work, so the tokens stay the same.
    """
    docs = identified(spark, docs).select(ROW, F.col(text).alias("text"))
    most = (
        docs.mapInArrow(_hashes, f"{ROW} bigint, hash bigint")
        .groupBy("hash")
        .agg(F.count("*").alias("n"), F.min(ROW).alias(ROW))
        .where("n > 1")
        .orderBy(F.desc("n"), "hash")
        .limit(hot)
    )
    most = materialize(spark, most.select("hash", ROW), "hot")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out = []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("own").to_pylist(), strict=True):
                own = set(own)
                out += {c for c in chunks((text or "").encode()) if xxhash.xxh3_64_intdigest(c) - (1 << 63) in own}
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["chunk"])

    holders = most.groupBy(ROW).agg(F.collect_list("hash").alias("own"))
    picked = docs.join(F.broadcast(holders), ROW).select("text", "own").mapInArrow(pick, "chunk binary")
    return sorted(bytes(r[0]) for r in picked.distinct().collect())


def encode(spark: SparkSession, docs: DataFrame, path: str, text: str = "text", hot: int = HOT) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``."""
    docs = docs.drop("n_tokens", "ids", "decoded")
    most = hot_chunks(spark, docs, text, hot)
    digest = hashlib.sha256(b"".join(most)).hexdigest()
    shared = spark.sparkContext.broadcast(most)
    name = f"{path}:{digest}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, Encoder] = worker_store("bpe_chunks")
        if name not in kept:
            kept.clear()
            encoder = Encoder(path)
            for i in range(0, len(shared.value), 256):
                encoder.hot.update(encoder.pieces(set(shared.value[i : i + 256])))
            encoder.store.clear()
            encoder.stored = 0
            kept[name] = encoder
        encoder = kept[name]
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                ids = encoder.encode([(t or "").encode() for t in part.column(text).to_pylist()])
                arrays = [
                    *part.columns,
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(encoder.decode(ids), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "n_tokens", "ids", "decoded"])

    schema = StructType([*docs.schema.fields]).add("n_tokens", LongType()).add("ids", BinaryType()).add("decoded", StringType())
    return docs.mapInArrow(run, schema)


def report(encoded: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The digests of ``encode``."""
    return encoded.select(
        F.col(doc_id).alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
