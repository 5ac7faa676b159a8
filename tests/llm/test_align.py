"""Cross-tokenizer alignment against plain loops over the tokens."""

import bisect
import collections
import hashlib
import random

import numpy as np
import pytest

from seriesflow.llm import align, queries
from seriesflow.llm.common import ship_package

SCHEMA = "doc_id bigint, text string, part string, radix string, docs string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def paths():
    return queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    left, right = paths()
    a = Tokenizer.from_file(left)
    a.encode_special_tokens = True
    alphabet = {c: bytes([b]) for b in range(256) for c in [shown(b)]}
    bytes_a = {i: b"".join(alphabet[c] for c in e) for e, i in a.get_vocab().items() if all(c in alphabet for c in e)}
    b = sentencepiece.SentencePieceProcessor(model_file=right)

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids, bytes_a.__getitem__), (b.encode, bytes_b)


def shown(b):
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return chr(b) if b in plain else chr(256 + [x for x in range(256) if x not in plain].index(b))


def brute_force(texts):
    (encode_a, bytes_a), (encode_b, bytes_b) = encoders()
    docs = []
    for t in texts:
        a, b = (encode_a(t), encode_b(t)) if t else ([], [])
        whole = b" " + (t or "").encode()
        if not t or b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
            docs.append([])
            continue
        ends = [np.cumsum([len(f(i)) for i in ids]).tolist() for f, ids in ((bytes_a, a), (bytes_b, b))]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = {c: ([], []) for c in cuts}
        for side, (ids, stops) in enumerate(((a, ends[0]), (b, ends[1]))):
            for i, e in zip(ids, stops, strict=True):
                groups[cuts[bisect.bisect_left(cuts, e)]][side].append(i)
        docs.append(list(groups.values()))
    links = [[(x, y) for xs, ys in groups for x in xs for y in ys] for groups in docs]
    count = collections.Counter(p for own in links for p in set(own))
    highest = collections.defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for groups, own in zip(docs, links, strict=True):
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append(
            (
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                len(own),
                sum(count[p] == highest[p[0]] for p in own),
                sum(count[p] for p in own),
                digest,
            )
        )
    return out, count


def odd_texts():
    rng = random.Random(7)
    words = ["the", "of", "nation", "größe", "naïve", "漢字", "re-entry", "123456", "can't", "\t", "  ", "\n\n", "🙂", "Ωmega", "пример"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    return [
        None, "", " ", "a", "<|endoftext|> and <s> or <unk>", "two▁bars", "é ﬁ", "aaaa" * 300, "ࠀọ\U0001f600" * 40,
        "nul\x00 and bell\x07", " leading", "trailing  ", "same text", "same text", *made, " ".join(made) * 5,
    ]


@pytest.mark.parametrize("small", [False, True])
def test_alignment(spark, monkeypatch, small):
    """With small parts, many runs are merged over several levels and wide groups are cut."""
    texts = odd_texts()
    docs = spark.createDataFrame([(i // 2, t, "p", "r", "d") for i, t in enumerate(texts)], SCHEMA)
    if small:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        monkeypatch.setattr(align, "FAN", 3)
        monkeypatch.setattr(align, "ANSWERED", 2)
    try:
        got = align.align(spark, docs, *paths())
        want, count = brute_force(texts)
        assert sorted(tuple(r) for r in got.collect()) == sorted((i // 2, *w) for i, w in enumerate(want))
        pairs = align.pair_counts(spark, docs, *paths())
        assert {(r[0], r[1]): r[2] for r in pairs.collect()} == count
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert any(w[0] == 0 for w in want[4:])


def test_wide_groups(monkeypatch):
    """Groups and slices of any width give the same records."""
    texts = [t or "" for t in odd_texts()]
    whole = align.Alignment(texts, *paths()).records(*paths())
    monkeypatch.setattr(align, "WIDE", 1)
    monkeypatch.setattr(align, "SLICE", 5)
    cut = align.Alignment(texts[:30], *paths()).records(*paths())
    monkeypatch.undo()
    same = align.Alignment(texts[:30], *paths()).records(*paths())
    assert all(np.array_equal(x, y) for x, y in zip(cut, same, strict=True)) and len(whole[0]) > len(same[0])


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert align.align(spark, docs, *paths()).count() == 0
    assert align.pair_counts(spark, docs, *paths()).count() == 0


def test_fast_encoder_is_the_library():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(paths()[0])
    own.encode_special_tokens = True
    rng = random.Random(8)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 0x526), rng.randrange(9, 128)])) for _ in range(400)) for _ in range(200)]
    texts += [t for t in odd_texts() if t]
    _, encode = align.side(paths()[0])
    assert encode(texts) == [own.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute_force([r["text"] for r in rows])
    got = queries.registered()["op12_alignment"](spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), *((n, "bigint") for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", "string")]
    assert sorted(tuple(r) for r in got.collect()) == sorted((r["doc_id"], *w) for r, w in zip(rows, want, strict=True))
