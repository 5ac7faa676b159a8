"""Language identification by a byte convolutional network.

The network has filters of several widths over bytes, a rectifier, the maximum over the window and a softmax; it is
trained in numpy on the driver. The training sample is bounded: ``per_language`` labelled documents of each language
are drawn by a hash of their rows, with ``windows`` windows each. A text is cut into windows of ``LENGTH`` bytes, all
of them are scored in batches, and the mean of their logits decides. Filters over pairs of bytes become lookup
tables, so that a position costs a few table rows.

A null text or one without a letter gets ``und`` and score 0; so does every text if nothing is labelled. Ties between
languages go to the smaller name. Prediction reads the text alone. Rows with equal ids each get a prediction.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesflow.llm.common import own_name, worker_store

LENGTH = 160
WIDTHS = (2, 3, 4)
FILTERS = 12
UNKNOWN = "und"

#: Documented bounds of the training sample.
PER_LANGUAGE, WINDOWS = 1500, 2
EPOCHS, BATCH, RATE = 6, 128, 0.01


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts as rows of bytes, zeros at the end, and the place of each window's text."""
    counts = np.array([max(1, -(-len(t) // LENGTH)) for t in texts], np.int64)
    joined = b"".join(t + bytes(n * LENGTH - len(t)) for t, n in zip(texts, counts.tolist(), strict=True))
    return np.frombuffer(joined, np.uint8).reshape(-1, LENGTH), np.repeat(np.arange(len(texts)), counts)


class Network:
    """``tables[w][j]`` holds the weights of byte ``j`` of the filters of width ``w``."""

    def __init__(self, langs: list[str], seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.params = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.params += [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        hidden = FILTERS * len(WIDTHS)
        self.params += [
            rng.normal(0, 0.3, (hidden, len(langs))).astype(np.float32),
            np.zeros(len(langs), np.float32),
        ]

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(p) for p in self.params]
        second = [np.zeros_like(p) for p in self.params]
        step, n = 0, len(WIDTHS)
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for i in range(0, len(order), BATCH):
                xb, yb = x[order[i : i + BATCH]], y[order[i : i + BATCH]]
                hidden, tops = [], []
                for k, w in enumerate(WIDTHS):
                    z = sum(self.params[k][j][xb[:, j : LENGTH - w + 1 + j]] for j in range(w))
                    at = z.argmax(1)
                    tops.append(at)
                    hidden.append(np.maximum(np.take_along_axis(z, at[:, None], 1)[:, 0] + self.params[n + k], 0))
                h = np.concatenate(hidden, 1)
                z = h @ self.params[-2] + self.params[-1]
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(yb)), yb] -= 1
                p /= len(yb)
                back = (p @ self.params[-2].T) * (h > 0)
                grads = [np.zeros_like(q) for q in self.params]
                grads[-2], grads[-1] = h.T @ p, p.sum(0)
                column = np.broadcast_to(np.arange(FILTERS), (len(xb), FILTERS))
                for k, w in enumerate(WIDTHS):
                    own = back[:, k * FILTERS : (k + 1) * FILTERS]
                    grads[n + k] = own.sum(0)
                    for j in range(w):
                        byte = np.take_along_axis(xb, tops[k] + j, 1)
                        np.add.at(grads[k][j], (byte, column), own)
                step += 1
                for q, g, m, v in zip(self.params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    q -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self


class Scorer:
    """The trained network with its filters folded into tables over pairs of bytes."""

    def __init__(self, params: list[np.ndarray]) -> None:
        n = len(WIDTHS)
        self.params = params
        pairs = [(t[0][:, None] + t[1][None]).reshape(65536, FILTERS) for t in params[:n]]
        self.first = np.ascontiguousarray(np.concatenate(pairs, 1))
        self.third = np.ascontiguousarray(params[1][2])
        self.last = (params[2][2][:, None] + params[2][3][None]).reshape(65536, FILTERS)
        self.bias = np.concatenate(params[n : 2 * n])

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), self.params[-1].shape[0]), np.float32)
        for i in range(0, len(x), 64):
            b = x[i : i + 64]
            code = b[:, :-1].astype(np.intp) * 256 + b[:, 1:]
            z = self.first[code]
            two = z[:, :, :FILTERS].max(1)
            three = (z[:, :-1, FILTERS : 2 * FILTERS] + self.third[b[:, 2:]]).max(1)
            four = (z[:, :-2, 2 * FILTERS :] + self.last[code[:, 2:]]).max(1)
            h = np.maximum(np.concatenate((two, three, four), 1) + self.bias, 0)
            out[i : i + 64] = h @ self.params[-2] + self.params[-1]
        return out

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and score of each text."""
        x, owner = windows_of([t.encode() for t in texts])
        sums = np.zeros((len(texts), self.params[-1].shape[0]))
        np.add.at(sums, owner, self.logits(x))
        z = sums / np.bincount(owner, minlength=len(texts))[:, None]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        return p.argmax(1), p.max(1)


def training_sample(
    docs: DataFrame, text: str, lang: str, per_language: int, windows: int
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and labels: some ``per_language`` documents of each language, drawn by a hash of the row."""
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "lang IS NOT NULL AND text IS NOT NULL AND text <> ''"
    )
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((0, LENGTH), np.uint8), np.zeros(0, np.int64)
    share = F.create_map(*[F.lit(v) for k in langs for v in (k, min(1.0, per_language / counts[k]))])
    drawn = labelled.withColumn("h", F.xxhash64("text", "lang")).where(
        (F.col("h").bitwiseAND((1 << 31) - 1) / float(1 << 31)) < share[F.col("lang")]
    )
    pieces = [
        F.substring("text", (F.pmod(F.xxhash64("h", F.lit(i)), F.greatest(F.length("text") - LENGTH, F.lit(1))) + 1).cast("int"), F.lit(LENGTH))
        for i in range(windows)
    ]
    rows = drawn.select("lang", "h", F.array(*pieces).alias("pieces")).orderBy("h", "lang").limit(2 * per_language * len(langs)).collect()
    place = {k: i for i, k in enumerate(langs)}
    texts = [p.encode()[:LENGTH] for r in rows for p in r["pieces"]]
    y = np.array([place[r["lang"]] for r in rows for _ in r["pieces"]], np.int64)
    return langs, windows_of(texts)[0], y


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, windows: int = WINDOWS
) -> Network | None:
    """A network fitted on a bounded sample of ``docs``; None if no row is labelled."""
    langs, x, y = training_sample(docs, text, lang, per_language, windows)
    return Network(langs).fit(x, y) if langs else None


def predictor(network: Network) -> Callable:
    """A vectorised function of a text column: ``struct<lang_pred, score>``."""
    langs, packed = network.langs, pickle.dumps(network.params)
    key = hashlib.sha256(packed).hexdigest()

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        scorers: dict[str, Scorer] = worker_store("langid")
        if key not in scorers:
            scorers.clear()
            scorers[key] = Scorer(pickle.loads(packed))
        index, score = scorers[key].predict([t or "" for t in texts])
        return pd.DataFrame({"lang_pred": [langs[i] for i in index], "score": score})

    return predict


def identify(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = F.lit(None).cast("struct<lang_pred:string,score:double>") if network is None else predictor(network)(F.col(text))
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    docs = docs.drop("lang_pred", "score")
    name = own_name(docs, "found")
    judged = docs.withColumn(name, found).withColumn(name, F.when(letters, F.coalesce(name, unknown)).otherwise(unknown))
    return judged.select(*[judged[f"`{c}`"] for c in docs.columns], f"{name}.lang_pred", f"{name}.score")
