"""Language identification by a convolutional network over bytes, trained in numpy.

Text is lower-cased and read as UTF-8 in windows of ``WINDOW`` bytes that cover all of it. Filters of several
widths slide over a window; each filter's largest response, rectified, goes to a softmax over the languages. A
document's probabilities are the mean of its windows', weighted by their bytes. Trained filters are applied as
one table of 256 rows for each position of a filter, so the network costs a few table reads a byte.

Training takes a bounded sample: at most ``fit_rows`` pieces of labelled texts, the same number from each
language while they last, of the ``max_langs`` most frequent languages. The label is the only thing besides the text that it sees.

Defined cases: null text and text without letters give ``und`` with score 0, as does a corpus with no labelled
rows; repeated rows give repeated results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.llm.common import map_rows, thinned
from strataline.session import stage

WINDOW = 256
UNKNOWN = "und"
# Windows that are scored at once.
BLOCK = 64
# Characters of a text that one training piece may have.
PIECE_CHARS = 400


@dataclass(frozen=True)
class Trainer:
    """Network shape and training parameters.

    ``fit_rows`` bounds the rows that reach the driver. Languages have equal parts in them, and each has one row at
    least: with more languages than ``fit_rows`` there are as many rows as languages.
    """

    fit_rows: int = 6000
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embedding: int = 8
    window: int = 128
    steps: int = 900
    batch: int = 64
    rate: float = 0.01
    seed: int = 5

    def fit(self, texts: list[str], langs: list[str]) -> Network | None:
        if not texts:
            return None
        rng = np.random.default_rng(self.seed)
        names = sorted(set(langs))
        target = np.array([names.index(x) for x in langs])
        coded = [np.frombuffer(encoded(t), dtype=np.uint8) for t in texts]
        emb = rng.normal(0, 0.3, (256, self.embedding))
        emb[0] = 0
        conv = [rng.normal(0, 0.3, (w, self.embedding, self.filters)) for w in self.widths]
        dense = rng.normal(0, 0.1, (len(self.widths) * self.filters, len(names)))
        bias = np.zeros(len(names))
        params = [emb, *conv, dense, bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        by_lang = [np.flatnonzero(target == k) for k in range(len(names))]
        for step in range(1, self.steps + 1):
            pick = np.array([rng.choice(by_lang[k]) for k in rng.integers(len(names), size=self.batch)])
            grads = self._gradients(params, self._windows([coded[i] for i in pick], rng), target[pick])
            rate = self.rate * min(1.0, 2 * (1 - step / (self.steps + 1)))
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            emb[0] = 0
        tables = [(emb @ c).astype(np.float32) for c in conv]
        return Network(names, tables, dense.astype(np.float32), bias.astype(np.float32))

    def _windows(self, coded: list[np.ndarray], rng: np.random.Generator) -> np.ndarray:
        """A random stretch of each text, a third of them short, padded with zeros."""
        out = np.zeros((len(coded), self.window), dtype=np.uint8)
        for row, text in zip(out, coded, strict=True):
            size = int(rng.integers(6, self.window)) if rng.random() < 1 / 3 else self.window
            start = int(rng.integers(max(1, len(text) - size + 1)))
            part = text[start : start + size]
            row[: len(part)] = part
        return out

    def _gradients(self, params: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        emb, *conv, dense, bias = params
        n = len(x)
        e = emb[x]
        pooled, best = [], []
        for w, c in zip(self.widths, conv, strict=True):
            length = x.shape[1] - w + 1
            z = sum(e[:, j : j + length] @ c[j] for j in range(w))
            at = z.argmax(axis=1)
            best.append(at)
            pooled.append(np.take_along_axis(z, at[:, None], axis=1)[:, 0])
        h = np.concatenate(pooled, axis=1)
        active = np.maximum(h, 0)
        p = softmax(active @ dense + bias)
        p[np.arange(n), y] -= 1
        p /= n
        d_dense, d_bias = active.T @ p, p.sum(axis=0)
        d_h = (p @ dense.T) * (h > 0)
        d_emb = np.zeros_like(emb)
        d_conv = []
        for k, (w, c) in enumerate(zip(self.widths, conv, strict=True)):
            d = d_h[:, k * self.filters : (k + 1) * self.filters]
            grad = np.zeros_like(c)
            rows = np.arange(n)[:, None]
            for j in range(w):
                # Only the window's best position of a filter has a gradient.
                grad[j] = np.einsum("nfe,nf->ef", e[rows, best[k] + j], d)
                np.add.at(d_emb, x[rows, best[k] + j], d[:, :, None] * c[j].T[None])
            d_conv.append(grad)
        return [d_emb, *d_conv, d_dense, d_bias]


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def encoded(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


@dataclass(frozen=True)
class Network:
    """A trained network: languages, a table per filter position, and the output layer."""

    names: list[str]
    tables: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Softmax over the languages for each row of bytes."""
        out = np.empty((len(windows), len(self.names)))
        for at in range(0, len(windows), BLOCK):
            x = windows[at : at + BLOCK].astype(np.intp)
            pooled = []
            for table in self.tables:
                length = x.shape[1] - len(table) + 1
                z = table[0][x[:, :length]]
                for j in range(1, len(table)):
                    z += table[j][x[:, j : j + length]]
                pooled.append(z.max(axis=1))
            h = np.maximum(np.concatenate(pooled, axis=1), 0)
            out[at : at + BLOCK] = softmax(h @ self.dense + self.bias)
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """The language of each text, and its probability."""
        coded = [encoded(t) for t in texts]
        count = [-(-len(b) // WINDOW) for b in coded]
        whole = b"".join(b + bytes(n * WINDOW - len(b)) for b, n in zip(coded, count, strict=True))
        p = self.probabilities(np.frombuffer(whole, dtype=np.uint8).reshape(-1, WINDOW))
        weight = np.full(len(p), float(WINDOW))
        ends = np.cumsum(count)
        weight[ends - 1] = [len(b) - (n - 1) * WINDOW for b, n in zip(coded, count, strict=True)]
        mean = np.add.reduceat(p * weight[:, None], ends - count, axis=0)
        mean /= mean.sum(axis=1, keepdims=True)
        return [(self.names[k], float(m[k])) for m, k in zip(mean, mean.argmax(axis=1), strict=True)]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def held_out(id_col: str = "doc_id") -> Column:
    """A third of the documents, which training never sees."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, trainer: Trainer = Trainer(), id_col: str = "doc_id") -> Network | None:
    """A network for the languages of the labelled documents outside the held-out third."""
    docs = docs.select(id_col, "text", "lang")
    text = F.col("text")
    spare = F.greatest(F.length(text) - PIECE_CHARS, F.lit(0)) + 1
    at = F.xxhash64(F.col(id_col), F.length(text))
    known = docs.filter(~held_out(id_col) & F.col("lang").isNotNull() & (F.col("lang") != ""))
    # How many rows a language has decides what share of them is looked at.
    langs = stage(known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "langs")
    pieces = (
        known.withColumn("at", at)
        .join(langs, "lang")
        .filter(thinned(F.col("at"), trainer.fit_rows, F.col("rows")) & text.rlike(r"\p{L}"))
        .select("lang", "at", F.substring(text, (F.pmod("at", spare) + 1).cast("int"), F.lit(PIECE_CHARS)).alias("piece"))
    )
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("at", "piece"))
    rows = (
        pieces.withColumn("turn", turn)
        .filter(F.col("turn") <= trainer.fit_rows)
        .orderBy("turn", "lang")
        .limit(max(trainer.fit_rows, langs.count()))
        .collect()
    )
    return trainer.fit([r["piece"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``lang_pred`` and ``score``. Only the text decides."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        waiting: list[tuple] = []
        size = 0
        for doc_id, text in rows:
            if network is None or not text or not has_letter(text):
                yield doc_id, UNKNOWN, 0.0
                continue
            waiting.append((doc_id, text))
            size += len(text)
            if size > 4 * BLOCK * WINDOW:
                yield from scored(waiting)
                waiting, size = [], 0
        if waiting:
            yield from scored(waiting)

    def scored(waiting: list[tuple]) -> Iterator[tuple]:
        for (doc_id, _), (lang, score) in zip(waiting, network.predict([t for _, t in waiting]), strict=True):
            yield doc_id, lang, score

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), run, f"{id_col} {kind}, lang_pred string, score double")
