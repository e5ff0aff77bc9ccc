"""Language identification by a byte convolutional network in numpy.

Bytes (A-Z lowered) are embedded; filters of width 2, 3 and 4 run over fixed-length windows; each filter's largest response
in a window passes a rectifier, and a softmax layer reads the result. Trained by Adam with gradients written out. A text is
cut into windows, all of them are classified in batches, and its probabilities are the normalised geometric mean of theirs.
For prediction the embedding and filters are folded into tables by byte and by byte pair, so a window needs lookups and
additions only.

Training reads about `rows` texts of each of the `most` most frequent languages (rows with the smallest hashes of doc_id), and of
each text at most PER_TEXT windows, drawn at random: documented bounds. Rows held out never teach. Languages with very few texts are
learned from those they have.

Defined cases: null text or a text without a letter is `und` with score 0; texts of any length are read whole; null languages
teach nothing; with no labelled row every text is `und`; of equally frequent languages at the bound the first by name is learned, of
equally likely ones the first by name is predicted; repeated rows are predicted each, with a null doc_id too, which is not held out;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.llm.common import _LOWER, crc_mod, slices, table

#: Bytes of a window, embedding size, filters of each width, widths.
WINDOW, EMBED, FILTERS, WIDTHS = 192, 8, 16, (2, 3, 4)
#: Training texts of a language, languages, windows of a text, passes over them.
ROWS, MOST, PER_TEXT, EPOCHS = 400, 200, 8, 6


def windows(texts: list[str | None], length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, blanks at the end of the last one, and the text of each."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    n = np.array([-(-len(r) // length) for r in raw], np.int64)
    data = np.frombuffer(b"".join(r.ljust(int(k) * length) for r, k in zip(raw, n)), np.uint8).reshape(-1, length)
    return _LOWER[data], np.repeat(np.arange(len(raw)), n)


class ByteNetwork:
    """Embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, labels: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.p = {"embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"filter{w}"] = rng.normal(0, (w * EMBED) ** -0.5, (w, EMBED, FILTERS)).astype(np.float32)
            self.p[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.p["out"] = rng.normal(0, 0.15, (len(WIDTHS) * FILTERS, len(labels))).astype(np.float32)
        self.p["out_bias"] = np.zeros(len(labels), np.float32)
        self.pairs = None

    def fold(self) -> None:
        """Tables by byte pair for prediction."""
        self.pairs = {}
        for w in WIDTHS:
            by_byte = [self.p["embed"] @ f for f in self.p[f"filter{w}"]]
            self.pairs[w] = [(by_byte[j][:, None, :] + by_byte[j + 1][None, :, :]).reshape(65536, FILTERS) if j + 1 < w else by_byte[j] for j in range(0, w, 2)]

    def _pooled(self, x: np.ndarray) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        out = []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            r = np.take(self.pairs[w][0], pair[:, :n], axis=0)
            if w == 3:
                r += np.take(self.pairs[w][1], x[:, 2:], axis=0)
            elif w == 4:
                r += np.take(self.pairs[w][1], pair[:, 2:], axis=0)
            out.append(np.maximum(r.max(axis=1) + self.p[f"bias{w}"], 0))
        return np.hstack(out)

    def log_probabilities(self, x: np.ndarray, batch: int = 256) -> np.ndarray:
        """Log probabilities of the labels for each window."""
        if self.pairs is None:
            self.fold()
        out = [np.zeros((0, len(self.labels)), np.float32)]
        for at in range(0, len(x), batch):
            z = self._pooled(x[at : at + batch]) @ self.p["out"] + self.p["out_bias"]
            z -= z.max(axis=1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
        return np.vstack(out)

    def _step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of a batch."""
        p, rows = self.p, np.arange(len(x))[:, None]
        pooled, places = [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            r = sum((p["embed"] @ p[f"filter{w}"][j])[x[:, j : j + n]] for j in range(w))
            at = r.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(r, at[:, None, :], 1)[:, 0] + p[f"bias{w}"])
        h = np.hstack(pooled)
        a = np.maximum(h, 0)
        z = a @ p["out"] + p["out_bias"]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        d = e / e.sum(axis=1, keepdims=True)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g = {"out": a.T @ d, "out_bias": d.sum(0), "embed": np.zeros_like(p["embed"])}
        back = (d @ p["out"].T) * (h > 0)
        for k, w in enumerate(WIDTHS):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            g[f"bias{w}"], g[f"filter{w}"] = own.sum(0), np.zeros_like(p[f"filter{w}"])
            for j in range(w):
                symbol = x[rows, places[k] + j]
                hit = np.zeros((256, FILTERS), np.float32)
                np.add.at(hit, (symbol, np.arange(FILTERS)[None, :]), own)
                g[f"filter{w}"][j] = p["embed"].T @ hit
                g["embed"] += hit @ p[f"filter{w}"][j].T
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.01, seed: int = 11) -> None:
        """Adam over shuffled batches; every language weighs the same."""
        rng = np.random.default_rng(seed)
        first, second, t = {}, {}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                t += 1
                pick = order[at : at + batch]
                for k, g in self._step(x[pick], y[pick]).items():
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                    second[k] = 0.99 * second.get(k, 0) + 0.01 * g * g
                    self.p[k] -= (rate / (1 + epoch)) * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-7)
        self.pairs = None


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text at most PER_TEXT windows, drawn by a seed that the text gives: all that leaves the executors for training."""
    for batch in slices(batches):
        out = []
        for text in batch.column("text"):
            w, _ = windows([text.as_py()])
            out.append(w[np.random.default_rng(zlib.crc32(w.tobytes())).permutation(len(w))[:PER_TEXT]].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(out, pa.binary())], ["doc_id", "lang", "windows"])


def train(docs: DataFrame, rows: int = ROWS, most: int = MOST) -> ByteNetwork | None:
    """A network from about `rows` texts of each of the `most` most frequent languages."""
    own = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_mod("doc_id", 4) != 2)).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()}
    if not counts:
        return None
    share = F.create_map(*(F.lit(v) for k, n in counts.items() for v in (k, min(1.0, rows / n))))
    # The draw goes by the text as well, and equal rows count once: no id and no text brings more than its share.
    picked = own.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000).dropDuplicates()
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = picked.mapInArrow(_drawn, f"doc_id {kind}, lang string, windows binary").toPandas().sort_values(["lang", "doc_id", "windows"], ignore_index=True)
    labels, rng = sorted(counts), np.random.default_rng(3)
    x, y = [], []
    for k, label in enumerate(labels):
        w = np.frombuffer(b"".join(got.loc[got["lang"] == label, "windows"]), np.uint8).reshape(-1, WINDOW)
        w = w[rng.permutation(len(w))]
        if not len(w):
            continue
        w = w[rng.integers(0, len(w), rows * PER_TEXT // 2)] if len(w) < rows * PER_TEXT // 2 else w[: rows * PER_TEXT // 2]
        x.append(w)
        y.append(np.full(len(w), k))
    network = ByteNetwork(labels)
    if x:
        network.fit(np.vstack(x), np.concatenate(y))
    return network


def predicted(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    if network is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    network.pairs = None

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            best, score = [], []
            for at in range(0, len(texts), 256):
                part = texts[at : at + 256]
                w, of = windows(part)
                logs = network.log_probabilities(w)
                n = np.maximum(np.bincount(of, minlength=len(part)), 1)[:, None]
                total = np.zeros((len(part), len(network.labels)))
                np.add.at(total, of, logs)
                mean = total / n
                p = np.exp(mean - mean.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                for t, row in zip(part, p):
                    k = int(row.argmax())
                    best.append("und" if t is None else network.labels[k])
                    score.append(0.0 if t is None else float(row[k]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predicted(docs, train(docs)).select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
