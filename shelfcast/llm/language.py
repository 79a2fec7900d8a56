"""Language ID: a byte convolutional network, trained in numpy on labelled text.

One-hot bytes, filters of several widths, rectifier, max pooling over a window, softmax over the languages seen.
Training takes windows of at most SAMPLE_DOCS labelled documents. For prediction every byte of a text lies in one
of its fixed-length windows; windows run in batches, with the filters folded into lookup tables by byte pair. The
document's probabilities are the mean over windows, weighted by their bytes.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if there is nothing
to learn from; rows that repeat give a row each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import annotate, bounded_batches, held_out, raw_texts, table
from shelfcast.llm.samples import hash_sample

#: Bound on the labelled documents that training reads.
SAMPLE_DOCS = 1200
WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EPOCHS = 6
BATCH = 64
RATE = 0.004
#: Windows whose filter responses are held at once.
WINDOW_BATCH = 256
UNKNOWN = "und"


def window_bytes(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows (rows of bytes, zero padded), the text of each, the bytes in each."""
    counts = np.array([max(1, -(-len(t) // size)) for t in texts], np.int64)
    flat = b"".join(t.ljust(int(c) * size, b"\0") for t, c in zip(texts, counts))
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    lengths = np.array([len(t) for t in texts])[owner] - nth * size
    return np.frombuffer(flat, np.uint8).reshape(-1, size), owner, np.clip(lengths, 0, size)


def responses(x: np.ndarray, kernel: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Filter outputs (windows, places, filters) of kernel (width, 256, filters)."""
    width = len(kernel)
    places = x.shape[1] - width + 1
    out = kernel[0][x[:, :places]] + bias
    for j in range(1, width):
        out += kernel[j][x[:, j : j + places]]
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> dict | None:
    """Parameters of the network; None without labelled texts."""
    names = sorted(set(labels))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    x, owner, _ = window_bytes(texts)
    y = np.array([names.index(v) for v in labels])[owner]
    p = {}
    for w in WIDTHS:
        p[f"k{w}"] = rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32)
        p[f"b{w}"] = np.zeros(FILTERS, np.float32)
    p["v"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(names))).astype(np.float32)
    p["c"] = np.zeros(len(names), np.float32)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            xb, yb = x[rows], y[rows]
            pooled, peaks = [], []
            for w in WIDTHS:
                r = responses(xb, p[f"k{w}"], p[f"b{w}"])
                peak = r.argmax(axis=1)
                peaks.append(peak)
                pooled.append(np.maximum(np.take_along_axis(r, peak[:, None], 1)[:, 0], 0))
            h = np.concatenate(pooled, axis=1)
            d = softmax(h @ p["v"] + p["c"])
            d[np.arange(len(yb)), yb] -= 1
            d /= len(yb)
            grads = {"v": h.T @ d, "c": d.sum(axis=0)}
            dh = (d @ p["v"].T) * (h > 0)
            for i, w in enumerate(WIDTHS):
                part, peak = dh[:, i * FILTERS : (i + 1) * FILTERS], peaks[i]
                g = np.zeros_like(p[f"k{w}"])
                f = np.broadcast_to(np.arange(FILTERS), part.shape)
                for j in range(w):
                    np.add.at(g[j], (np.take_along_axis(xb, peak + j, 1), f), part)
                grads[f"k{w}"], grads[f"b{w}"] = g, part.sum(axis=0)
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
    used = np.zeros(256, bool)
    used[np.unique(x)] = True
    return {"names": names, "used": used} | p


class Predictor:
    """The network with its filters folded into tables by pair of byte codes; unseen bytes share a code."""

    def __init__(self, model: dict):
        self.model, self.names = model, model["names"]
        seen = np.flatnonzero(model["used"])
        self.code = np.zeros(256, np.int32)
        self.code[seen] = np.arange(1, len(seen) + 1)
        self.n = n = len(seen) + 1
        self.tables = {}
        for w in WIDTHS:
            kernel = np.zeros((w, n, FILTERS), np.float32)
            kernel[:, 1:] = model[f"k{w}"][:, seen]
            kernel[0] += model[f"b{w}"]
            tables = [(kernel[j][:, None] + kernel[j + 1][None]).reshape(n * n, FILTERS) for j in range(0, w - 1, 2)]
            self.tables[w] = (tables, kernel[w - 1] if w % 2 else None)

    def windows(self, x: np.ndarray) -> np.ndarray:
        codes = self.code[x]
        pairs = codes[:, :-1] * self.n + codes[:, 1:]
        pooled = []
        for w in WIDTHS:
            places = x.shape[1] - w + 1
            tables, single = self.tables[w]
            r = np.take(tables[0], pairs[:, :places], axis=0)
            for j, t in enumerate(tables[1:], 1):
                r += np.take(t, pairs[:, 2 * j : 2 * j + places], axis=0)
            if single is not None:
                r += np.take(single, codes[:, w - 1 :], axis=0)
            pooled.append(np.maximum(r.max(axis=1), 0))
        return softmax(np.concatenate(pooled, axis=1) @ self.model["v"] + self.model["c"])

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of each text."""
        x, owner, sizes = window_bytes(texts)
        total = np.zeros((len(texts), len(self.names)))
        for at in range(0, len(x), WINDOW_BATCH):
            part = slice(at, at + WINDOW_BATCH)
            np.add.at(total, owner[part], self.windows(x[part]) * np.maximum(sizes[part], 1)[:, None])
        return total / total.sum(axis=1, keepdims=True)


def fit_language(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    rows: int = SAMPLE_DOCS,
) -> dict | None:
    """Train on all windows of at most ``rows`` documents outside the held-out fold."""
    known = documents.where(
        ~held_out(id_column) & F.col(lang_column).isNotNull() & F.col(text_column).rlike(r"\p{L}")
    )
    taken = hash_sample(known.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("said"),
    ), "id", rows).collect()
    pairs = sorted((r["text"], r["said"]) for r in taken)
    return train([text.encode() for text, _ in pairs], [said for _, said in pairs])


def predict_language(
    documents: DataFrame, model: dict | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id, lang_pred, score for every row, from the text alone."""
    letters = pa.compute.match_substring_regex

    def make():
        predictor = Predictor(model) if model else None

        def compute(texts: pa.Array) -> list:
            some = pa.compute.fill_null(letters(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if predictor and some.any():
                raw = raw_texts(texts)
                at = np.flatnonzero(some)
                p = predictor.texts([raw[i] for i in at])
                for i, row in zip(at.tolist(), p):
                    best = int(row.argmax())
                    names[i], scores[i] = predictor.names[best], float(min(1.0, row[best]))
            return [names, scores]

        return compute

    out = annotate(documents, text_column, make, "lang_pred string, score double", [id_column], "found")
    return out.select(id_column, "found.lang_pred", "found.score")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    documents = table(spark, sf_dir, "documents")
    found = predict_language(documents.select("doc_id", "text"), fit_language(documents))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
