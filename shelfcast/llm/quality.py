"""Quality classifier: a linear-chain conditional random field labels every line of a text good or bad.

Each line has shape features (length, words, case, symbols, repetition, ending), cut into bins; a line's score adds
the bins of the line itself, of the one before and of the one after. Training takes the document's label for each of
its lines and climbs the exact likelihood (forward-backward). A document's quality is the mean of the lines'
marginals, weighted by their length, mapped to a probability by a logistic fit on the training documents.

Defined results: a null or empty text is one empty line; without labels (or with one value only) the score is the
share of label 1, or 0.5; rows that repeat give a row each; other columns are ignored or, if asked for, kept; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import annotate, bounded_batches, held_out, raw_texts, table
from shelfcast.llm.samples import labelled_texts, unpacked

#: Bound on the labelled documents that training reads.
SAMPLE_DOCS = 5000
BINS = 8
ROUNDS = 160
RATE = 0.08
PENALTY = 1e-4
THRESHOLD = 0.3
HASH = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
SEPARATOR = 0xFF  # never in UTF-8

#: Byte classes that are counted in each line.
CLASSES = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "stop": b".?;:",
    "comma": b",",
    "shout": b"!",
    "pipe": b"|",
    "symbol": b"#$%&*+<=>@[\\]^_`{}~/",
    "quote": b"\"'()-",
    "high": range(0x80, 0xC0),
}
NAMES = list(CLASSES)
CLASS = np.full(256, len(NAMES), np.uint8)
for _i, _members in enumerate(CLASSES.values()):
    CLASS[list(_members)] = _i
SPACE = np.zeros(256, bool)
SPACE[list(b" \t\r\n\x0b\x0c")] = True
SPACE[SEPARATOR] = True
N_FEATURES = len(NAMES) + 6


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """HASH and its inverse to the powers 0 .. n-1, modulo 2**64."""
    inverse = np.uint64(pow(int(HASH), -1, 1 << 64))
    out = []
    for base in (HASH, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines, N_FEATURES), length in bytes and document number of every line, in order."""
    data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    n = len(data)
    ends = np.flatnonzero((data == 0x0A) | (data == SEPARATOR))
    begins = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - begins
    owner = np.concatenate([[0], np.cumsum(data[ends] == SEPARATOR)[:-1]])
    n_lines = len(ends)
    line_of = np.repeat(np.arange(n_lines), lengths + 1)
    counts = np.bincount(
        line_of * (len(NAMES) + 1) + CLASS[data], minlength=n_lines * (len(NAMES) + 1)
    ).reshape(n_lines, -1)[:, : len(NAMES)]
    space = SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    stops = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    up, down = _powers(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * up[:n], dtype=np.uint64)])
    word = (sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64)
    word_line = line_of[starts]
    words = np.bincount(word_line, minlength=n_lines)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (word_line[1:] == word_line[:-1])
    repeats = np.bincount(word_line[same], minlength=n_lines)
    pair = np.zeros(len(word), np.uint64)
    pair[1:] = word[1:] * HASH + word[:-1]
    word_doc = owner[word_line]
    order = np.lexsort((pair, word_doc))
    again = np.zeros(len(word), bool)
    if len(word):
        a, b = order[1:], order[:-1]
        again[a] = (pair[a] == pair[b]) & (word_doc[a] == word_doc[b])
    echoes = np.bincount(word_line[again], minlength=n_lines)
    last = data[np.maximum(ends - 1, 0)]
    size, many = np.maximum(lengths, 1), np.maximum(words, 1)
    features = np.column_stack([
        counts / size[:, None],
        np.log1p(lengths), words, lengths / many, repeats / many, echoes / many,
        np.where(lengths > 0, np.isin(last, list(b".?!")) * 1.0, 0.5),
    ])
    return features, lengths, owner


def to_bins(features: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bin number of each feature, distinct across features; cuts (features, BINS - 1)."""
    out = np.empty(features.shape, np.int64)
    for j in range(features.shape[1]):
        out[:, j] = np.searchsorted(cuts[j], features[:, j], "right") + j * BINS
    return out


def chain_scores(bins: np.ndarray, owner: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of 'good' of every line; weights (3, bins): the line's own, the one before's, the one after's."""
    own, before, after = (w[bins].sum(axis=1) for w in weights)
    score = own.copy()
    linked = owner[1:] == owner[:-1]
    score[1:] += np.where(linked, before[:-1], 0)
    score[:-1] += np.where(linked, after[1:], 0)
    return score


def _layout(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line and number of lines of each document, longest documents first."""
    docs, first, size = np.unique(owner, return_index=True, return_counts=True)
    order = np.argsort(-size, kind="stable")
    return docs[order], first[order], size[order]


def marginals(score: np.ndarray, owner: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and expected counts of the four transitions, by forward-backward over all documents
    at once; step t takes the documents that have more than t lines."""
    _, first, size = _layout(owner)
    fwd = np.zeros((len(score), 2))
    bwd = np.zeros((len(score), 2))
    emit = np.column_stack([np.zeros(len(score)), score])
    fwd[first] = emit[first] - np.logaddexp(0, score[first])[:, None]
    alive = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size.max()))] if len(size) else []
    for t in range(1, len(alive)):
        now = first[: alive[t]] + t
        prev = fwd[now - 1]
        step = np.logaddexp(prev[:, :1] + link[0], prev[:, 1:] + link[1]) + emit[now]
        fwd[now] = step - np.logaddexp(step[:, 0], step[:, 1])[:, None]
    pairs = np.zeros((2, 2))
    for t in range(len(alive) - 1, 0, -1):
        now = first[: alive[t]] + t
        ahead = emit[now] + bwd[now]
        joint = fwd[now - 1][:, :, None] + link[None] + ahead[:, None, :]
        top = joint.max(axis=(1, 2), keepdims=True)
        part = np.exp(joint - top)
        pairs += (part / part.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = np.logaddexp(link[:, 0] + ahead[:, :1], link[:, 1] + ahead[:, 1:])
        bwd[now - 1] = back - np.logaddexp(back[:, 0], back[:, 1])[:, None]
    total = fwd + bwd
    return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -60, 60))), pairs


def document_means(good: np.ndarray, lengths: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    weight = lengths + 1.0
    return np.bincount(owner, good * weight, docs) / np.bincount(owner, weight, docs)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _sample_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """line_features of many texts, a bounded number of bytes at a time."""
    parts = [(part.start, line_features(texts[part])) for part in unpacked(texts)]
    return (
        np.concatenate([f for _, (f, _, _) in parts]), np.concatenate([n for _, (_, n, _) in parts]),
        np.concatenate([o + at for at, (_, _, o) in parts]),
    )


def train(texts: list[bytes], labels: list[int]) -> dict:
    """Cuts, weights, transitions and the logistic fit."""
    y = np.array(labels, float)
    if len(y) == 0 or y.min() == y.max():
        return {"constant": float(y.mean()) if len(y) else 0.5}
    features, lengths, owner = _sample_features(texts)
    cuts = np.sort(np.quantile(features, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T, axis=1)
    for j, row in enumerate(cuts):  # rare values matter: quantiles of what differs from the commonest value
        some = features[features[:, j] != np.median(features[:, j]), j]
        if len(some) and len(np.unique(row)) < BINS // 2:
            cuts[j] = np.sort(np.quantile(some, np.linspace(0, 1, BINS + 1)[1:-1]))
    bins = to_bins(features, cuts)
    b, o, target = bins, owner, y[owner]
    weight = (1.0 / np.bincount(o))[o]  # documents count alike
    linked = o[1:] == o[:-1]
    params = {"w": np.zeros((3, N_FEATURES * BINS)), "a": np.zeros((2, 2))}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    seen = np.array([[np.sum(linked & (target[1:] == j) & (target[:-1] == i)) for j in (0, 1)] for i in (0, 1)])
    docs = o.max() + 1
    for r in range(1, ROUNDS + 1):
        good, pairs = marginals(chain_scores(b, o, params["w"]), o, params["a"])
        error = (target - good) * weight
        after = np.concatenate([error[1:] * linked, [0.0]])
        before = np.concatenate([[0.0], error[:-1] * linked])
        flat = b.ravel()
        size = N_FEATURES * BINS
        g = np.stack([np.bincount(flat, np.repeat(e, N_FEATURES), size) for e in (error, after, before)])
        grads = {"w": g / docs - PENALTY * params["w"], "a": (seen - pairs) / max(1, linked.sum()) - PENALTY * params["a"]}
        for k, v in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            params[k] = params[k] + RATE * (first[k] / (1 - 0.9**r)) / (np.sqrt(second[k] / (1 - 0.99**r)) + 1e-8)
    good, _ = marginals(chain_scores(bins, owner, params["w"]), owner, params["a"])
    x = _logit(document_means(good, lengths, owner, len(texts)))
    x = np.column_stack([x, np.ones(len(x))])
    fit = np.array([1.0, 0.0])
    for _ in range(30):  # Newton steps of the logistic fit
        p = 1 / (1 + np.exp(-x @ fit))
        h = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + 1e-3 * np.eye(2)
        fit = fit + np.linalg.solve(h, x.T @ (y - p) - 1e-3 * fit)
    return {"cuts": cuts, "fit": fit} | params


def score_texts(texts: list[bytes], model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    features, lengths, owner = line_features(texts)
    score = chain_scores(to_bins(features, model["cuts"]), owner, model["w"])
    good, _ = marginals(score, owner, model["a"])
    mean = document_means(good, lengths, owner, len(texts))
    return 1 / (1 + np.exp(-(_logit(mean) * model["fit"][0] + model["fit"][1])))


def fit_quality(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    rows: int = SAMPLE_DOCS,
) -> dict:
    """Train on at most ``rows`` labelled documents outside the held-out fold."""
    sample = labelled_texts(documents, labels, "quality", rows, id_column, text_column)
    return train([t.encode() for t, _ in sample], [q for _, q in sample])


def score_quality(
    documents: DataFrame, model: dict, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",),
    name: str = "quality",
) -> DataFrame:
    """The columns ``keep`` and a struct ``name``: score (0 to 1)."""

    def make():
        return lambda texts: [score_texts(raw_texts(texts), model).tolist() if len(texts) else []]

    return annotate(documents, text_column, make, "score double", list(keep), name)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    documents = table(spark, sf_dir, "documents")
    model = fit_quality(documents, table(spark, sf_dir, "labels"))
    score = F.col("quality.score")
    return score_quality(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), score.alias("score"),
        F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
