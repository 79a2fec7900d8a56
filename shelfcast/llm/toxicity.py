"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

A character trigram model is counted over all documents. In each text, stretches that look disguised (symbols or
digits inside words, letters spaced out, letters repeated three times or more) become character lattices: a symbol
may stand for a letter, a separator for nothing, a repeated letter for one. A Viterbi search takes the reading that
channel and character model together make likeliest. The score is a logistic model over word stems that occur in the
plain or the restored text; stems and weights are learnt on a bounded sample of labelled documents.

Defined results: a null or empty text has no stems; without labels of both values the score is the share of label 1,
or 0; rows that repeat give a row each; other columns are ignored or, if asked for, kept; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import annotate, bounded_batches, held_out, raw_texts, slices, table
from shelfcast.llm.samples import labelled_texts, unpacked

#: Bounds on the labelled documents, of each label, that training reads.
SAMPLE_DOCS = {1: 2500, 0: 3500}
THRESHOLD = 0.5
STEM_CHARS = range(4, 9)
#: Each toxic training document is to be covered by so many stems; a stem must add this share of documents.
COVER, LEAST_SHARE, LEAST_DOCS = 6, 0.008, 4
#: Share of clean among the documents with a stem, at most.
IMPURE = 0.01
#: Log odds of a text without stems, before training.
START = -3.0
MEMORY_TOKENS = 100_000
#: Characters of a disguised stretch up to which a task remembers its reading.
MEMORY_CHARS = 48
#: Characters after which a lattice hands on what all its readings agree on.
SETTLE_CHARS = 32
SEPARATOR = 0xFF  # never in UTF-8

SYMBOLS = 28  # 0: anything that is no letter, 1-26: a-z, 27: other letters
SYMBOL = np.zeros(256, np.uint8)
SYMBOL[0x61:0x7B] = np.arange(1, 27)
SYMBOL[0x41:0x5B] = np.arange(1, 27)
SYMBOL[0x80:0xFF] = 27
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
PLAIN = np.full(256, 0x20, np.uint8)  # letters in lower case, all else a space
PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
PLAIN[0x80:0xFF] = np.arange(0x80, 0xFF)

#: Letters that a symbol may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "aeiou",
}
SEPARATORS = " ._-*"
LOG = np.log
KEEP, SWAP, SAME, DROP, SPLIT, JOIN = LOG(0.9), LOG(0.5), LOG(0.0003), LOG(0.6), LOG(0.1), LOG(0.9)
IS_LEET = np.zeros(256, bool)
IS_LEET[[ord(c) for c in LEET]] = True
IS_LETTER = np.zeros(256, bool)
IS_LETTER[0x61:0x7B] = True
IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[[ord(c) for c in SEPARATORS]] = True
IS_BREAK = np.zeros(256, bool)
IS_BREAK[list(b" \t\r\n\x0b\x0c,;:?()\"/\\")] = True
IS_BREAK[SEPARATOR] = True


def trigram_counts(documents: DataFrame, text_column: str = "text") -> np.ndarray:
    """Counts (28, 28, 28) of character trigrams of all texts; each task returns its sums only."""
    size = SYMBOLS**3

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for part in slices(batches, "text"):
            data = np.frombuffer(b"\xff\xff" + b"\xff\xff".join(raw_texts(part.column("text"))) + b"\xff\xff", np.uint8)
            s = SYMBOL[data].astype(np.int32)
            total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["code", "n"])

    rows = (
        documents.select(F.col(text_column).cast("string").alias("text"))
        .mapInArrow(counted, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    )
    out = np.zeros(size)
    for r in rows:  # 28**3 rows at most
        out[r["code"]] = r["n"]
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


class Channel:
    """Viterbi decoder of disguised stretches under trigram counts."""

    def __init__(self, counts: np.ndarray):
        uni = counts.sum(axis=(0, 1)) + 1.0
        bi = counts.sum(axis=0) + 20 * uni / uni.sum()
        tri = counts + 5 * (bi / bi.sum(axis=1, keepdims=True))[None]
        self.model = LOG(tri / tri.sum(axis=2, keepdims=True)).tolist()
        self.known: dict[str, str] = {}

    def restore(self, stretch: str) -> str:
        if (found := self.known.get(stretch)) is None:
            found = self._viterbi(stretch)
            if len(self.known) >= MEMORY_TOKENS:
                self.known.clear()
            if len(stretch) <= MEMORY_CHARS:
                self.known[stretch] = found
        return found

    def _readings(self, c: str, before: str, spaced: bool) -> list[tuple[str, float]]:
        """What an observed character may stand for ('' for nothing) and the channel's log probability."""
        if "a" <= c <= "z":
            return [(c, KEEP), ("", DROP)] if c == before else [(c, KEEP)]
        out = [(x, SWAP - LOG(len(LEET[c]))) for x in LEET[c]] if c in LEET else []
        if spaced and c in SEPARATORS:
            return [*out, ("", JOIN), (" ", SPLIT)]
        return [*out, ("", DROP if c == before else SAME - 3), (c if c >= "\x80" else " ", KEEP if c >= "\x80" else SAME)]

    def _viterbi(self, stretch: str) -> str:
        """The likeliest reading of a whole stretch, however long: readings that are still open carry on, and the
        beginning that they share is put aside from time to time."""
        settled: list[str] = []
        spaced = sum(c in SEPARATORS for c in stretch) * 3 >= len(stretch)
        states = {(0, 0): (0.0, "")}
        before = ""
        for n, c in enumerate(stretch, 1):
            options, new = self._readings(c, before, spaced), {}
            for (a, b), (score, text) in states.items():
                row = self.model[a][b]
                for out, cost in options:
                    if not out:
                        key, value = (a, b), score + cost
                    else:
                        s = ord(out) - 96 if "a" <= out <= "z" else 27 if out >= "\x80" else 0
                        key, value = (b, s), score + cost + row[s]
                    if key not in new or value > new[key][0]:
                        new[key] = (value, text + out)
            states = new
            if not (spaced and c in SEPARATORS):
                before = c
            if n % SETTLE_CHARS == 0:
                same = len(commonprefix([text for _, text in states.values()]))
                settled.append(next(iter(states.values()))[1][:same])
                states = {key: (score, text[same:]) for key, (score, text) in states.items()}
        model = self.model
        last = max((score + model[a][b][0], text) for (a, b), (score, text) in states.items())[1]
        return "".join(settled) + last


def disguised(data: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) of lower-cased bytes that look disguised."""
    letter, leet = IS_LETTER[data], IS_LEET[data]
    inside = np.zeros(len(data), bool)
    inside[1:-1] = leet[1:-1] & (letter[:-2] | leet[:-2]) & (letter[2:] | leet[2:]) & (letter[:-2] | letter[2:])
    start = np.zeros(len(data), bool)
    start[1:-2] = leet[1:-2] & IS_BREAK[data[:-3]] & letter[2:-1] & (letter[3:] | leet[3:])
    triple = np.zeros(len(data), bool)
    triple[2:] = letter[2:] & (data[2:] == data[1:-1]) & (data[2:] == data[:-2])
    breaks = np.flatnonzero(IS_BREAK[data])
    marks = np.flatnonzero(inside | start | triple)
    at = np.searchsorted(breaks, marks)
    found = {(int(breaks[i - 1]) + 1, int(breaks[i])) for i in np.unique(at) if 0 < i < len(breaks)}
    one = letter | leet
    apart = np.ones(len(data), bool)  # neither neighbour is of a word
    apart[1:] &= ~one[:-1] | IS_SEPARATOR[data[:-1]]
    apart[:-1] &= ~one[1:] | IS_SEPARATOR[data[1:]]
    single = np.flatnonzero(one & apart & ~IS_SEPARATOR[data])
    if len(single) > 2:
        near = (np.diff(single) == 2) & IS_SEPARATOR[data[single[:-1] + 1]]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], near.astype(np.int8), [0]])))
        found |= {(int(single[a]), int(single[b]) + 1) for a, b in zip(edge[::2], edge[1::2]) if b - a >= 2}
    return sorted(found)


def plain_and_restored(texts: list[bytes], channel: Channel) -> tuple[str, np.ndarray]:
    """All words of the texts in one string, each text's restored words after its own; ends of the texts in it."""
    data = LOWER[np.frombuffer(b" \xff " + b" \xff ".join(texts) + b" \xff ", np.uint8)]
    marks = np.flatnonzero(data == SEPARATOR)
    extra: dict[int, list[str]] = {}
    stretches = disguised(data)
    owners = (np.searchsorted(marks, [s for s, _ in stretches]) - 1).tolist() if stretches else []
    for d, (a, b) in zip(owners, stretches):
        if 0 <= d < len(texts):
            extra.setdefault(d, []).append(channel.restore(data[a:b].tobytes().decode("latin-1")))
    plain = PLAIN[data].tobytes().decode("latin-1")
    parts, ends, held = [], [], 0
    for d in range(len(texts)):
        part = plain[marks[d] : marks[d + 1]]
        if d in extra:
            part += " " + " ".join(extra[d]) + " "
        held += len(part)
        parts.append(part)
        ends.append(held)
    return "".join(parts), np.array(ends, np.int64)


def stems_of(words: str) -> set[str]:
    """Every stem of 4 to 8 characters, and shorter words whole, each with the space before it."""
    out = set()
    for w in set(words.split()):
        if len(w) < STEM_CHARS[0]:
            out.add(f" {w} ")
        else:
            out.update(" " + w[:k] for k in STEM_CHARS if k <= len(w))
    return out


def choose_stems(toxic: list[str], clean: list[str]) -> list[str]:
    """Stems that together cover each toxic text COVER times, greedily, among those rare in clean texts."""
    least = max(LEAST_DOCS, int(LEAST_SHARE * len(toxic)))
    a: Counter = Counter()
    for words in toxic:
        a.update(stems_of(words))
    a = Counter({s: n for s, n in a.items() if n >= least})
    b: Counter = Counter()
    for words in clean:
        b.update(stems_of(words) & a.keys())
    scale = max(1, len(toxic)) / max(1, len(clean))
    pure = {s for s, n in a.items() if b[s] * scale <= IMPURE * n}
    holds: dict[str, list[int]] = {}
    for i, words in enumerate(toxic):
        for s in stems_of(words) & pure:
            holds.setdefault(s, []).append(i)
    where = {s: np.array(v) for s, v in holds.items()}
    need, chosen = np.full(len(toxic), COVER), []
    cost = {s: 10 * b[s] * scale for s in pure}
    gains = {s: len(v) - cost[s] for s, v in where.items()}
    while gains:
        best = max(gains, key=lambda s: (gains[s], len(s), s))
        real = int((need[where[best]] > 0).sum()) - cost[best]
        if real < gains[best]:  # gains only fall; count again before taking
            gains[best] = real
            if real < least:
                del gains[best]
            continue
        chosen.append(best)
        need[where[best]] = np.maximum(need[where[best]] - 1, 0)
        for s in [s for s in gains if s.startswith(best) or best.startswith(s)]:
            del gains[s]  # a longer or shorter form says the same
    return chosen


class Scorer:
    def __init__(self, model: dict, channel: Channel):
        import ahocorasick

        self.model, self.channel, self.finder = model, channel, None
        if model["stems"]:
            self.finder = ahocorasick.Automaton()
            for i, stem in enumerate(model["stems"]):
                self.finder.add_word(stem, i)
            self.finder.make_automaton()

    def present(self, texts: list[bytes]) -> np.ndarray:
        """Which stems each text holds."""
        words, ends = plain_and_restored(texts, self.channel)
        out = np.zeros((len(texts), len(self.model["stems"])), bool)
        if self.finder is not None:
            found = list(self.finder.iter(words))
            if found:
                at, stem = np.array(found, np.int64).T
                out[np.searchsorted(ends, at, "right"), stem] = True
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not self.model["stems"]:
            return np.full(len(texts), self.model["base"])
        z = self.present(texts) @ self.model["weights"] + self.model["base"]
        return 1 / (1 + np.exp(-z))


def train(sample: list[tuple[str, int]], channel: Channel) -> dict:
    """Stems and logistic weights from labelled texts; equal texts count once."""
    rows = sorted(set(sample))
    y = np.array([label for _, label in rows], float)
    if len(y) == 0 or y.min() == y.max():
        return {"stems": [], "weights": np.zeros(0), "base": float(y.mean()) if len(y) else 0.0}
    raw = [t.encode() for t, _ in rows]
    words: list[str] = []
    for at in range(0, len(raw), 200):
        joined, ends = plain_and_restored(raw[at : at + 200], channel)
        words += [joined[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
    stems = choose_stems([w for w, v in zip(words, y) if v == 1], [w for w, v in zip(words, y) if v == 0])
    model = {"stems": stems, "weights": np.zeros(len(stems)), "base": float(y.mean())}
    if not stems:
        return model
    scorer = Scorer(model, channel)
    x = np.concatenate([scorer.present(raw[part]) for part in unpacked(raw)]).astype(float)
    hits, misses = x[y == 1].sum(axis=0), x[y == 0].sum(axis=0) * (y == 1).sum() / (y == 0).sum()
    start = LOG((hits + 0.5) / (misses + 0.5))  # a stem seen often and purely decides alone
    w, base = start.copy(), START
    for _ in range(200):  # descent, drawn towards the start
        p = 1 / (1 + np.exp(-np.clip(x @ w + base, -40, 40)))
        w += x.T @ (y - p) / len(y) - 0.02 * (w - start)
        base += 0.2 * float((y - p).mean()) - 0.02 * (base - START)
    return model | {"weights": np.maximum(w, 0), "base": base}


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    rows: dict[int, int] | None = None,
) -> tuple[dict, np.ndarray]:
    """The model, and the character counts of all documents."""
    counts = trigram_counts(documents, text_column)
    sample = labelled_texts(documents, labels, "toxic", rows or SAMPLE_DOCS, id_column, text_column)
    return train(sample, Channel(counts)), counts


def score_toxicity(
    documents: DataFrame, model: dict, counts: np.ndarray, text_column: str = "text",
    keep: tuple[str, ...] = ("doc_id",), name: str = "toxicity",
) -> DataFrame:
    """The columns ``keep`` and a struct ``name``: score (0 to 1)."""

    def make():
        scorer = Scorer(model, Channel(counts))
        return lambda texts: [scorer.score(raw_texts(texts)).tolist()]

    return annotate(documents, text_column, make, "score double", list(keep), name)


def restore_text(text: str, channel: Channel) -> str:
    """A text with its disguised stretches replaced by what they stand for."""
    raw = LOWER[np.frombuffer(b" " + text.encode() + b" ", np.uint8)]
    out, at = [], 0
    for a, b in disguised(raw):
        if a >= at:
            out += [raw[at:a].tobytes(), channel.restore(raw[a:b].tobytes().decode("latin-1")).encode("latin-1")]
            at = b
    out.append(raw[at:].tobytes())
    return re.sub(r"^ | $", "", b"".join(out).decode("utf-8", "replace"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    documents = table(spark, sf_dir, "documents")
    model, counts = fit_toxicity(documents, table(spark, sf_dir, "labels"))
    score = F.col("toxicity.score")
    return score_toxicity(documents.select("doc_id", "text"), model, counts).select(
        "doc_id", held_out("doc_id").alias("held_out"), score.alias("score"),
        F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
