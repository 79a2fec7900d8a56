"""BPE encoding and decoding with a lexicon: frequent words come from a minimal acyclic transducer, others are merged.

Texts of printable ASCII and Latin-1 letters are lowered and cut into words by one pattern. Other texts are cut at ASCII
white space, which neither normalisation nor a word of the tokenizer crosses, and stretches with other characters go
through the tokenizer's own normaliser and pre-tokenizer; the strings of special tokens are cut out first, as the
library does. All words of the table are counted on Spark; the frequent ones are compiled, with their ids as outputs,
into a shared-suffix automaton in one file of the shared folder, which each executor fetches once and its tasks map
into memory. Words that the lexicon lacks are merged exactly, many side by side: in each word the pair of lowest rank
first, the leftmost of equal ones.

The lexicon decides how an id is found, never which: with any lexicon, an empty one too, results are the same.

Defined results: a null text counts as empty (no ids, empty decoded text); a text of any length is encoded whole;
rows that repeat give a row each; kept columns may have any name but that of the result; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import annotate, bounded_batches, store_folder, stored, table
from shelfcast.llm.tokens import load_tokenizer, public_tokenizer
from shelfcast.llm.transducer import Transducer, compile_words

MODEL = "word_bpe_49k.json"
#: A word is frequent if it makes up one in so many of all words that repeat; so there are at most as many.
LEXICON_SHARE = 1 << 18
WORD_CHARS = 48
#: Ids of words, and words of odd stretches, that a task remembers; longer ones than WORD_CHARS never.
MEMORY_ENTRIES = 200_000
#: Bytes of a word from which on merging takes a heap.
HEAP_BYTES = 64
#: Words that are merged side by side at once.
STEP_WORDS = 8192

STRETCH = re.compile(r"[^\t-\r ]+")
# Characters that no neighbour of theirs changes in normalisation; the letters are letters in every Unicode version.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


class Merger:
    """The tokenizer of a file: its words, and their ids by merging."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        expected = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False,
                    "byte_fallback": False, "ignore_merges": False}
        if model["type"] != "BPE" or any(model.get(k) != v for k, v in expected.items()) or described["decoder"]:
            raise ValueError("not a plain BPE of words")
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in described["added_tokens"]):
            raise ValueError("added tokens are not plain strings")
        self.tokenizer = load_tokenizer(path)
        vocabulary = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in described["added_tokens"]}
        strings = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings else None
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(vocabulary[a], vocabulary[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [vocabulary[a + b] for a, b in pairs]
        # The pre-tokenizer writes each byte as one printable character.
        letters = {}
        spare = 256
        for byte in range(256):
            plain = 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255
            letters[byte] = chr(byte if plain else spare)
            spare += not plain
        self.byte_of = {letter: byte for byte, letter in letters.items()}
        self.inner = [vocabulary[letters[b]] for b in range(256)]
        self.last = [vocabulary[letters[b] + suffix] for b in range(256)]
        size = max(*vocabulary.values(), -1) + 1
        keys = np.array([a * (size + 1) + b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        # Pairs of parts as sorted numbers, with their ranks; ``size`` stands for no part.
        self.no_part, self.pair_keys = size, np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array([*self.rank.values()], np.int32)[order], np.int32(len(pairs)))
        self.made_of = np.array(self.made, np.int64)
        self.inner_of, self.last_of = np.array(self.inner, np.int64), np.array(self.last, np.int64)
        self.written = [""] * (max(*vocabulary.values(), *self.added.values(), 0) + 1)
        for token, number in (*vocabulary.items(), *self.added.items()):
            self.written[number] = token

    def is_plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(t in text for t in self.added)

    def words(self, stretch: str) -> list[str | bytes | int]:
        """The words of a stretch, as text if it is plain and else as UTF-8 bytes, and special tokens as ids."""
        if self.is_plain(stretch):
            return WORD.findall(stretch.lower())
        if self.special and self.special.search(stretch):
            out = []
            for part in self.special.split(stretch):
                out += [self.added[part]] if part in self.added else self.words(part) if part else []
            return out
        normal = self.tokenizer.normalizer.normalize_str(stretch)
        byte_of = self.byte_of
        return [bytes([byte_of[c] for c in w]) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word."""
        if not word:
            return []
        part = [*map(self.inner.__getitem__, word[:-1]), self.last[word[-1]]]
        return self._merge_long(part) if len(part) > HEAP_BYTES else self._merge_short(part)

    def _merge_short(self, part: list[int]) -> list[int]:
        none = len(self.made)
        rank_of, made = self.rank.get, self.made
        ranks = [rank_of(pair, none) for pair in zip(part, part[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            part[i] = made[least]
            del part[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((part[i - 1], part[i]), none)
            if i < len(ranks):
                ranks[i] = rank_of((part[i], part[i + 1]), none)
        return part

    def _merge_long(self, part: list[int]) -> list[int]:
        """A heap of mergeable pairs over a linked list of the parts."""
        n = len(part)
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        rank_of = self.rank.get
        heap = [(r, i) for i, r in enumerate(map(rank_of, zip(part, part[1:]))) if r is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if part[i] < 0 or j < 0 or rank_of((part[i], part[j])) != rank:
                continue  # one of the two has been merged since
            part[i], part[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0:
                    found = rank_of((part[left], part[right]))
                    if found is not None:
                        heapq.heappush(heap, (found, left))
        return [p for p in part if p >= 0]

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs a-b of parts; the number of merges where a pair has none."""
        key = a * (self.no_part + 1) + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.int32(len(self.made)))

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes of 32-bit numbers: short words in step, a merge in each at a time."""
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        low = 0
        for high in (6, 8, 10, 12, 16, 24, 32, HEAP_BYTES):
            chosen = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for at in range(0, len(chosen), STEP_WORDS):
                part = chosen[at : at + STEP_WORDS]
                for i, ids in zip(part.tolist(), self._merge_in_step([words[i] for i in part], sizes[part])):
                    out[i] = ids
        for i in np.flatnonzero(sizes > HEAP_BYTES).tolist():
            out[i] = np.array(self.merge(words[i]), np.int32).tobytes()
        return out

    def _merge_in_step(self, words: list[bytes], sizes: np.ndarray) -> list[bytes]:
        """Words as rows of a matrix whose last column is no part; parts are linked lists, a merged one is left out."""
        n, width, none = len(words), int(sizes.max()), len(self.made)
        row, column = np.arange(n), np.arange(width)
        inside = column < sizes[:, None]
        part = np.full((n, width + 1), self.no_part, np.int64)
        part[:, :width][inside] = self.inner_of[np.frombuffer(b"".join(words), np.uint8)]
        part[row, sizes - 1] = self.last_of[np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)]
        after = np.tile(np.append(column + 1, width), (n, 1))
        after[row, sizes - 1] = width
        before = np.tile(np.append(column - 1, width), (n, 1))
        before[:, 0] = width
        rank = np.full((n, width + 1), none, np.int32)
        rank[:, :width] = self.ranks_of(part[:, :-1].ravel(), part[:, 1:].ravel()).reshape(n, width)
        while len(row):
            i = rank[row].argmin(axis=1)
            least = rank[row, i]
            going = least < none
            row, i, least = row[going], i[going], least[going]
            j = after[row, i]
            h, k = before[row, i], after[row, j]
            part[row, i], part[row, j] = self.made_of[least], self.no_part
            after[row, i], before[row, k] = k, i
            rank[row, j] = none
            rank[row, i] = self.ranks_of(part[row, i], part[row, k])
            rank[row, h] = self.ranks_of(part[row, h], part[row, i])
            before[row, width] = after[row, width] = width
        left = part != self.no_part
        ids = part[left].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def decode(self, ids: np.ndarray) -> str:
        """The written tokens with a space between each two: the file has no decoder."""
        written = self.written
        return " ".join([written[i] for i in ids.tolist()])


class Encoder:
    """Texts to ids: words by the lexicon, others by merging; a task looks a word up once while it remembers it."""

    def __init__(self, merger: Merger, lexicon: Transducer):
        self.merger, self.lexicon = merger, lexicon
        self.special = {i: np.array([i], np.int32).tobytes() for i in merger.added.values()}
        self.found: dict[str | bytes | int, bytes] = dict(self.special)
        self.cut: dict[str, list] = {}

    def _odd(self, stretch: str) -> list[str | bytes | int]:
        if stretch not in self.cut:
            words = self.merger.words(stretch)
            if len(stretch) > WORD_CHARS:
                return words
            if len(self.cut) >= MEMORY_ENTRIES:
                self.cut = {}
            self.cut[stretch] = words
        return self.cut[stretch]

    def _words(self, text: str) -> list[str | bytes | int]:
        if self.merger.is_plain(text):
            return WORD.findall(text.lower())
        out = []
        for stretch in STRETCH.findall(text):
            out += WORD.findall(stretch.lower()) if self.merger.is_plain(stretch) else self._odd(stretch)
        return out

    def _look_up(self, words: list[str | bytes]) -> list[bytes]:
        raw = [w if isinstance(w, bytes) else w.encode() for w in words]
        known, ids, places = self.lexicon.lookup(raw)
        packed = np.ascontiguousarray(ids, np.int32).tobytes()
        at = (4 * places).tolist()
        place = iter(zip(at, at[1:]))
        known = known.tolist()
        merged = iter(self.merger.merge_many([w for w, is_known in zip(raw, known) if not is_known]))
        out = []
        for is_known in known:
            if is_known:
                a, b = next(place)
                out.append(packed[a:b])
            else:
                out.append(next(merged))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self._words(t) for t in texts]
        units = set().union(*cut)
        new = list(units.difference(self.found))
        if len(self.found) + len(new) > MEMORY_ENTRIES:
            self.found = dict(self.special)
            new = list(units.difference(self.found))
        self.found.update(zip(new, self._look_up(new)))
        out = [np.frombuffer(b"".join(map(self.found.__getitem__, c)), np.int32) for c in cut]
        for word in new:
            if len(word) > WORD_CHARS:
                del self.found[word]
        if len(self.found) > MEMORY_ENTRIES:  # of a single long text
            self.found = dict(self.special)
        return out


def word_counts(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """word, n: runs of letters in lower case over whole texts; sums are combined before the shuffle."""
    words = F.regexp_extract_all(F.lower(F.col(text_column).cast("string")), F.lit(r"\p{L}+"), F.lit(0))
    return (
        documents.select(F.explode(words).alias("word")).where(F.length("word") <= WORD_CHARS)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )


def put_file(spark: SparkSession, content: bytes, name: str) -> str:
    """Write a file into the shared folder, whatever file system that is on, and hand it to every executor.

    Returns the name under which tasks find it; Spark fetches it again for an executor that comes later.
    """
    name = f"{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{store_folder(spark)}/{name}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def build_lexicon(
    documents: DataFrame, text_column: str = "text", model: str = MODEL, share: int = LEXICON_SHARE
) -> str:
    """Compile the frequent words of all texts, at most ``share`` of them; returns the file's name."""
    merger = Merger(public_tokenizer(model))
    counted = stored(word_counts(documents, text_column).where("n > 1"), "lexicon-words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    frequent = counted.where(F.col("n") * share >= total).collect()  # at most ``share`` rows
    words = {w if isinstance(w, bytes) else w.encode() for r in frequent for w in merger.words(r["word"])}
    content = compile_words((w, tuple(merger.merge(w))) for w in sorted(words))
    return put_file(documents.sparkSession, content, "lexicon")


FIELDS = "ids array<int>, n_tokens bigint, decoded string"


def encode_words(
    documents: DataFrame, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",), model: str = MODEL,
    name: str = "encoded", lexicon: str | None = None,
) -> DataFrame:
    """The columns ``keep`` and a struct ``name``: ids, their number, and the text that they decode to.

    ``lexicon`` is a file of ``build_lexicon``; without one it is built from the documents.
    """
    lexicon = lexicon or build_lexicon(documents, text_column, model)

    def make():
        merger = Merger(public_tokenizer(model))
        encoder = Encoder(merger, Transducer.open(SparkFiles.get(lexicon)))

        def compute(texts: pa.Array) -> list:
            ids = encoder.encode([t or "" for t in texts.to_pylist()])
            sizes = [len(i) for i in ids]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), sizes, list(map(merger.decode, ids))]

        return compute

    return annotate(documents, text_column, make, FIELDS, list(keep), name)


def decode_words(
    encoded: DataFrame, ids_column: str, keep: tuple[str, ...] = ("doc_id",), model: str = MODEL, name: str = "text"
) -> DataFrame:
    """The columns ``keep`` and the decoded text of an array of ids; a null array gives an empty text."""
    source = encoded.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids_column}`").alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(public_tokenizer(model))
        for batch in batches:
            texts = [merger.decode(np.array(ids or [], np.int32)) for ids in batch.column(name).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(texts, pa.string())], [*keep, name]
            )

    ddl = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{ddl}, `{name}` string")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids, a space between), decoded_sha256."""
    bounded_batches(spark)
    found = encode_words(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "encoded.n_tokens",
        F.sha2(F.concat_ws(" ", F.col("encoded.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("encoded.decoded"), 256).alias("decoded_sha256"),
    )
