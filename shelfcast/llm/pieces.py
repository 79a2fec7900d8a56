"""SentencePiece encoding and decoding through the tokenizers library, rebuilt from the model's protobuf.

``parse_model`` reads the wire format of the model file itself: pieces with scores and kinds, trainer and normaliser
settings. From it the backend is rebuilt: the normaliser (prefix space, space to the metaspace marker, extra white
space if the model removes it), the scores as a unigram model or as BPE merges in the order of the scores, and byte
fallback. Because no piece holds a marker after another character, text can be cut before each run of markers without
changing its pieces; so distinct stretches are encoded once, many to a string, in batches, by the library's threads. ``verify_parity``
compares with the sentencepiece library.

User-defined pieces are taken out of the text first, the longest at each place, since the model never merges or splits
them. The scores of a unigram model are summed in single precision from the beginning of a text, which decides between
readings of equal score; the backend sums doubles, so ``Lattice`` reads whole texts for such a model instead.

What could not be exact is refused by name: a compiled character map other than identity, unused pieces, user-defined
pieces with a space or marker or in a unigram model, model types other than unigram and BPE.

Defined results: a null text counts as empty (no pieces); rows that repeat give a row each; other columns are
ignored; strings of control pieces inside texts are ordinary text; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import annotate, bounded_batches, table
from shelfcast.llm.tokens import byte_balanced, public_tokenizer

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Piece kinds of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Model types of the model format (fixed values).
UNIGRAM, BPE = 1, 2
#: Stretches that a task remembers, and the longest one it remembers.
MEMORY_STRETCHES = 200_000
MEMORY_CHARS = 64
#: Bytes of words that are encoded as one string of the batch.
RUN_BYTES = 16_384
#: Threads of the library within one task.
THREADS = 2
#: What an unknown character costs below the worst piece of a unigram model (fixed value).
UNKNOWN_COST = 10.0
SINGLE = struct.Struct("f")
STRETCH = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            yield number, data[at : at + size]
            at += size
        elif wire == 2:
            size = varint()
            yield number, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {wire} is not part of a model file")


def parse_model(data: bytes) -> dict:
    """Pieces [(text, score, kind)] and the settings that encoding needs. Numbers are those of the model format."""
    out = {
        "pieces": [], "type": UNIGRAM, "byte_fallback": False, "prefix": True, "squeeze": True, "escape": True,
        "charsmap": b"", "unknown": 0, "suffix": False,
    }
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            out["pieces"].append((piece[1].decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
            out["type"] = trainer.get(3, UNIGRAM)
            out["byte_fallback"] = bool(trainer.get(35, 0))
            out["suffix"] = bool(trainer.get(24, 0))
            out["unknown"] = trainer.get(40, 0)
        elif number == 3:
            normaliser = dict(fields(value))
            out["charsmap"] = normaliser.get(2, b"")
            out["prefix"] = bool(normaliser.get(3, 1))
            out["squeeze"] = bool(normaliser.get(4, 1))
            out["escape"] = bool(normaliser.get(5, 1))
    return out


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """BPE merges: every split of a piece into two pieces; better-scored pieces first."""
    rank = {p: (-score, i) for i, (p, score, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
    found = []
    for piece, key in rank.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in rank and right in rank:
                found.append((key, rank[left], rank[right], left, right))
    found.sort()
    return [(left, right) for *_, left, right in found]


def normalise(text: str, model: dict) -> str:
    """What the model's normaliser makes of a text."""
    if not text:
        return ""
    if model["squeeze"]:
        text = re.sub(" +", " ", text.strip(" "))
    if model["prefix"] and text:
        text = text + " " if model["suffix"] else " " + text
    return text.replace(" ", MARK) if model["escape"] else text


def cuttable(model: dict) -> bool:
    """Whether no piece can cross into a run of markers."""
    pieces = [p for p, _, kind in model["pieces"] if kind in (NORMAL, USER)]
    return model["escape"] and not model["suffix"] and not any(MARK in p.lstrip(MARK) for p in pieces)


def backend(model: dict, words: bool = False):
    """The tokenizers model for already normalised stretches; ``words``: for strings of words, cut at each marker."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    from tokenizers import Tokenizer, models, pre_tokenizers

    if model["charsmap"]:
        raise ValueError("the model's compiled character map is not supported")
    pieces = model["pieces"]
    for piece, _, kind in pieces:
        if kind == UNUSED:
            raise ValueError(f"unused piece {piece!r} is not supported")
        if kind == USER and (model["type"] == UNIGRAM or " " in piece or MARK in piece):
            raise ValueError(f"user-defined piece {piece!r} is not supported")
    if model["type"] == BPE:
        vocabulary = {p: i for i, (p, _, _) in enumerate(pieces)}
        core = models.BPE(
            vocab=vocabulary, merges=merges_of(pieces), unk_token=pieces[model["unknown"]][0], fuse_unk=True,
            byte_fallback=model["byte_fallback"],
        )
    elif model["type"] == UNIGRAM:
        core = models.Unigram(
            [(p, s) for p, s, _ in pieces], unk_id=model["unknown"], byte_fallback=model["byte_fallback"]
        )
    else:
        raise ValueError(f"model type {model['type']} is not supported")
    tokenizer = Tokenizer(core)
    if words:
        tokenizer.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
    return tokenizer


def single(x: float) -> float:
    """Rounded to single precision."""
    return SINGLE.unpack(SINGLE.pack(x))[0]


class Lattice:
    """The best reading under a unigram model, with the library's roundings: every sum is rounded to single precision,
    and of equal readings the first, that is the one with the longest last piece, stays."""

    def __init__(self, model: dict):
        pieces = model["pieces"]
        plain = [s for _, s, kind in pieces if kind == NORMAL]
        self.unknown = model["unknown"]
        self.unknown_score = single(min(plain, default=0.0) - UNKNOWN_COST)
        self.scores = {p: (s, i) for i, (p, s, kind) in enumerate(pieces) if kind == NORMAL}
        self.begins = {p[:n] for p in self.scores for n in range(1, len(p) + 1)}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.fallback = model["byte_fallback"]

    def encode(self, text: str) -> np.ndarray:
        """Time grows with the length of the text times that of the longest piece."""
        n = len(text)
        best, came, piece = [0.0] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        scores, begins = self.scores, self.begins
        for i in range(n):
            here = best[i]
            for j in range(i + 1, n + 1):
                part = text[i:j]
                if part not in begins:
                    break
                if part in scores:
                    score, number = scores[part]
                    offer = single(score + here)
                    if came[j] < 0 or offer > best[j]:
                        best[j], came[j], piece[j] = offer, i, number
            if text[i] not in scores:
                offer = single(self.unknown_score + here)
                if came[i + 1] < 0 or offer > best[i + 1]:
                    best[i + 1], came[i + 1], piece[i + 1] = offer, i, self.unknown
        ids: list[int] = []
        at, after = n, -1
        while at:
            start, number = came[at], piece[at]
            if number != self.unknown:
                ids.append(number)
            elif self.fallback:
                ids += [self.bytes[b] for b in reversed(text[start:at].encode())]
            elif after != self.unknown:  # unknown characters in a row are one piece
                ids.append(number)
            at, after = start, number
        return np.array(ids[::-1], np.int32)


class Codec:
    """Encode and decode whole texts."""

    def __init__(self, data: bytes):
        self.model = parse_model(data)
        self.tokenizer, self.word_tokenizer = backend(self.model), backend(self.model, words=True)
        self.lattice = Lattice(self.model) if self.model["type"] == UNIGRAM else None
        self.cuttable = cuttable(self.model)
        user = {p: i for i, (p, _, kind) in enumerate(self.model["pieces"]) if kind == USER}
        self.user = {p: np.array([i], np.int32).tobytes() for p, i in user.items()}
        longest = sorted(map(re.escape, user), key=len, reverse=True)
        self.user_pattern = re.compile("(" + "|".join(longest) + ")") if user else None
        self.opens = np.array([p.startswith(MARK) for p, _, _ in self.model["pieces"]])
        self.known: dict[str, bytes] = {}  # ids as int32
        self.bytes_of = []
        for p, _, kind in self.model["pieces"]:
            if kind == BYTE:
                self.bytes_of.append(bytes([int(p[3:5], 16)]))
            elif kind == CONTROL:
                self.bytes_of.append(b"")
            elif kind == UNKNOWN:
                self.bytes_of.append(b" \xe2\x81\x87 ")
            else:
                self.bytes_of.append(p.replace(MARK, " ").encode())

    def stretches(self, text: str) -> list[str]:
        text = normalise(text, self.model)
        if not text:
            return []
        if self.user_pattern:
            out = []
            for i, part in enumerate(self.user_pattern.split(text)):
                if i % 2 or (part and not self.cuttable):
                    out.append(part)
                else:
                    out += STRETCH.findall(part)
            return out
        return STRETCH.findall(text) if self.cuttable else [text]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.lattice:
            return [self.lattice.encode(normalise(t, self.model)) for t in texts]
        cut = [self.stretches(t) for t in texts]
        new = set().union(*cut).difference(self.known) if cut else set()
        if len(self.known) + len(new) > MEMORY_STRETCHES:
            self.known, new = {}, set().union(*cut)
        known = self.known
        if self.user:
            known.update(self.user)
            new = new - self.user.keys()
        words = [s for s in new if len(s) > 1 and s[0] == MARK and s[1] != MARK] if self.cuttable else []
        for batch in byte_balanced(words, RUN_BYTES * 64):
            runs = list(byte_balanced(batch, RUN_BYTES))
            encoded = self.word_tokenizer.encode_batch_fast(["".join(r) for r in runs], add_special_tokens=False)
            for run, e in zip(runs, encoded):
                ids = np.array(e.ids, np.int32)
                # A word's first piece, and no other, holds the marker.
                at = [*(4 * np.flatnonzero(self.opens[ids])).tolist(), 4 * len(ids)]
                raw = ids.tobytes()
                known.update(zip(run, [raw[a:b] for a, b in zip(at, at[1:])]))
        for batch in byte_balanced([s for s in new if s not in known]):
            for stretch, e in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)):
                known[stretch] = np.array(e.ids, np.int32).tobytes()
        out = [np.frombuffer(b"".join(map(known.__getitem__, c)), np.int32) for c in cut]
        for stretch in [s for s in new if len(s) > MEMORY_CHARS]:
            del known[stretch]
        return out

    def decode(self, ids: np.ndarray) -> str:
        pieces = self.bytes_of
        text = b"".join([pieces[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.model["prefix"] and text.startswith(" ") else text


def load_codec(path: str) -> Codec:
    with open(path, "rb") as file:
        return Codec(file.read())


def verify_parity(path: str, texts: list[str]) -> list[int]:
    """Numbers of the texts that the sentencepiece library encodes or decodes in another way."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    codec = load_codec(path)
    wrong = []
    for i, (text, ids) in enumerate(zip(texts, codec.encode(texts))):
        expected = library.encode(text)
        if expected != ids.tolist() or library.decode(expected) != codec.decode(ids):
            wrong.append(i)
    return wrong


FIELDS = "ids array<int>, n_pieces bigint, restored boolean"


def encode_documents(
    documents: DataFrame, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",), model: str = MODEL,
    name: str = "pieces",
) -> DataFrame:
    """The columns ``keep`` and a struct ``name``: ids, n_pieces, restored (decoding gives the text back)."""

    def make():
        codec = load_codec(public_tokenizer(model))
        squeezed = codec.model["squeeze"]

        def compute(texts: pa.Array) -> list:
            plain = [t or "" for t in texts.to_pylist()]
            ids = codec.encode(plain)
            back = [
                codec.decode(i) == (re.sub(" +", " ", t.strip(" ")) if squeezed else t) for t, i in zip(plain, ids)
            ]
            sizes = [len(i) for i in ids]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), sizes, back]

        return compute

    return annotate(documents, text_column, make, FIELDS, list(keep), name)


def decode_ids(encoded: DataFrame, ids_column: str, keep: tuple[str, ...] = ("doc_id",), model: str = MODEL) -> DataFrame:
    """The columns ``keep`` and ``text`` from arrays of piece ids; a null array gives an empty text."""
    source = encoded.select(*keep, F.col(ids_column).alias("ids"))
    kept = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_codec(public_tokenizer(model))
        for batch in batches:
            texts = [codec.decode(np.array(i or [], np.int32)) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(texts, pa.string())], [*kept, "text"]
            )

    ddl = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in kept)
    return source.mapInArrow(run, f"{ddl}, text string")


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, restored, ids_sha256 (of the ids, comma-joined)."""
    bounded_batches(spark)
    found = encode_documents(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "pieces.n_pieces", "pieces.restored",
        F.sha2(F.concat_ws(",", F.col("pieces.ids").cast("array<string>")), 256).alias("ids_sha256"),
    )
