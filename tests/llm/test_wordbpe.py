import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm.tokens import public_tokenizer
from shelfcast.llm.transducer import Builder, Transducer, compile_words
from shelfcast.llm.wordbpe import MODEL, Encoder, Merger, build_lexicon, decode_words, encode_words, op13_word_bpe

WORDS = ["the", "these", "walking", "talking", "walked", "it", "naïve", "日本語", "a", "ing", "x" * 40]


@pytest.fixture(scope="module")
def merger():
    return Merger(public_tokenizer(MODEL))


def lexicon(merger, words):
    pairs = sorted({w if isinstance(w, bytes) else w.encode() for x in words for w in merger.words(x)})
    return Transducer(np.frombuffer(compile_words((w, tuple(merger.merge(w))) for w in pairs), np.uint8))


@pytest.fixture(scope="module")
def encoder(merger):
    return Encoder(merger, lexicon(merger, WORDS))


def library(merger, text):
    ids = merger.tokenizer.encode(text, add_special_tokens=False).ids
    return ids, merger.tokenizer.decode(ids, skip_special_tokens=False)


def states_needed(table):
    """States of the smallest automaton: as many as there are different maps from endings to what is left to put out."""
    prefixes = {w[:i] for w in table for i in range(len(w) + 1)}
    rests = set()
    for p in prefixes:
        rest = {w[len(p) :]: table[w] for w in table if w.startswith(p)}
        outs = list(rest.values())
        shared = 0
        while all(len(o) > shared for o in outs) and len({o[shared] for o in outs}) == 1:
            shared += 1
        rests.add(tuple(sorted((e, o[shared if p else 0 :]) for e, o in rest.items())))
    return len(rests)


@given(st.dictionaries(st.text("ab", max_size=5).map(str.encode), st.lists(st.integers(0, 2), max_size=4).map(tuple)))
@settings(max_examples=300, deadline=None)
def test_transducer_is_a_map_and_minimal(table):
    found = Transducer(np.frombuffer(compile_words(sorted(table.items())), np.uint8))
    asked = sorted(table) + [b"", b"c", b"aaaaaaaa", b"abab", b"b" * 6]
    known, ids, at = found.lookup(asked)
    assert known.tolist() == [w in table for w in asked]
    expected = [table[w] for w in asked if w in table]
    assert [tuple(ids[a:b].tolist()) for a, b in zip(at, at[1:])] == expected
    if table:
        assert len(found.final) == states_needed(table)


def test_words_must_be_in_order():
    builder = Builder()
    builder.add(b"b", (1,))
    for word in (b"a", b"b"):
        with pytest.raises(ValueError):
            builder.add(word, (2,))


def test_shared_endings(merger):
    together = lexicon(merger, ["walking", "talking", "balking"])
    assert len(together.final) < 3 * len("walking")


ALPHABET = "ab thesing'lrvd19 .,!\n\t\x0b\x0c\x1c\x1f\x85\xa0é日Éß̸́İΣς ﬁ🎉<|>"


@given(st.lists(st.one_of(
    st.text(ALPHABET, max_size=12), st.sampled_from([*WORDS, "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", " "])
), max_size=8).map("".join))
@settings(max_examples=500, deadline=None)
def test_parity(merger, encoder, text):
    ids, decoded = library(merger, text)
    got = encoder.encode([text])[0]
    assert got.tolist() == ids
    assert merger.decode(got) == decoded


@given(st.text(max_size=30))
@settings(max_examples=500, deadline=None)
def test_parity_over_all_characters(merger, encoder, text):
    assert encoder.encode([text])[0].tolist() == library(merger, text)[0]


@given(st.text("abcdeilnorst'é", min_size=1, max_size=40).map(str.encode))
@settings(max_examples=300, deadline=None)
def test_both_ways_of_merging(merger, word):
    part = [*map(merger.inner.__getitem__, word[:-1]), merger.last[word[-1]]]
    assert merger._merge_short(list(part)) == merger._merge_long(list(part))


@given(st.lists(st.one_of(
    st.text("abcdeilnorst'é", min_size=1, max_size=40).map(str.encode), st.binary(min_size=1, max_size=100),
    st.sampled_from([b"a", b"aaaaaaaaa", b"x" * 64, b"x" * 65, b""]),
), max_size=12))
@settings(max_examples=300, deadline=None)
def test_words_merged_side_by_side(merger, words):
    assert [np.frombuffer(ids, np.int32).tolist() for ids in merger.merge_many(words)] == [merger.merge(w) for w in words]


def test_a_word_is_looked_up_once(monkeypatch, merger):
    """Later texts ask only for new words; forgetting, long words and special tokens change no id."""
    import shelfcast.llm.wordbpe as module

    task = Encoder(merger, lexicon(merger, WORDS))
    asked, look_up = [], task.lexicon.lookup
    monkeypatch.setattr(task.lexicon, "lookup", lambda words: asked.append(sorted(words)) or look_up(words))
    texts = ["the walking qzx", "walking qzx the new", "x" * 60 + " <|endoftext|> the naïve日", "x" * 60]
    for text in texts:
        assert task.encode([text])[0].tolist() == library(merger, text)[0]
    assert asked[:2] == [[b"qzx", b"the", b"walking"], [b"new"]] and asked[3] == [b"x" * 60]
    monkeypatch.setattr(module, "MEMORY_ENTRIES", 5)
    for text in [*texts, " ".join(f"w{i}x" for i in range(30)), *texts]:
        assert task.encode([text])[0].tolist() == library(merger, text)[0]
        assert len(task.found) <= 5


def test_plain_characters_are_what_they_are_taken_for(merger):
    import unicodedata

    from shelfcast.llm.wordbpe import PLAIN, WORD

    for c in map(chr, range(0x3000)):
        if PLAIN.fullmatch(c):
            assert unicodedata.normalize("NFC", "a" + c + "a") == "a" + c + "a"
            for text in (c, f"a{c}a", f"1{c}2", f"'{c}"):
                assert [w.encode() for w in WORD.findall(text.lower())] == [
                    bytes(merger.byte_of[x] for x in w)
                    for w, _ in merger.tokenizer.pre_tokenizer.pre_tokenize_str(merger.tokenizer.normalizer.normalize_str(text))
                ]


def test_long_words_and_any_lexicon(merger, encoder):
    rng = random.Random(1)
    texts = ["x" * 50_000, "".join(rng.choice("etaoinshr") for _ in range(20_000)), "the walking " * 5_000, "", "é" * 9_000]
    empty = Encoder(merger, lexicon(merger, []))
    for text, a, b in zip(texts, encoder.encode(texts), empty.encode(texts)):
        assert a.tolist() == b.tolist() == library(merger, text)[0]


def test_messy_rows(spark, messy, merger):
    got = encode_words(messy, keep=("doc_id", "found")).collect()
    assert len(got) == messy.count()
    texts = {r["doc_id"]: r["text"] or "" for r in messy.collect()}
    for r in got:
        ids, decoded = library(merger, texts[r["doc_id"]])
        assert list(r["encoded"]["ids"]) == ids and r["encoded"]["decoded"] == decoded
        assert r["encoded"]["n_tokens"] == len(ids) and r["found"] == "y"


def test_decode(spark, merger):
    rows = [(1, merger.tokenizer.encode("Walking <|endoftext|> naïve").ids), (2, []), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id int, text array<int>")
    got = {r["doc_id"]: r["text"] for r in decode_words(frame, "text").collect()}
    assert got == {1: library(merger, "Walking <|endoftext|> naïve")[1], 2: "", 3: ""}


def test_lexicon_holds_repeated_words(spark, messy, merger):
    from pyspark import SparkFiles

    words = Transducer.open(SparkFiles.get(build_lexicon(messy)))
    assert words.lookup([b"word", b"quick", b"jumps", b"naive"])[0].tolist() == [True, True, True, False]


def test_empty_table(spark, empty):
    assert encode_words(empty).count() == 0
    assert encode_words(empty).columns == ["doc_id", "encoded"]


def test_query_against_library(spark, small, merger):
    import hashlib

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = op13_word_bpe(spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        ids, decoded = library(merger, texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
