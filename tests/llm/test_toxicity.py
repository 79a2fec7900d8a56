import numpy as np
import pytest

from shelfcast.llm import toxicity
from shelfcast.llm.toxicity import (
    Channel, Scorer, fit_toxicity, op9_toxicity, restore_text, score_toxicity, train, trigram_counts,
)

LINES = ["you are a loser and an idiot", "the moron went home", "stupid scum", "a nice day in the park", "other words"]


@pytest.fixture(scope="module")
def channel():
    data = toxicity.SYMBOL[np.frombuffer(("  ".join(LINES * 50)).encode(), np.uint8)].astype(int)
    counts = np.zeros((28, 28, 28))
    np.add.at(counts, (data[:-2], data[1:-1], data[2:]), 1)
    return Channel(counts)


@pytest.mark.parametrize("disguised, plain", [
    ("l0ser", "loser"), ("1d10t", "idiot"), ("i d i o t", "idiot"), ("s.c.u.m", "scum"), ("mooooron", "moron"),
    ("$tup1d", "stupid"), ("a nice day", "a nice day"), ("", ""), ("m-o-r-o-n", "moron"), ("5cum", "scum"),
])
def test_restored(channel, disguised, plain):
    assert restore_text(disguised, channel) == plain


def test_viterbi_against_all_readings(channel):
    def readings(text, before=""):
        if not text:
            yield "", 0.0
            return
        for out, cost in channel._readings(text[0], before, False):
            for rest, more in readings(text[1:], text[0]):
                yield out + rest, cost + more

    def value(text, cost):
        a = b = 0
        for c in text:
            s = ord(c) - 96 if "a" <= c <= "z" else 0
            cost += channel.model[a][b][s]
            a, b = b, s
        return cost + channel.model[a][b][0]

    for text in ("l0s3r", "1d1o7", "m00ron", "5tuupid"):
        best = max(value(t, c) for t, c in readings(text))
        assert any(np.isclose(value(t, c), best) and t == channel._viterbi(text) for t, c in readings(text))


@pytest.mark.parametrize("seed", range(20))
def test_a_long_stretch_is_one_lattice(channel, monkeypatch, seed):
    """Putting the shared beginning aside changes nothing: the reading is that of a lattice never settled."""
    rng = np.random.default_rng(seed)
    words = " ".join(rng.choice(LINES) for _ in range(8))
    apart = " ".join(words.replace(" ", ""))[: 60 + 20 * seed]
    stretch = "".join({"o": "0", "i": "1", "s": "$"}.get(c, c) if rng.random() < 0.4 else c for c in apart)
    monkeypatch.setattr(toxicity, "SETTLE_CHARS", 10**9)
    whole = channel._viterbi(stretch)
    for every in (1, 7, 32):
        monkeypatch.setattr(toxicity, "SETTLE_CHARS", every)
        assert channel._viterbi(stretch) == whole


def test_a_very_long_stretch(channel):
    assert channel._viterbi("l0ser" * 4_000).count("loser") > 3_900


def test_counts_cover_all_texts(spark):
    frame = spark.createDataFrame([(t,) for t in ["abc", None, "", "Abcé"]], "text string").repartition(3)
    counts = trigram_counts(frame)
    assert counts[1, 2, 3] == 2 and counts[2, 3, 27] == 1 and counts[0, 1, 2] == 2


def test_disguise_is_scored_like_the_plain_word(channel):
    clean = [(f"{w} {x} nice day in the park number{i}", 0) for i, (w, x) in enumerate([("home", "other")] * 30)]
    toxic = [(f"you {w} went home {i}", 1) for i, w in enumerate(["loser", "idiot", "moron"] * 30)]
    scorer = Scorer(train(clean + toxic, channel), channel)
    plain = scorer.score([b"what a loser", b"what an idiot", b"a nice day"])
    hidden = scorer.score([b"what a l0ser", b"what an i d i o t", b"a n1ce day"])
    assert (plain[:2] > 0.5).all() and (hidden[:2] > 0.5).all() and plain[2] < 0.5 and hidden[2] < 0.5


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op9_toxicity(spark, folder).join(truth, "doc_id").where("held_out").collect()
    assert np.mean([r["toxic"] == r["predicted"] for r in rows]) > 0.95


def test_messy_rows_and_empty_tables(spark, messy, empty):
    labels = spark.createDataFrame(
        [(1, 1), (2, None), (5, 0), (6, 1), (7, 0), (7, 1), (None, 1), (99, 1)], "doc_id bigint, toxic int"
    )
    for docs, known in ((messy, labels), (empty, labels), (messy, labels.limit(0))):
        model, counts = fit_toxicity(docs, known)
        rows = score_toxicity(messy, model, counts).collect()
        assert len(rows) == messy.count()
        assert all(0 <= r["toxicity"]["score"] <= 1 for r in rows)
    assert score_toxicity(empty, {"stems": [], "base": 0.0}, np.zeros((28, 28, 28))).count() == 0
