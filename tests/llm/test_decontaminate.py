import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F

from shelfcast.llm import decontaminate
from shelfcast.llm.decontaminate import Searcher, contaminated, find_benchmark, op10_decontamination, words_of
from shelfcast.llm.queries import ORACLE_SQL
from tests_support import differences, oracle_connection

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(text, items):
    own = words(text)
    hit, found = set(), set()
    for item, content in items:
        w = words(content)
        n = min(13, len(w))
        if not n:
            continue
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item)
    return len(own), len(hit), found


def test_words():
    assert [w.decode() for w in words_of("It's A_b ÉTÉ 42\x00x".encode())] == words("It's A_b ÉTÉ 42\x00x")


@pytest.mark.parametrize("seed", range(8))
def test_search_against_brute_force(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "bb", "of", "thing", "é", "averyverylongwordindeed", "x1"][: 3 + seed % 5]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(i), line(rng.choice([0, 1, 2, 5, 13, 14, 30]))) for i in range(6)]
    texts = [line(rng.randrange(60)) + ". " + rng.choice(items)[1] + " | " + line(9) for _ in range(40)] + ["", "!"]
    counts, found, ranges = Searcher([(i, t.encode()) for i, t in items]).search([t.encode() for t in texts])
    for k, text in enumerate(texts):
        n, hit, names = brute(text, items)
        assert (counts[k], sum(b - a for a, b in ranges[k]), found[k]) == (n, hit, names)


def test_long_text_and_cursors():
    item = " ".join(f"w{i}" for i in range(20))
    text = "filler text " * 40_000 + item + " more filler" * 1000 + " " + item
    counts, found, ranges = Searcher([("7", item.encode())]).search([text.encode()])
    assert found == [{"7"}] and sum(b - a for a, b in ranges[0]) == 40 and counts[0] == len(words(text))


@pytest.mark.parametrize("shard_bytes", [16_000_000, 40])
def test_messy_rows_in_one_or_many_passes(spark, messy, shard_bytes):
    items = [(1, "word word"), (2, "the QUICK brown"), (2, "the quick brown"), (None, "naïve"), (3, None), (4, "?!"),
             (10, "fox it jumps"), (11, "a text without an id mail me at a b example org and so on and on")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = find_benchmark(messy, benchmark, shard_bytes=shard_bytes).select(
        "doc_id", "found.*", contaminated(F.col("found")).alias("bad")
    ).collect()
    assert len(found) == messy.count()
    texts = {r["doc_id"]: r["text"] for r in messy.select("doc_id", "text").collect()}
    named = [("" if i is None else str(i), t or "") for i, t in items]
    for r in found:
        n, hit, names = brute(texts[r["doc_id"]], named)
        assert (r["n_words"], r["n_hit"], set(r["items"])) == (n, hit, names)
        assert r["items"] == sorted(names)
        assert r["bad"] == (hit > 0 and 20 * hit >= n)


def test_empty_tables(spark, messy, empty):
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert find_benchmark(empty, benchmark).count() == 0
    assert find_benchmark(messy, benchmark).where("found.n_hit > 0").count() == 0


def test_query_against_sql(spark, small):
    assert differences(
        op10_decontamination(spark, small), oracle_connection(small), ORACLE_SQL["op10_decontamination"]
    ) == []


def test_digest_of_items(spark, small):
    got = op10_decontamination(spark, small).where("n_items = 0").first()
    assert got["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_a_shard_stays_small_while_the_benchmark_grows(spark, monkeypatch):
    """Ten times the benchmark, and an item that comes again and again, make more shards and not larger ones."""
    sizes = []
    make = decontaminate._maker

    def recorded(items, window):
        sizes.append(sum(len(text) for _, text in items))
        return make(items, window)

    monkeypatch.setattr(decontaminate, "_maker", recorded)
    documents = spark.createDataFrame([(i, f"some text item{i * 7} goes on") for i in range(30)], "doc_id long, text string")
    largest = []
    for n in (60, 600):
        items = [(i, f"item{i} goes on") for i in range(n)] + [(0, "item0 goes on")] * n
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        found = find_benchmark(documents, benchmark, shard_bytes=300).collect()
        hit = {r["doc_id"]: r["found"]["items"] for r in found}
        assert hit == {i: [str(i * 7)] if i * 7 < n else [] for i in range(30)}
        largest.append(max(sizes))
        assert len(sizes) >= n // 30
        sizes.clear()
    assert largest[1] <= 3 * 300
