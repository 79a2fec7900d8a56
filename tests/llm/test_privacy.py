import hashlib
import math
import random
import re

import pytest
from tests_support import SCHEMA, rows_of, sentence
from pyspark.sql import functions as F

from shelfcast.llm.privacy import KINDS, base_spans, disclosed_terms, find_personal, op8_pii, redacted

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")),
        "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
    }[kind]


def brute(text):
    return [
        (k, m.start(), m.end()) for k, rule in RULES.items() for m in re.finditer(rule, text or "") if valid(k, m[0])
    ]


TRICKY = [
    "a@b.c_x@d.e f@g.h@i.j", "mail x.y+z@mail.example.org, and @no.body a@b", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3",
    "001.02.003.255 99999999999999999999.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 2",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1", "+1 (555) 123-4567 or +12 or +1234567890123456", "++49 30 1234567.",
    "é🎉 x@y.zz 10.0.0.1 é", "5105-1051 0510 5100", "0000000000000", "a" * 3000 + "@", "1" * 3000, "+" + "1 " * 2000,
]


@pytest.mark.parametrize("seed", [0, 1])
def test_base_spans_against_the_rules(spark, seed):
    rng = random.Random(seed)
    texts = TRICKY + ["".join(rng.choice("a.@1234567890  -+(é") for _ in range(rng.randrange(80))) for _ in range(400)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for r in base_spans(frame, "text", "s").collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["s"]] == brute(r["text"])
        assert all(r["text"][s["start"] : s["end"]] == s["value"] for s in r["s"])


@pytest.fixture(scope="module")
def telling(spark):
    """A term that stands beside one address in four passages and nowhere else, and words that stand everywhere."""
    rows = [(i, sentence(i, 60), "en") for i in range(40)]
    rows += [(100 + i, f"{sentence(i, 12)} projectx mail boss@corp.example {sentence(50 + i, 12)}", "en") for i in range(4)]
    rows += [(200, "nothing but ProjectX here, and projectxy", "en"), (201, "mail here", "en"), (202, "mail there", "en"),
             (203, "mail", "en"), (204, "mail you", "en"), (205, "mail it", "en")]
    return spark.createDataFrame(rows_of(rows), SCHEMA)


def test_telling_terms(spark, telling):
    terms, held = disclosed_terms(telling, "text", ["doc_id"])
    found = {r["term"]: r for r in terms.collect()}
    assert set(found) == {"projectx"}
    assert found["projectx"]["share"] == pytest.approx(4 / 5)
    assert found["projectx"]["bits"] == pytest.approx(__import__("math").log2(0.8 * telling.count() / 4))
    assert {r["doc_id"] for r in held.collect()} == {100, 101, 102, 103, 200}


def test_copies_of_a_passage_tell_nothing(spark):
    rows = [(i, "the same secretword mail boss@corp.example again", "en") for i in range(50)]
    terms, _ = disclosed_terms(spark.createDataFrame(rows_of(rows), SCHEMA), "text", ["doc_id"])
    assert terms.count() == 0


def brute_terms(texts):
    """{term: (share, bits)} with each document counted once; addresses only, all within reach of all words."""
    address = re.compile(RULES["email"])
    words = lambda t: {w for w in re.split(r"[^a-z0-9]+", t.lower()) if len(w) >= 3}
    contexts, together, value_rows, term_rows = {}, {}, {}, {}
    for n, t in enumerate(texts):
        for w in words(t):
            term_rows.setdefault(w, set()).add(n)
        for m in address.finditer(t):
            value_rows.setdefault(m[0], set()).add(n)
            before, after = t[max(0, m.start() - 60) : m.start()], t[m.end() : m.end() + 60]
            before = re.sub(r"^[a-z0-9]+", "", before) if m.start() > 60 else before
            after = re.sub(r"[a-z0-9]+$", "", after) if len(after) == 60 else after
            around = frozenset(words(before + " " + after))
            for w in around:
                contexts.setdefault((m[0], w), set()).add(around)
                together.setdefault((m[0], w), set()).add(n)
    out = {}
    for (value, w), rows in together.items():
        share = len(rows) / len(term_rows[w])
        bits = math.log2(share * len(texts) / len(value_rows[value]))
        if len(contexts[value, w]) >= 3 and share >= 0.5 and bits >= 3:
            a, b = out.get(w, (0, 0))
            out[w] = max(a, share), max(b, bits)
    return out


def test_documents_of_many_spans_count_once(spark):
    texts = [f"filler{i} more{i}" for i in range(80)]
    # A term beside one address in three documents, and beside ten others in a fourth.
    texts += [f"left{i} keyterm boss@corp.example right{i}" for i in range(3)]
    texts += [" ".join(f"keyterm p{i}@other.example gap{i}" for i in range(10))]
    # A term that stands beside an address in one document only, in many contexts, and without it in two others.
    texts += [" ".join(f"pad{i} {'x' * 40} onceterm me@home.example tail{i}" for i in range(8)), "onceterm", "onceterm a"]
    rng = random.Random(8)
    for _ in range(60):
        parts = [rng.choice(["aaa", "bbb", "ccc", "ddd", "u@v.ww", "s@t.xx", "q@r.yy"]) for _ in range(rng.randrange(25))]
        texts.append(" ".join(parts))
    expected = brute_terms(texts)
    assert expected["keyterm"][0] == 3 / 4 and "onceterm" not in expected
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["term"]: (r["share"], r["bits"]) for r in disclosed_terms(frame, "text", ["doc_id"])[0].collect()}
    assert set(found) == set(expected)
    for term, both in expected.items():
        assert found[term] == pytest.approx(both) and found[term][0] <= 1


def test_added_spans_and_text(spark, telling):
    found = find_personal(telling, base="spans", added="more")
    assert found.columns == [*telling.columns, "spans", "more"]
    assert found.drop("spans", "more").dtypes == telling.dtypes
    rows = find_personal(telling, keep=["doc_id", "text"]).withColumn(
        "clean", redacted(F.col("text"), F.col("base"), F.col("added"))
    ).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == telling.count()
    assert [(s["kind"], s["start"], s["end"]) for s in by[200]["added"]] == [("generalise", 12, 20)]
    assert by[200]["clean"] == "nothing but [TERM] here, and projectxy"
    assert "[EMAIL]" in by[100]["clean"] and "[TERM]" in by[100]["clean"] and "corp" not in by[100]["clean"]
    assert by[1]["clean"] == by[1]["text"]


def test_redaction_of_overlaps(spark):
    span = "array<struct<kind: string, start: bigint, end: bigint, value: string>>"
    frame = spark.createDataFrame(
        [("é0123456789", [("card", 1, 5, ""), ("phone", 3, 8, "")], []), ("ab", [], []), ("", [], [])],
        f"text string, base {span}, added {span}",
    )
    got = [r[0] for r in frame.select(redacted(F.col("text"), F.col("base"), F.col("added"))).collect()]
    assert got == ["é[CARD]789", "ab", ""]


def test_messy_rows_and_empty_tables(messy, empty):
    rows = find_personal(messy, keep=["doc_id", "text"]).collect()
    assert len(rows) == messy.count()
    for r in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == brute(r["text"])
    assert find_personal(empty, keep=["doc_id"]).count() == 0


def test_query_and_no_python_in_the_plan(spark, small):
    found = op8_pii(spark, small)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["spans"].startswith(listed)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
