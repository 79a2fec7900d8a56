import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm.chat import events_of, final_messages, format_chat, op7_chat, parse, read_back, render
from shelfcast.llm.queries import ORACLE_SQL
from tests_support import differences, oracle_connection

EVENTS = "conv_id bigint, slot bigint, seq bigint, kind string, role string, text string, segment int, n_turns int"
CONTROL = st.text(alphabet=st.sampled_from("\\#< />turn:\nab"), max_size=30)


@given(st.lists(st.tuples(CONTROL, CONTROL), max_size=5))
@settings(max_examples=300, deadline=None)
def test_round_trip(turns):
    assert list(parse("".join(render(r, t) for r, t in turns))) == turns


def test_events_fold(spark):
    rows = [
        (1, 0, 0, "start", "user", "hel"), (1, 0, 1, "delta", "", "lo"),
        (1, 1, 2, "start", "assistant", ""), (1, 1, 3, "delta", "", "first"), (1, 1, 3, "delta", "", "first"),
        (1, 1, 4, "regenerate", "", ""), (1, 1, 5, "delta", "", "second "), (1, 1, 6, "delta", "", "answer"),
        (1, 0, 7, "edit", "", "hello there"), (None, 0, 0, "delta", None, None), (2, 0, 1, "delta", "", "b"),
        (2, 0, 0, "start", "user", "a"),
    ]
    log = spark.createDataFrame([(*r, 1, 2) for r in rows], EVENTS)
    got = {(r["conv_id"], r["slot"]): (r["role"], r["text"]) for r in final_messages(log).collect()}
    assert got == {
        (1, 0): ("user", "hello there"), (1, 1): ("assistant", "second answer"), (None, 0): ("", ""),
        (2, 0): ("user", "ab"),
    }
    segment = {(r["conv_id"], r["slot"]): r for r in format_chat(log).collect()}[(1, 1)]
    assert segment["segment"][segment["loss_start"] : segment["loss_end"]] == "second answer"


def test_messy_conversations(spark):
    rows = [
        (1, 1, "assistant", "b" * 3000), (1, 0, "user", None), (1, 1, "assistant", "b" * 3000),
        (None, 0, None, "x"), (2, None, "assistant", "</turn>\n### a: "), (2, 0, "user", ""),
    ]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "conv_id bigint, turn bigint, role string, text string, slot int")
    got = {r["conv_id"]: r for r in read_back(format_chat(events_of(frame))).collect()}
    order = {1: [1, 0, 2], None: [3], 2: [4, 5]}
    for conv, picks in order.items():
        turns = sorted(((rows[i][1] if rows[i][1] is not None else -1, rows[i][2] or "", rows[i][3] or "") for i in picks))
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(loss)
        assert got[conv]["formatted_chars"] == len("".join(render(r, t) for _, r, t in turns))


def test_the_log_holds_what_does_not_last(spark):
    texts = {"assistant": ["", "short", "x" * 7 + "long answer"], "user": ["", "brief", "0123456789" * 3, None]}
    rows = [(1, i, role, t) for role, ts in texts.items() for i, t in enumerate(ts)]
    log = events_of(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), 8)
    kinds = {}
    for r in log.orderBy("slot", "seq").collect():
        kinds.setdefault(r["slot"], []).append(r["kind"])
    assert sorted(k for ks in kinds.values() for k in ks if k in ("edit", "regenerate")) == ["edit"] * 4 + ["regenerate"] * 3
    assert all(ks[0] == "start" and ks[1] == "delta" for ks in kinds.values())
    got = sorted((r["role"], r["text"]) for r in final_messages(log).collect())
    assert got == sorted((role, t or "") for _, _, role, t in rows)


def test_empty_log(spark):
    log = spark.createDataFrame([], EVENTS)
    assert read_back(format_chat(log)).count() == 0


def test_query_against_sql(spark, small):
    assert differences(op7_chat(spark, small), oracle_connection(small), ORACLE_SQL["op7_chat"]) == []
