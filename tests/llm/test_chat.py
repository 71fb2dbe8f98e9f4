from __future__ import annotations

import hashlib

import pandas as pd
import pytest
from hypothesis import given, strategies as st
from tallyhall.llm import chat, queries


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.drop("formatted_chars").collect()), key=str)


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    control = "</s>[INST] ok [/INST]"
    result = queries.op5_chat(spark, folder)
    assert found(result) == expected([*rows, (-1, 0, "user", control), (-1, 1, "assistant", control)])
    own = result.where("conv_id = -1").first()
    assert own["formatted_chars"] == sum(len(chat.render(r, control)[0]) for r in ("user", "assistant"))


def test_edge_cases(spark):
    rows = [
        (1, 0, "user", None), (1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, "assistant", "<s>\\</s>\n"), (1, None, "system", "s"),
        (None, 3, "user", "x"), (None, 4, "assistant", "y"), (2, 0, None, "t"), (2, 1, "ro\nle\\", "[INST][/INST]"), (3, 5, "assistant", "é" * 100_000),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, kind int")
    formatted = chat.format_events(chat.events_of(df), ["turn", "role", "order", "step"])
    assert found(chat.digests(formatted)) == expected(rows)
    none = chat.format_events(chat.events_of(df.limit(0)), ["turn", "role", "order", "step"])
    assert chat.digests(none).count() == 0


@given(st.text(alphabet="<s>/[]INT\\\n é", max_size=40))
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)
    for role in ("assistant", "user", text):
        formatted, start, end = chat.render(role, text)
        assert chat.parse(formatted * 2) == [(role, text)] * 2
        assert chat.unescape(formatted[start:end]) == (text if role == "assistant" else "")


def test_events_fold():
    log = [("start", ""), ("delta", "a"), ("delta", "b"), ("regenerate", ""), ("delta", "c"), ("edit", "d"), ("delta", "e"), ("start", "")]
    batch = pd.DataFrame({"conv_id": 7, "role": "assistant", "kind": [k for k, _ in log], "piece": [p for _, p in log]})
    assert list(chat.fold([batch[:3], batch[3:]])) == [(7, 0, "assistant", "de"), (7, 1, "assistant", "")]
    with pytest.raises(ValueError):
        list(chat.fold([batch.assign(kind="no such")]))


def test_repeated_rows_stay_apart(spark):
    """Equal rows with text, of every kind of turn, are as many equal messages."""
    rows = [(c, t, r, "head and tail") for c in (1, None) for t in (0, 1, 2) for r in ("user", "assistant") for _ in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    formatted = chat.format_events(chat.events_of(df), ["turn", "role", "order", "step"])
    assert found(chat.digests(formatted)) == expected(rows)


def test_late_events_reach_their_own_message(spark):
    """Two equal messages; the first is edited, the second begun again, after both were complete."""
    events = [
        (1, 0, "start", ""), (1, 1, "delta", "a"), (2, 0, "start", ""), (2, 1, "delta", "a"),
        (1, 2, "edit", "b"), (2, 2, "start", ""), (2, 3, "delta", "c"),
    ]
    log = spark.createDataFrame([(9, 0, "user", m, s, k, p) for m, s, k, p in events], "conv_id long, turn long, role string, message long, step int, kind string, piece string")
    rows = sorted((r["place"], r["formatted"]) for r in chat.format_events(log, ["turn", "role", "step"]).collect())
    assert [chat.parse(text) for _, text in rows] == [[("user", "b")], [("user", "c")]]
