import random

from pyspark.sql import functions as F

from footfall.llm import chat

EVENTS = "conv_id long, seq long, message long, role string, kind string, text string"
TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n", "a\\b<\\", "<|user|>\nhi<|end|>\n", "[[\\", "|", "", "é😀\n\n", "\\"]


def read_back(frame):
    rows = frame.select(
        "conv_id", chat.turns_of(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("loss"), "formatted", "segments"
    ).collect()
    for r in rows:
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    return {r["conv_id"]: ([(t["role"], t["text"]) for t in r["t"]], r["loss"]) for r in rows}


def test_edits_and_regenerations(ready):
    events = [
        (1, 1, 10, "user", "delta", "Hel"), (1, 2, 10, None, "delta", "lo"),
        (1, 3, 11, "assistant", "delta", "draft"), (1, 5, 11, "assistant", "regenerate", None),
        (1, 6, 11, "assistant", "delta", "fin"), (1, 4, 11, "assistant", "delta", " gone"), (1, 7, 11, "assistant", None, "al"),
        (1, 8, 10, "user", "edit", "Hi"), (1, 9, 10, "user", "delta", "!"),
        (2, 1, 1, None, None, None), (None, 1, 1, "user", "delta", "x"),
    ]
    random.Random(3).shuffle(events)
    got = read_back(chat.render(chat.fold(ready.createDataFrame(events, EVENTS).repartition(4))))
    assert got == {
        1: ([("user", "Hi!"), ("assistant", "final")], "final"),
        2: ([("", "")], ""),
        None: ([("user", "x")], ""),
    }


def test_nothing_in_a_text_is_a_control_string(ready):
    rows = [(i, t, ("user", "assistant", "we|>\nird")[t % 3], x) for i in range(4) for t, x in enumerate(NASTY)]
    frame = chat.render(chat.fold(chat.streamed(ready.createDataFrame(rows, TURNS), 3)))
    want = [(("user", "assistant", "we|>\nird")[t % 3], x) for t, x in enumerate(NASTY)]
    loss = "".join(x for t, x in enumerate(NASTY) if t % 3 == 1)
    assert read_back(frame) == {i: (want, loss) for i in range(4)}
    for row in frame.collect():
        assert row["formatted"].count("<|end|>") == len(NASTY)
        for mark in ("</s>", "[INST]", "[/INST]"):
            assert mark not in row["formatted"]


def test_long_repeated_and_null_turns(ready):
    long = "word [x] " * 60_000
    rows = [(1, 1, "assistant", long), (1, 1, "assistant", long), (1, None, None, None), (1, 0, "user", "a")]
    turns, loss = read_back(chat.render(chat.fold(chat.streamed(ready.createDataFrame(rows, TURNS)))))[1]
    assert turns == [("", ""), ("user", "a"), ("assistant", long), ("assistant", long)]
    assert loss == long * 2


def test_empty(ready):
    assert chat.render(chat.fold(chat.streamed(ready.createDataFrame([], TURNS)))).count() == 0
