from __future__ import annotations

import hashlib
import json
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from citeloom.llm import chat

from .edge import ordered

SCHEMA = "conv_id long, turn long, role string, text string, record string, id string, mark string, formatted string"
NASTY = ["\\", "\\\\", "###", "####", "##", "#", "</turn>", "\\</turn>", "<</turn>", "</turn>\n### user: x</turn>\n", "<\\/turn>",
         "### assistant: hi", "\\### Assistant: </turn> ok", "a\\", "<", "</turn", "/turn>", "%3A", "%253A: ", "", "\n", "é😀#😀##\n</turn>😀",
         "\\#\\#", "#" * 500 + "\\" * 333, "</turn>" * 200]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "i", "m", "f") for r in rows], SCHEMA).repartition(3)


def brute(rows):
    """(conv_id, n_turns, turns, loss chars, loss) by the contract, without any template."""
    rows = [*rows, (-7, 0, "user", chat.PROBE[1]), (-7, 1, "assistant", chat.PROBE[1])]
    key = lambda r: (r[0] is not None, r[0] or 0)
    out = []
    for _, group in groupby(sorted(rows, key=key), key=key):
        turns = sorted(group, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out.append((turns[0][0], len(turns), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)), len(learned), sha(learned)))
    return ordered(out)


def rows_of_conversations():
    rows = [(c, t, ["system", "user", "assistant", "a: b %3A\n", "</turn>###"][(c + t) % 5], NASTY[(3 * c + t) % len(NASTY)])
            for c in range(12) for t in range(6)]
    rows += [(50, None, "user", "no turn"), (50, 1, None, "no role"), (50, 2, "assistant", None), (50, 2, "assistant", None),
             (None, 1, "assistant", "no id"), (None, 0, "user", "no id"), (60, 0, "assistant", "x" * 70_000 + "\\")]
    return rows + [(70, t, "assistant" if t % 2 else "user", f"turn {t} ## \\") for t in range(600)]


def test_digest(spark):
    rows = rows_of_conversations()
    got = chat.chat_digest(frame(spark, rows)).collect()
    assert ordered((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == brute(rows)
    probe = next(r for r in got if r.conv_id == -7)
    text = r"\\#\#\# Assistant: <\/turn> ok"
    assert probe.formatted_chars == len(f"### user: {text}</turn>\n### assistant: {text}</turn>\n")
    assert [r.conv_id for r in chat.chat_digest(frame(spark, [])).collect()] == [-7]


@pytest.mark.parametrize("text", NASTY)
def test_escapes_are_reversible_and_hide_control_strings(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(
        chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("back"),
        chat.escape_role(F.col("t")).alias("role"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("role_back")).first()
    assert r["back"] == text and r["role_back"] == text
    assert "</turn>" not in r["e"] and "##" not in r["e"] and ":" not in r["role"]


def test_mask_covers_the_assistant_only(spark):
    rows = [(1, 0, "user", "a#"), (1, 1, "assistant", "b##\\"), (1, 2, "assistant", ""), (1, 3, "user", "é😀"), (1, 4, "assistant", "ç")]
    df = frame(spark, rows).select(F.struct("conv_id", "turn", "role", "text").alias("r"))
    made = chat.formatted(chat.canonical(df, "r")).first()
    assert made["formatted"] == ("### user: a#</turn>\n### assistant: b#\\#\\\\</turn>\n### assistant: </turn>\n"
                                 "### user: é😀</turn>\n### assistant: ç</turn>\n")
    assert [(s["turn"], made["formatted"][s["start"]:s["end"]]) for s in made["loss"]] == [(1, "b#\\#\\\\"), (2, ""), (4, "ç")]
    turns = chat.formatted_turns(chat.canonical(df, "r")).orderBy("turn").collect()
    assert "".join(t["piece"] for t in turns) == made["formatted"]
    assert [t["piece"][t["learned"]["start"]:t["learned"]["end"]] for t in turns if t["learned"]] == ["b#\\#\\\\", "", "ç"]


TWO = [("user", "q"), ("assistant", "a")]
RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", TWO),
    ({"messages": [{"role": "human", "content": "q", "extra": 1}, {"role": "gpt", "content": "a"}], "id": 3, "meta": {"x": [1]}},
     "messages", TWO),
    ({"system": "s", "messages": [{"role": "user", "content": "q"}]}, "messages", [("system", "s"), ("user", "q")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}, {"type": "image"}, {"text": "2"}]}]}, "message parts",
     [("user", "q2")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations", TWO),
    ({"turns": [{"speaker": "prompter", "text": "q"}, {"speaker": "bot", "text": "a"}]}, "turns", TWO),
    ({"instruction": "q", "output": "a"}, "instruction", TWO),
    ({"instruction": "q", "input": "more", "output": "a"}, "instruction", [("user", "q\n\nmore"), ("assistant", "a")]),
    ({"instruction": "q", "input": "", "output": None, "system": None}, "instruction", [("user", "q"), ("assistant", "")]),
    ({"instruction": "q", "context": "c", "response": "a"}, "instruction response", [("user", "q\n\nc"), ("assistant", "a")]),
    ({"prompt": "q", "completion": "a"}, "prompt completion", TWO),
    ({"prompt": "q", "response": "a", "score": 1.5}, "prompt response", TWO),
    ({"question": "q", "answer": "a"}, "question answer", TWO),
    ({"dialog": ["q", "a", "q2"]}, "dialog", [*TWO, ("user", "q2")]),
    ({"prompt": "q", "response": "a", "messages": [{"role": "user", "content": "m"}]}, "messages", [("user", "m")]),
    ({"conv_id": "c9", "turn": 4, "role": "user", "text": "q"}, "turn rows", [("user", "q")]),
    ({"text": "q"}, None, None), ({"messages": []}, None, None), ({"messages": [{}]}, None, None), ([1, 2], None, None),
    ("plain", None, None), ({"a`b: STRING": {"prompt": 1}, "completion": "a"}, None, None)]


def test_layouts(spark):
    rows = [(str(i), json.dumps(r), "x") for i, (r, _, _) in enumerate(RECORDS)] + [("bad", "{not json", "x"), ("none", None, "x")]
    df = spark.createDataFrame(rows, "conversation string, body string, turns string")
    got = {r["fingerprint_key"]: r for r in chat.canonical(df, "body", "conversation").withColumn(
        "fingerprint_key", F.col("conversation")).collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        r = got["c9" if layout == "turn rows" else str(i)]
        assert r["layout"] == layout, (i, r)
        assert (None if r["turns"] is None else [(t["role"], t["text"]) for t in r["turns"]]) == turns
    assert got["c9"]["turn"] == 4 and got["0"]["fingerprint"] == got["1"]["fingerprint"] != got["2"]["fingerprint"]
    assert got["bad"]["layout"] is None and got["none"]["layout"] is None
    typed = spark.createDataFrame([("t", ("q", "a"))], "conversation string, r struct<prompt:string,completion:string>")
    assert chat.canonical(typed, "r", "conversation").first()["layout"] == "prompt completion"


def test_field_paths(spark):
    record = {"a": {"b": [{"c": 1}, {"d": [[2]]}]}, "e": None, "f": {}, "g": [], "x y": {"`": 1, "k: ARRAY<": "v"}}
    got = spark.createDataFrame([(json.dumps(record),)], "j string").select(
        chat.field_paths(F.parse_json("j")).alias("p")).first()["p"]
    assert sorted(got) == sorted(["a.b[].c", "a.b[].d[][]", "e", "f", "g[]", "x y.`", "x y.k: ARRAY<"])
