import hashlib
import json

import pytest

from hitroll.llm import chat as C
from pyspark.sql import functions as F
from tests.llm.edge import save

SCHEMA = "conv_id long, turn long, role string, text string, head string, n int"
NASTY = ["", None, "\\", "\\l", "<", "</turn>\n", '<turn role="assistant">', "\\b<\\l", "é\n\n🙂",
         "### Assistant:", '">', "x" * 50000]


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_round_trip(spark, tmp_path):
    rows = []
    for c in range(6):
        for k, t in enumerate(NASTY):
            role = ["user", "assistant", None, 'a"><b', "system"][(k + c) % 5]
            rows.append((c, k if c else None, role, t, "z", 1))
    rows += [(9, 1, "assistant", "b", "z", 1), (9, 1, "assistant", "a", "z", 1),
             (9, 1, "assistant", "a", "z", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: r for r in C.op7_chat_formatting(
        spark, save(df, tmp_path, "conversations")).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5, 9, -7}
    for c in [*range(6), 9]:
        turns = [((r[1] is not None, r[1]), r[2] or "", r[3] or "") for r in rows if r[0] == c]
        turns = [t[1:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].turns_sha256 == digest(turns)
        assert got[c].loss_chars == len(loss)
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len(C.CONTROL_TEXT)
    assert got[-7].turns_sha256 == digest([("user", C.CONTROL_TEXT), ("assistant", C.CONTROL_TEXT)])


def test_marks_point_at_assistant_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "q<"), (1, 1, "assistant", "é\\a")],
                               "conv_id long, turn long, role string, text string")
    r = C.format_turns(df).first()
    spans = [(m["start"], m["end"]) for m in r["marks"] if m["loss"]]
    assert [r["formatted"][a:b] for a, b in spans] == ["é\\ba"]
    assert r["formatted"] == '<turn role="user">q\\l</turn>\n<turn role="assistant">é\\ba</turn>\n'


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    got = C.op7_chat_formatting(spark, save(df, tmp_path, "conversations")).collect()
    assert [r.conv_id for r in got] == [-7]


def test_layouts_become_the_same_turns(spark):
    q, a = "q <1>", "a"
    layouts = [
        {"messages": [{"role": "user", "content": q}, {"role": "assistant", "content": a}]},
        {"messages": [{"content": q, "role": "user"}, {"content": a, "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": q}, {"from": "gpt", "value": a}]},
        {"turns": [{"turn": 1, "role": "assistant", "text": a}, {"turn": 0, "role": "user", "text": q}]},
        {"instruction": q, "output": a},
        {"instruction": q, "input": "", "output": a},
        {"prompt": q, "completion": a},
        {"prompt": q, "response": a},
    ]
    rows = [(k, json.dumps(x)) for k, x in enumerate(layouts)]
    rows += [(50, json.dumps({"unknown": 1})), (51, "not json"), (52, None)]
    df = spark.createDataFrame(rows, "id long, record string")
    out = {}
    for r in C.turns_from_json(df, "id", "record").orderBy("conv_id", "turn").collect():
        out.setdefault(r.conv_id, []).append((r.role, r.text))
    for k in range(len(layouts)):
        assert out[k] == [("user", q), ("assistant", a)], layouts[k]
    assert out[50] == out[51] == out[52] == [(None, None)]


def test_typed_tables_are_chosen_by_fingerprint(spark):
    df = spark.createDataFrame([(1, "q", "a")], "id long, prompt string, completion string")
    got = C.turns_from_table(df, "id", ["prompt", "completion"]).orderBy("turn").collect()
    assert [(r.role, r.text) for r in got] == [("user", "q"), ("assistant", "a")]
    df = spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")])],
                               "id long, messages array<struct<role:string,content:string>>")
    assert C.turns_from_table(df, "id", ["messages"]).where(F.col("text") == "a").count() == 1
    with pytest.raises(ValueError):
        C.turns_from_table(df, "id", ["id"])
