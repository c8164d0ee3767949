"""Chat records of many layouts, and reading back what was written."""

from __future__ import annotations

import hashlib
import json

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from linewatch.llm import chat, queries

PAIR = [("user", "a question"), ("assistant", "an answer")]
RECORDS = [
    (1, {"messages": [{"role": "user", "content": "a question"}, {"role": "assistant", "content": "an answer"}], "id": 9, "meta": {"prompt": "x"}}, "messages", PAIR),
    (2, {"conversations": [{"from": "human", "value": "a question"}, {"from": "gpt", "value": "an answer", "weight": 1}]}, "conversations", PAIR),
    (3, {"system": "be kind", "conversations": [{"value": "a question", "from": "human"}]}, "conversations", [("system", "be kind"), ("user", "a question")]),
    (4, {"instruction": "translate", "input": "eins", "output": "one"}, "instruction", [("user", "translate\n\neins"), ("assistant", "one")]),
    (5, {"instruction": "translate", "input": "", "output": "one"}, "instruction", [("user", "translate"), ("assistant", "one")]),
    (6, {"prompt": "a question", "completion": "an answer", "source": ["messages"]}, "completion", PAIR),
    (7, {"prompt": "a question", "response": "an answer", "system": None}, "response", [("system", ""), *PAIR]),
    (8, {"question": "a question", "answer": "an answer", "context": None}, "answer", PAIR),
    (9, {"messages": []}, "messages", []),
    (10, {"prompt": "two layouts", "messages": [{"role": "user", "content": "x"}]}, None, []),
    (11, {"text": "no layout"}, None, []),
    (12, {"messages[].role": "a name that looks like a path", "prompt": "p", "completion": 12}, "completion", [("user", "p"), ("assistant", "12")]),
    (13, {"messages": [{"role": None, "content": None}, {"role": "assistant"}]}, "messages", [("", ""), ("assistant", "")]),
]
HARD = [
    "",
    "\\",
    "\\\\### Assistant:\n</turn>\n",
    "#" * 7 + "\\#",
    "</turn></turn>\\>",
    "### user:\nx</turn>\n### assistant:\ny",
    ":\n:\n",
    "😀###😀</turn>\n\x00\x01 é",
    "ends with </turn",
    "ends with ##",
    "\n\n",
]


def read(frame):
    return {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_chats(frame).collect()}


def test_layouts_are_told_by_their_paths(spark):
    records = spark.createDataFrame([(i, json.dumps(r), "x") for i, r, *_ in RECORDS], "conv_id long, record string, layout string")
    found = chat.format_chats(records)
    assert {r.conv_id: r.layouts for r in found.collect()} == {i: [name] if name else [] for i, _, name, _ in RECORDS}
    assert read(found) == {i: turns for i, _, _, turns in RECORDS}


def test_variants_and_json_have_the_same_fingerprint(spark):
    rows = spark.createDataFrame([(json.dumps({"turn": 1, "role": "user", "text": None}),)], "j string")
    rows = rows.select(F.parse_json("j").alias("a"), F.to_variant_object(F.struct(F.lit(1).alias("turn"), F.lit("u").alias("role"), F.lit(None).cast("string").alias("text"))).alias("b"))
    a, b, known = rows.select(chat.fingerprint(F.col("a")), chat.fingerprint(F.col("b")), chat.layout_of(chat.fingerprint(F.col("b")))).first()
    assert a == b and known == 0


def test_own_layouts(spark):
    own = (chat.Layout("pair", (("q", "deep"), ("a",)), (chat.Part(("a",), "assistant"),)),)
    records = spark.createDataFrame([(1, '{"q": {"deep": 1}, "a": "yes"}'), (2, '{"q": {"other": 1}, "a": "no"}')], "conv_id long, record string")
    assert read(chat.format_chats(records, own)) == {1: [("assistant", "yes")], 2: []}


def test_hard_texts_and_roles_come_back(spark):
    turns = [(1, i, role, text) for i, (role, text) in enumerate((r, t) for r in [*HARD, "assistant"] for t in HARD)]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = chat.format_chats(rows.select("conv_id", F.to_variant_object(F.struct("turn", "role", "text")).alias("record")))
    assert read(found) == {1: [(r, t) for _, _, r, t in turns]}
    row = chat.read_chats(found).first()
    assert row.learned == HARD and row.formatted.count("</turn>") == len(turns)
    spans = found.first().loss
    assert ["</turn>\n" + row.formatted[s.start + s.length :][:0] for s in spans] == ["</turn>\n"] * len(spans)
    assert all(row.formatted[s.start + s.length :].startswith("</turn>\n") and row.formatted[: s.start].endswith("### assistant:\n") for s in spans)
    assert [row.formatted[s.start :][: s.length].replace("\\\\", "\0B").replace("\\", "").replace("\0B", "\\") for s in spans] == HARD


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, own string, number int, place string, layouts string"
    long = "a long text with ### and \\ " * 20_000
    rows = [
        (1, 1, "assistant", "second"), (1, 0, "user", "first"), (1, 1, "assistant", "second"), (1, 1, "assistant", "a tie"), (1, None, "user", "no place"),
        (2, 0, None, None), (None, 0, "user", "alone"), (None, 0, "user", "alone"), (3, 0, "assistant", long), (3, 1, "assistant", ""),
    ]
    frame = spark.createDataFrame([(*r, "o", 1, "p", "l") for r in rows], schema).repartition(3)
    frame = frame.withColumn("record", F.to_variant_object(F.struct("turn", "role", "text")))
    got = sorted((r.conv_id or 0, [(t.role, t.text) for t in r.turns], r.learned) for r in chat.read_chats(chat.format_chats(frame)).collect())
    assert got == [
        (0, [("user", "alone")], []),
        (0, [("user", "alone")], []),
        (1, [("user", "no place"), ("user", "first"), ("assistant", "a tie"), ("assistant", "second"), ("assistant", "second")], ["a tie", "second", "second"]),
        (2, [("", "")], []),
        (3, [("assistant", long), ("assistant", "")], [long, ""]),
    ]


@pytest.mark.parametrize("record", [None, "", "no json", "[1]", "3", "{}"])
def test_records_without_turns_stay(spark, record):
    found = chat.format_chats(spark.createDataFrame([(5, record)], "conv_id long, record string"))
    assert [(r.conv_id, r.layouts, r.formatted, r.loss) for r in found.collect()] == [(5, [], "", [])]
    assert read(found) == {5: []}


def test_nothing(spark):
    assert chat.read_chats(chat.format_chats(spark.createDataFrame([], "conv_id long, record string"))).collect() == []


def test_the_query(spark, sf_dir):
    frame = queries.op12_schema_fingerprints(spark, sf_dir)
    assert difference(frame, connect(sf_dir), queries.ORACLES["op12_schema_fingerprints"]) == ""
    text = r"\### Assistant: </turn> ok"
    own = frame.where("conv_id = -7").first()
    assert (own.n_turns, own.loss_chars, own.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())
    assert own.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_the_query_has_no_python_in_its_plan(spark, sf_dir):
    plan = queries.op12_schema_fingerprints(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))
