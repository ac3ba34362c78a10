import hashlib
import json
import random

from pyspark.sql import functions as F

from matchday.llm import chat

BITS = ["\\", "[", "]", "<", ">", "/", "s", "INST", "[INST]", "[/INST]", "</s>", "<s>", "[SYS]", "[ROLE]", "[TEXT]", "[/ROLE]", "a", "\n", " ", "é", "😀", "$1"]
ROWS = "conv_id long, turn long, role string, text string"


def conversations(count=80):
    r = random.Random(5)
    out = []
    for c in range(count):
        for t in range(r.randint(1, 6)):
            role = r.choice(["user", "assistant", "system", "tool", "[TEXT]", "a\\b", None])
            text = None if r.random() < 0.05 else "".join(r.choice(BITS) for _ in range(r.randint(0, 25)))
            out.append((c, t, role, text))
    return out + [(500, None, "user", "x"), (500, 0, "user", "y"), (500, 0, "user", "y"), (None, 0, "assistant", "z")]


def expected(rows):
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for *_, role, x in turns if role == "assistant")
        whole = "".join(f"{role}\n{x}\n" for *_, role, x in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    rows = conversations()
    table = spark.createDataFrame(rows, ROWS).withColumns({"turns": F.lit(1), "formatted": F.lit("x"), "layout": F.lit("y")})
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.report(table).collect()}
    assert got == expected(rows)


def test_no_control_string_survives_in_a_text(spark):
    texts = ["".join(random.Random(i).choice(BITS) for _ in range(30)) for i in range(200)]
    table = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in table.withColumn("back", chat.unescape(F.col("e"))).collect():
        assert r["back"] == r["t"]
        assert not any(x in r["e"] for x in ("[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[TEXT]", "<s>", "</s>"))


def test_loss_mask_places(spark):
    rows = [(1, 0, "user", "a\\b"), (1, 1, "assistant", "x</s>y"), (1, 2, "tool", "t"), (1, 3, "assistant", "")]
    made = chat.format_turns(chat.row_turns(spark.createDataFrame(rows, ROWS)))
    text = made.first()["formatted"]
    spans = [(r["start"], r["length"]) for r in chat.loss_mask(made).orderBy("start").collect()]
    assert [text[s : s + n] for s, n in spans] == ["x<\\/s>y", ""]


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages"),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 7}, "conversations"),
    ({"prompt": "q", "completion": "a", "other": {"x": 1}}, "prompt_completion"),
    ({"prompt": "q", "response": "a"}, "prompt_response"),
    ({"question": "q", "answer": "a"}, "question_answer"),
    ({"instruction": "q", "output": "a"}, "instruction"),
    ({"instruction": "q", "input": "", "output": "a"}, "instruction_input"),
    ({"nothing": 1}, "unknown"),
]


def test_json_records_by_fingerprint(spark):
    items = [(json.dumps(x),) for x, _ in RECORDS] + [(None,), ("{bad",), ("[1]",)]
    found = chat.json_turns(spark.createDataFrame(items, "record string")).collect()
    want = [name for _, name in RECORDS] + ["unknown"] * 3
    assert [r["layout"] for r in found] == want
    for r in found:
        turns = None if r["turns"] is None else [tuple(t) for t in r["turns"]]
        assert turns == (None if r["layout"] == "unknown" else [("user", "q"), ("assistant", "a")])


def test_typed_tables_by_fingerprint(spark):
    for record, name in RECORDS[:-1]:
        table = spark.read.json(spark.sparkContext.parallelize([json.dumps(record)]))
        found = chat.table_turns(table).first()
        assert found["layout"] == name and [tuple(t) for t in found["turns"]] == [("user", "q"), ("assistant", "a")]
    assert chat.table_turns(spark.createDataFrame([(1,)], "x int")).first()["layout"] == "unknown"


def test_other_names_of_turn_rows(spark):
    table = spark.createDataFrame([(1, 0, "user", "q")], "thread_id long, position long, author string, body string")
    assert [tuple(t) for t in chat.row_turns(table).first()["turns"]] == [("user", "q")]


def test_empty_table_and_long_conversation(spark):
    assert chat.report(spark.createDataFrame([], ROWS)).collect() == []
    rows = [(1, t, ("user", "assistant")[t % 2], "word " * 50) for t in range(3000)]
    r = chat.report(spark.createDataFrame(rows, ROWS)).first()
    assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == expected(rows)[1]


def test_main_path_is_native(spark):
    plan = chat.report(spark.createDataFrame([], ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_come_through_the_hashed_mapping(spark):
    for names in ("conv_id, turn, role, text", "thread_id, position, author, body"):
        made = chat.row_turns(spark.sql(f"SELECT * FROM VALUES (1L, 1L, 'assistant', 'b'), (1L, 0L, 'user', NULL) AS t({names})"))
        assert "xxhash64" in made._jdf.queryExecution().analyzed().toString()
        assert [(r["conv_id"], [tuple(t) for t in r["turns"]]) for r in made.collect()] == [(1, [("user", ""), ("assistant", "b")])]
