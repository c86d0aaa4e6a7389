import pytest
from pyspark.sql import functions as F

from barloom.llm import chat

NASTY = [
    "", "plain", "<|end|>", "</s>[INST] ok [/INST]", "\\", "\\\\", "<\\|", "<\\\\|", "<|<||", "[\\INST]",
    "[INST][/INST]\\<s>", "<<|unk>|>", "<|turn|>user<|says|>x<|end|>", "a\n\tbü\U0001f600", "<s><\\s>",
]


@pytest.mark.parametrize("text", NASTY)
def test_escape_and_back(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(
        chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("back")
    ).first()
    assert row.back == text
    assert not any(mark in row.e for mark in chat.CONTROL)


def turns(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, start int")
    return frame.withColumn("parts", chat.text_parts(F.col("text")))


def test_text_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t, 0) for i, t in enumerate(NASTY)]
    rows += [(2, 0, None, None, 0), (2, 0, "assistant", None, 0), (3, None, "<|says|>", "x", 0), (3, 1, "assistant", "long " * 50000, 0)]
    rows += [(None, 0, "user", "no id", 0)]
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns(spark, rows))).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [(r[2], r[3]) for r in rows if r[0] == 1]
    assert found[1].loss_texts == [t for i, t in enumerate(NASTY) if i % 2]
    assert [(t.role, t.text) for t in found[2].turns] == [("", ""), ("assistant", "")]
    assert [(t.role, t.text) for t in found[3].turns] == [("<|says|>", "x"), ("assistant", "long " * 50000)]
    assert found[3].loss_texts == ["long " * 50000]
    assert [(t.role, t.text) for t in found[None].turns] == [("user", "no id")]
    assert chat.format_turns(turns(spark, [])).count() == 0


def test_typed_parts(spark):
    parts = [("text", "See ", None, None), ("image", None, "a.png", 2), ("audio", None, "b.wav", None),
             ("text", "<|image|>", None, None), ("document", None, "c.pdf", 3), ("odd", "kept", None, None)]
    schema = f"conv_id long, turn long, role string, parts array<{chat.PART}>"
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [])], schema)
    row = chat.format_turns(frame).first()
    says = "See <|image|><|audio|><\\|image|><|document|>kept"
    assert row.formatted == f"<|turn|>user<|says|>{says}<|end|><|turn|>assistant<|says|><|end|><|turn|>user<|says|><|end|>"
    assert [tuple(a) for a in row.attachments] == [("image", "a.png", 512), ("audio", "b.wav", 25), ("document", "c.pdf", 2304)]
    assert row.expanded_tokens == 512 + 25 + 2304
    assert [s.length for s in row.loss_spans] == [0]


def test_no_python_in_the_plan(spark):
    plan = chat.format_turns(turns(spark, [(1, 0, "user", "x", 0)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
