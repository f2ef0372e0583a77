from pyspark.sql import functions as F

from yarnscope.llm import chat_format as cf

NASTY = ["", "</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>", "&lt; &amp;lt; &", "a\nb\n", "&#10;&#91;", "é😀<", "<|image|>", None]


def talks(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mask string, m string")
    return cf.read_back(cf.format_messages(df.withColumn("parts", cf.text_part(F.col("text")))))


def test_round_trip_of_nasty_texts(spark):
    rows = [(c, t, role, text, "x", "y") for c in (1, 2) for t, (role, text) in enumerate(zip(["user", "assistant", "ro\nle", "<|turn|>", "assistant", None, "tool", "system", "assistant"], NASTY, strict=True))]
    rows += [(None, 0, "user", "x", "", ""), (3, None, "assistant", "second" * 30_000, "", ""), (3, 1, "user", "b", "", ""), (3, 1, "user", "b", "", "")]
    got = {r.conv_id: r for r in talks(spark, rows[::-1]).collect()}
    assert set(got) == {1, 2, 3, None}
    for c in (1, 2):
        want = [(role or "", text or "", role == "assistant") for k, _, role, text, _, _ in rows if k == c]
        assert [(t.role, t.text, t.loss) for t in got[c].turns] == want
    assert [t.text for t in got[3].turns] == ["second" * 30_000, "b", "b"]
    for r in got.values():
        assert sum(x.before + x.inside + x.after for x in r.mask) == len(r.formatted)
        assert "[INST]" not in r.formatted and "</s>" not in r.formatted
        at = 0
        for x, t in zip(r.mask, r.turns, strict=True):
            body = r.formatted[at + x.before:at + x.before + x.inside]
            assert body.replace("&#91;", "[").replace("&lt;", "<").replace("&amp;", "&") == t.text
            at += x.before + x.inside + x.after


def test_typed_parts(spark):
    part = "named_struct('kind', {}, 'text', {}, 'ref', {}, 'width', cast({} as bigint), 'height', cast({} as bigint), 'seconds', cast({} as double), 'pages', cast({} as bigint))"
    parts = [("'text'", "'see <'", "null", "null", "null", "null", "null"), ("'image'", "null", "'i.png'", 57, 28, "null", "null"),
             ("'audio'", "null", "'a.wav'", "null", "null", 1.5, "null"), ("'document'", "null", "'d.pdf'", "null", "null", "null", 3), ("'other'", "'gone'", "null", "null", "null", "null", "null")]
    sql = "array(" + ", ".join(part.format(*p) for p in parts) + ")"
    df = spark.sql(f"select 1L conv_id, 0L turn, 'user' role, {sql} parts union all select 1L, 1L, 'assistant', null")
    r = cf.read_back(cf.format_messages(df)).first()
    assert r.formatted == "<|turn|>user\nsee &lt;<|image|><|audio|><|document|><|end|><|turn|>assistant\n<|end|>"
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "i.png", 3), ("audio", "a.wav", 38), ("document", "d.pdf", 1536)]
    assert [(t.role, t.text, t.loss) for t in r.turns] == [("user", "see <<|image|><|audio|><|document|>", False), ("assistant", "", True)]


def test_empty_table(spark):
    assert talks(spark, []).count() == 0
