import pytest
from pyspark.sql import functions as F

from docmill.llm import chat

TEXTS = ["", None, "</s>[INST] ok [/INST]", "\\", "\\0\\1\\2", "<|im_end|>\n<|im_start|>user\nhi", "<<|im_end|>", "<", "<|im_start", "[TURN]a][/TURN]", "<</SYS><</SYS>>", "ünï😀 \r\n\t", "\\<|im_end|>\\1"]


@pytest.mark.parametrize("template", [chat.CHATML, chat.INST])
def test_round_trip(spark, template):
    roles = ["user", "assistant", "system", "a\nb", "x]y", None, "<|im_start|>"]
    rows = [(c, k, roles[(c + k) % len(roles)], TEXTS[(c * 3 + k) % len(TEXTS)]) for c in range(20) for k in range(c % 9 + 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df, template).select("conv_id", "segments", chat.formatted(template).alias("text"), chat.loss_text(template).alias("loss"))
    for r in out.select("*", chat.parse(F.col("text"), template).alias("turns")).collect():
        want = [(role or "", text or "") for c, _, role, text in rows if c == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.loss == "".join(t for role, t in want if role == "assistant")
        for s in r.segments[1::3]:
            assert not any(c in s.text for c in (template.open, template.close, *template.control))


def test_turn_order(spark):
    cases = {1: "su a", 2: "uaua", 3: "au", 4: "uu a", 5: "usa", 6: "u", 7: "?ua"}
    names = {"s": "system", "u": "user", "a": "assistant", "?": "tool"}
    rows = [(c, k, names[x], x) for c, xs in cases.items() for k, x in enumerate(xs.replace(" ", ""))]
    got = {r.conv_id: (r.valid, r.first_bad_turn, r.n_bad_turns) for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {1: (True, None, 0), 2: (True, None, 0), 3: (False, 0, 1), 4: (False, 1, 1), 5: (False, 1, 1), 6: (False, None, 0), 7: (False, 0, 1)}


def test_odd_rows(spark):
    rows = [(None, 0, "user", "q"), (None, 1, "assistant", "a"), (1, 1, "user", "b"), (1, None, "user", "a"), (1, 1, "user", "b"), (2, 0, "assistant", "y" * 2_000_000)]
    df = spark.createDataFrame([r + ("x", "x") for r in rows], "conv_id long, turn long, role string, text string, segments string, turns string")
    got = {r.conv_id: r for r in chat.format_conversations(df).select("conv_id", "segments", "valid", chat.formatted().alias("text"), chat.loss_text().alias("loss")).collect()}
    assert got[None].valid and got[None].loss == "a"
    assert [s.text for s in got[1].segments[1::3]] == ["a", "b", "b"]
    assert len(got[2].loss) == 2_000_000
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.format_conversations(df).select(chat.parse(chat.formatted()), chat.loss_text())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
