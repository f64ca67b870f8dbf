"""Chat formatting: reversible, merged, masked."""

import pytest

from siftline.llm import chat, queries

SAID = ["</s>[INST] ok [/INST]", "<|im_start|>user\nhi<|im_end|>\n", "&amp;&lt;|&&lt;", "<|turn|>", "", None, "<", "|im_end|>", "a\nb", "<<SYS>>x<</SYS>>", "é" * 1000, "&#10;&#91;INST]"]


def test_round_trip(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], s, 0) for k, s in enumerate(SAID)]
    rows += [(2, k, ["assistant", "assistant", "user", "user", "assistant"][k], s, 0) for k, s in enumerate(["x", "<|turn|>", "", "y", None])]
    rows += [(3, 0, "we\nird<|", "t", 0), (3, None, None, "first", 0), (3, 1, "assistant", "b", 0), (3, 1, "assistant", "a", 0), (3, 1, "assistant", "a", 0), (None, 1, "user", "lost", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.parse_formatted(formatted).collect()}
    for c in (1, 2, 3, None):
        mine = sorted(((t if t is not None else -1), r or "", s or "") for i, t, r, s, _ in rows if i == c)
        assert [(t.role, t.text) for t in got[c].turns] == [(r, s) for _, r, s in mine]
        assert got[c].loss_text == "".join(s for _, r, s in mine if r == "assistant")
    two = formatted.filter("conv_id = 2").first()
    assert two.formatted == "<|im_start|>assistant\nx<|turn|>&lt;|turn|><|im_end|>\n<|im_start|>user\n<|turn|>y<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    spans = [two.formatted[s.start - 1 : s.start - 1 + s.length] for s in two.loss_spans]
    assert spans == ["x", "&lt;|turn|>", ""]


def test_no_python_in_the_plan(spark):
    from conftest import SF

    plan = queries.op9_chat_format(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_equals_sql(spark, duck):
    from conftest import SF, same

    same(queries.op9_chat_format(spark, SF), duck, queries.OP9)


@pytest.mark.parametrize("n", [0])
def test_empty(spark, n):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.parse_formatted(chat.format_conversations(df)).count() == n
