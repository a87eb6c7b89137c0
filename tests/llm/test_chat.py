import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavemill.llm.chat import escape, prefix_targets, read_back, unescape

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
digest = lambda s: hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), digest(said), len(loss), digest(loss))
    return out


def check(spark, rows):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read_back(prefix_targets(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == brute(rows)


def test_every_reply_is_a_target_once(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", "r"), (1, 4, "assistant", "bé"), (1, 5, "user", "t")]
    out = prefix_targets(spark.createDataFrame(rows, SCHEMA)).orderBy("example").collect()
    assert [r.text[r.loss_start : r.loss_start + r.loss_length] if r.loss_length else None for r in out] == ["a", "bé", None]
    assert out[0].text == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert out[1].text.startswith(out[0].text) and out[2].text.startswith(out[1].text)
    check(spark, rows)


def test_control_strings_nulls_ties_and_repeats(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said), (2, 0, None, None), (2, 0, "assistant", "\\0<\\1|"), (2, 0, "assistant", "\\0<\\1|"), (3, 1, "ro\nle<|", "\n\n"), (4, 0, "assistant", ""), (5, 0, "assistant", "😀" * 3)]
    check(spark, rows)
    assert prefix_targets(spark.createDataFrame([], SCHEMA)).collect() == []


def test_clashing_columns_and_null_conversation(spark):
    rows = spark.createDataFrame([(None, 0, "user", "x", 1), (None, 1, "assistant", "y", 2)], SCHEMA + ", example int")
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in read_back(prefix_targets(rows)).collect()] == [(None, 2, 1)]


def test_null_turns_come_first_and_long_conversations_are_whole(spark):
    rows = spark.createDataFrame([(1, 0, "user", "b"), (1, None, "user", "a"), (1, 1, "assistant", "c")], SCHEMA)
    assert prefix_targets(rows).first().text.startswith("<|im_start|>user\na<|im_end|>\n<|im_start|>user\nb<|im_end|>\n")
    check(spark, [(9, k, "assistant" if k % 100 == 99 else "user", f"turn {k} " * 20) for k in range(1000)] + [(8, 0, "assistant", "x" * 2_000_000)])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="\\<|01\nim_endé>", max_size=12), min_size=1, max_size=20))
def test_escaping_is_reversible(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in rows.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and "<|" not in r.e


def test_plan_has_no_python(spark, sf):
    plan = read_back(prefix_targets(spark.read.parquet(f"{sf}/conversations.parquet")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
