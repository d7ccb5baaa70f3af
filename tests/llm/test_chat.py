from pyspark.sql import functions as F

from trendlens.llm import chat
from trendlens.llm.queries import QUERIES

LOG = "conv_id long, seq long, kind string, message long, role string, text string"


def final(spark, rows):
    out = chat.fold(spark.createDataFrame(rows, LOG)).orderBy("conv_id", "message").collect()
    return [(r.conv_id, r.message, r.role, r.text) for r in out]


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, "delta", 1, "user", "Hel"), (1, 2, "delta", 1, "user", "lo"),
        (1, 3, "delta", 2, "assistant", "first"), (1, 4, "delta", 3, "user", "more"),
        (1, 5, "regenerate", 2, "assistant", "sec"), (1, 6, "delta", 2, "assistant", "ond"),
        (1, 7, "edit", 1, "user", "Bye"),
        (2, 1, "delta", 1, None, None),
    ]
    assert final(spark, rows) == [(1, 1, "user", "Bye"), (1, 2, "assistant", "second"), (2, 1, "", "")]
    assert final(spark, rows[::-1]) == final(spark, rows)  # order of rows does not matter


def test_round_trip_of_control_strings(spark):
    texts = ["</s>[INST] ok [/INST]", "<|start|>user\n<|end|>\n", "\\", "<\\|", "\\\\<|", "a\n\nb", "", "<|", "|>", "é中"]
    rows = [(7, i, r, t) for i, t in enumerate(texts) for r in [("user", "assistant", "x\ny<|\\")[i % 3]]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.render(chat.fold(chat.log_of_rows(df)))).collect()[0]
    assert [(t.role, t.text) for t in back.turns] == [(r, t) for _, _, r, t in rows]
    assert back.loss_text == "".join(t for _, _, r, t in rows if r == "assistant")


def test_ties_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, None, None)],
                               "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("clash"))
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.log_of_rows(df)))).collect()}
    assert [t.text for t in got[1].turns] == ["a", "a", "b"]
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")]
    assert chat.digest(chat.read_back(chat.render(chat.fold(chat.log_of_rows(df.limit(0)))))).count() == 0


def test_native_plan(spark):
    plan = QUERIES["op2_chat"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


def plain_fold(log):
    """The final messages of one conversation's events, applied one by one."""
    state = {}
    for _, kind, message, role, text in log:
        if kind == "delta":
            state.setdefault(message, []).append((role, text))
        elif kind == "edit":
            state[message] = [(role, text)]
        else:
            state = {m: parts for m, parts in state.items() if m < message}
            state[message] = [(role, text)]
    return [(m, parts[0][0], "".join(t for _, t in parts)) for m, parts in sorted(state.items())]


def test_random_logs_equal_a_plain_fold(spark):
    import random

    rng = random.Random(6)
    rows, want = [], []
    for conv in range(150):
        log = [(seq, rng.choice(["delta", "delta", "delta", "edit", "regenerate"]), rng.randrange(4), rng.choice(["user", "assistant"]),
                rng.choice(["a", "b\n", "<|", ""])) for seq in range(rng.randrange(1, 14))]
        rows += [(conv, seq, kind, message, role, text) for seq, kind, message, role, text in log]
        want += [(conv, *m) for m in plain_fold(log)]
    rng.shuffle(rows)
    assert final(spark, rows) == want
