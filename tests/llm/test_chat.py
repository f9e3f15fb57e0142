import random

from pyspark.sql import functions as F

from pickwise.llm import chat


def _back(spark, rows, schema="conv_id long, turn long, role string, text string"):
    done = chat.format_conversations(spark.createDataFrame(rows, schema))
    out = done.select("conv_id", "formatted", chat.parse_formatted(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("segments")).alias("loss")).collect()
    return {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss"], r["formatted"]) for r in out}


def test_round_trip_of_control_strings(spark):
    rng = random.Random(4)
    bits = ["<|", "|>", "<|turn|>", "<|text|>", "<|part|>", "<|end|>", "[INST]", "[/INST]", "</s>", "<s>", "\\", "\n",
            "<<SYS>>", "<", "|", "é", "$1", "user", ""]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "system", "a<|text|>b", "x\\"])
            rows.append((conv, turn, role, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 9)))))
    got = _back(spark, rows)
    for conv in range(60):
        turns = [(r, t) for c, _, r, t in sorted(rows, key=lambda x: x[:2]) if c == conv]
        assert got[conv][0] == turns
        assert got[conv][1] == "".join(t for r, t in turns if r == "assistant")


def test_adjacent_turns_of_one_role_share_a_block(spark):
    got = _back(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")])
    assert got[1][2] == "<|turn|>user<|text|>a<|part|>b<|end|>\n<|turn|>assistant<|text|>c<|end|>\n"


def test_nulls_ties_repeats_and_no_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 0, "assistant", "y"),
            (2, 5, "b", "t"), (2, 5, "a", "t")]
    got = _back(spark, rows)
    assert got[1][0] == [("", "x"), ("user", ""), ("user", "")]
    assert got[None][1] == "y"
    assert got[2][0] == [("a", "t"), ("b", "t")]
    assert _back(spark, []) == {}


def test_long_conversation_and_clashing_columns(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", "t" * 2000) for k in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .selectExpr("*", "'s' as segments", "1 as turns", "2 as formatted")
    r = chat.format_conversations(df).select(F.size(chat.parse_formatted(F.col("formatted"))).alias("n")).first()
    assert r["n"] == 500
