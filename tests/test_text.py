import random
import re

import pytest
from plainweave.functions import chat, text
from plainweave.functions.fixed import DEFAULT_INSTRUCTION, INSTRUCTIONS, SYSTEM_PROMPT
from plainweave.functions.hashing import order_key, uniform
from pyspark.sql import functions as F


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first()["y"]


def plain_normal(line):
    """The published tokenisation, step by step."""
    line = line.lower().replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    for old, new in [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]:
        line = line.replace(old, new)
    line = f" {line} "
    line = re.sub(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 ", line)
    line = re.sub(r"([^0-9])([\.,])", r"\1 \2 ", line)
    line = re.sub(r"([\.,])([^0-9])", r" \1 \2", line)
    line = re.sub(r"([0-9])(-)", r"\1 \2 ", line)
    return " ".join(line.split())


def test_normalise_like_published(spark):
    rng = random.Random(1)
    bits = list("aZé9 .,,..--!?/:;()[]{}~`^_|\\\"'&<>=+*%$#@\n\t  €\U0001f600") + [
        "<skipped>", "-\n", "&quot;", "&amp;", "&lt;", "&amp;lt;", "3.5", "1,000", "5-6", "..5",
    ]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select("x", text.normalise(F.col("x")).alias("y")).collect()
    assert [(r["x"], r["y"]) for r in rows] == [(t, plain_normal(t)) for t in texts]


def test_empty_text_has_one_empty_token(spark):
    assert one(spark, "", text.normal_tokens(F.col("x"))) == [""]
    assert one(spark, " \n", text.normal_tokens(F.col("x"))) == [""]


def test_strip_and_tokens(spark):
    assert one(spark, " \t a b\x85\n", text.strip(F.col("x"))) == "a b"
    assert one(spark, "été b_2, \U0001f600!", text.tokens(F.col("x"))) == [
        "été", "b_2", ",", "\U0001f600", "!",
    ]


def test_sentences(spark):
    assert one(spark, " A b. C?! d", text.sentences(F.col("x"))) == ["A b.", "C?!", "d"]
    assert one(spark, "A b. C", text.first_sentence(F.col("x"))) == "A b."
    assert one(spark, "", text.first_sentence(F.col("x"))) == ""


def test_instruction_rule_counts_code_points(spark):
    rows = [(i, "é" * n) for n in (99, 100, 101) for i in range(n * 1000, n * 1000 + 400)]
    rows += [(i, "\U0001f600" * 99) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, prompt string")
    df = df.withColumn("i", chat.instruction(F.col("prompt"), ["id"]))
    shares = {
        r["n"]: r["share"]
        for r in df.groupBy(F.length("prompt").alias("n")).agg(
            F.avg((F.col("i") == DEFAULT_INSTRUCTION).cast("int")).alias("share")
        ).collect()
    }
    assert shares[99] == 1.0
    assert 0.1 < shares[100] < 0.3 and 0.1 < shares[101] < 0.3
    used = {r["i"] for r in df.select("i").distinct().collect()}
    assert used == {DEFAULT_INSTRUCTION, *INSTRUCTIONS}


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    draw = lambda d: {
        r["id"]: (r["u"], r["k"])
        for r in d.select("id", uniform(7, "p", ["id"]).alias("u"), order_key(7, "p", ["id"]).alias("k")).collect()
    }
    assert draw(df.repartition(1)) == draw(df.repartition(17))
    values = [u for u, _ in draw(df).values()]
    assert 0 <= min(values) and max(values) < 1 and 0.4 < sum(values) / 500 < 0.6


def test_two_spaces_after_default_instruction(spark):
    turns = chat.two_turns(F.col("x"), F.lit("r"), F.lit(DEFAULT_INSTRUCTION))
    got = one(spark, "p", chat.conversation(turns))
    assert [(m["role"], m["content"]) for m in got] == [
        ("user", "Vereenvoudig:  p"), ("assistant", "r"),
    ]


def test_render_forms_agree(spark):
    for template in ("role_tags", "header_ids", "chatml"):
        turns = chat.three_turns(F.col("x"), F.lit("r"))
        for answer in (False, True):
            direct = one(spark, "p", chat.render_turns(turns, template, answer))
            stored = one(spark, "p", chat.render(chat.conversation(turns), template, answer))
            assert direct == stored
    assert one(spark, "p", chat.render_turns(chat.three_turns(F.col("x"), F.lit("r")))) == (
        f"<|start_of_role|>system<|end_of_role|>{SYSTEM_PROMPT}<|end_of_text|>\n"
        "<|start_of_role|>user<|end_of_role|>Vereenvoudig: p<|end_of_text|>\n"
        "<|start_of_role|>assistant<|end_of_role|>r<|end_of_text|>"
    )


def test_dispatch_and_system_off(spark):
    messages = chat.conversation(chat.three_turns(F.col("x"), F.lit("r"), F.lit("S")))
    df = spark.createDataFrame([("p", "chatml"), ("p", "nothing")], "x string, kind string")
    rows = df.select("kind", chat.render_for(F.col("kind"), chat.without_system(messages)).alias("t"))
    got = {r["kind"]: r["t"] for r in rows.collect()}
    assert got["nothing"] is None
    assert got["chatml"].startswith("<|im_start|>user\nVereenvoudig: p<|im_end|>")
    assert one(spark, "p", chat.last_content(messages)) == "r"


def test_formatter_takes_lists(spark):
    df = spark.createDataFrame([(["a", "b"], ["x", "y"])], "p array<string>, r array<string>")
    lists = chat.formatter_lists("chatml", "S")(F.col("p"), F.col("r"))
    single = chat.formatter("chatml", "S")
    expected = df.select(F.array(single(F.lit("a"), F.lit("x")), single(F.lit("b"), F.lit("y"))))
    assert df.select(lists).first()[0] == expected.first()[0]
    uneven = spark.createDataFrame([(["a", "b", "c"], ["x", "y"])], df.schema)
    with pytest.raises(Exception, match="unequal length"):
        uneven.select(lists).collect()
    missing = spark.createDataFrame([(None, ["x"])], df.schema)
    assert missing.select(lists).first()[0] is None


def test_null_turn_makes_a_null_text(spark):
    rows = [([("user", "a"), ("assistant", None)],), ([("user", "a")],)]
    df = spark.createDataFrame(rows, "m array<struct<role:string,content:string>>")
    got = [r[0] for r in df.select(chat.render(F.col("m"))).collect()]
    assert got[0] is None and got[1] is not None


def test_system_prompt_default(spark):
    df = spark.createDataFrame([("own",), (None,)], "x string")
    got = [r[0] for r in df.select(chat.system_prompt(F.col("x"))).collect()]
    assert got == ["own", SYSTEM_PROMPT]
