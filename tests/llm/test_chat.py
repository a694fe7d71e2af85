import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import chat

ROW = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                    T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]
MARK = chat.MARK


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    groups, own = {}, 0
    for conv, turn, role, text in rows:
        own += conv is None
        key = (conv, own if conv is None else 0)
        groups.setdefault(key, []).append((turn is None, turn or 0, role or "", text or ""))
    out = []
    for (conv, _), turns in groups.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), digest(said), len(loss), digest(loss)))
    return sorted(out, key=repr)


def run(spark, rows, clash=False):
    df = spark.createDataFrame(rows, ROW)
    if clash:
        df = df.select("*", *[F.lit("own").alias(c) for c in ("own", "rendered", "body", "loss", "formatted", "all", "nth", "begin")])
    return chat.digests(df)


def check(spark, rows, clash=False):
    got = [tuple(r)[:5] for r in run(spark, rows, clash).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_hostile_texts_against_brute_force(spark):
    draw = random.Random(5)
    parts = [*CONTROL, MARK, "0", "1", "2", "3", "\n", "<", "[", "/", "s>", "INST]", "é", "𝄞", "word ", "$1", "\\", " "]
    rows = [(draw.randrange(60), draw.randrange(8), draw.choice(["user", "assistant", "system", "a\nb", "<s>", MARK + "1", ""]),
             "".join(draw.choices(parts, k=draw.randint(0, 9)))) for _ in range(600)]
    check(spark, rows)


def test_masked_spans_are_the_replies(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "a" + MARK + "2[INST]é𝄞"), (1, 2, "assistant", ""), (1, 3, "assistant", "z")]
    done = chat.formatted(spark.createDataFrame(rows, ROW)).first()
    cut = [done.formatted[s.start:s.start + s.length] for s in done.loss]
    raw = done.formatted.encode()
    assert cut == [raw[s.first_byte:s.first_byte + s.n_bytes].decode() for s in done.loss]
    assert cut[1:] == ["", "z"] and cut[0] == "a" + MARK + "02" + MARK + "3INST]é𝄞"
    assert done.formatted.count("<s>") == 3 and done.formatted.count("[INST]") == 1
    assert [(t.role, t.text) for t in done.turns] == [(r, t) for _, _, r, t in rows]


def test_time_grows_with_the_turns(spark):
    """A conversation of many turns is cut once, not once for every turn."""
    rows = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
                                          "concat('text [INST] ', id, repeat(' x', 100)) AS text")
    began = time.time()
    assert chat.digests(rows).first().n_turns == 20_000
    assert time.time() - began < 60


def test_only_conflicting_texts_are_escaped(spark):
    plain = f"plain {MARK} and < [ text {MARK}9"
    made = chat.with_rendering(spark.createDataFrame([("user", plain), ("user", "x<s>")], "role string, text string"))
    assert [r.body for r in made.collect()] == [plain, f"x{MARK}2s>"]


@pytest.mark.parametrize("text", ["", "<s>a", "a<s>b</s>", "<s>a</s>b", "<s>a[INST]</s>", "[INST]no line[/INST]", "<s>a[/INST]",
                                  "[INST]u\nx</s>", "</s>a<s>"])
def test_what_is_not_of_the_grammar(spark, text):
    got = spark.createDataFrame([(text,)], "f string").select(chat.parsed(F.col("f")).alias("t")).first().t
    assert got == ([] if text == "" else None)


def test_defined_cases(spark):
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (None, None, None, None), (5, None, "assistant", "last"), (5, 1, "user", None),
            (5, 0, None, "<s>"), (6, 0, "assistant", "twice"), (6, 0, "assistant", "twice"), (7, 0, "assistant", "long " * 200_000 + "</s>")]
    check(spark, rows, clash=True)
    assert run(spark, []).count() == 0
