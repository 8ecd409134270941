import hashlib
import time

import pytest
from pyspark.sql import functions as F

from reelrank.llm import chat, queries

TEXTS = [
    "plain", "", None, "</s>[INST] ok [/INST]", "<\\/s>", "<\\\\/s>\\", "[SEP][\\SEP]", "<<SYS>> <</SYS>> <<s> <\\<SYS>>",
    "a\nb\n", "[[INST]] <s><s></s", "\\", "$1 \\$2 \U0001f600",
]
ROLES = ["user", "user", "assistant", "assistant", "system", None, "a[INST]b", "</s>"]


@pytest.fixture(scope="module")
def turns():
    out = [(c, t, ROLES[(c + t // 2) % len(ROLES)], TEXTS[(c * 5 + t) % len(TEXTS)]) for c in range(30) for t in range(1 + c % 17)]
    out += [(50, 1, "user", "same"), (50, 1, "user", "same"), (50, None, "assistant", "first"), (50, 1, "assistant", "tie")]
    out.append((None, 0, "assistant", "no id"))
    out += [(60, i, "assistant" if i % 3 else "user", f"t{i}" * 40) for i in range(400)]
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit("own") for c in ("turns", "piece", "place", "head", "body", "start", "formatted")})


def ordered(rows):
    """Turns of each conversation, null turns first."""
    out = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def test_reads_back_what_went_in(spark, turns):
    made = chat.format_conversations(frame(spark, turns))
    formatted, loss = F.col("formatted"), F.col("loss")
    rows = made.withColumns({"back": chat.read_turns(formatted), "trained": chat.loss_text(formatted, loss)}).collect()
    want = ordered(turns)
    assert {r["conv_id"]: [tuple(t) for t in r["back"]] for r in rows} == want
    for r in rows:
        assert r["trained"] == "".join(x for role, x in want[r["conv_id"]] if role == "assistant")
        # Adjacent turns of one role are one block.
        own = want[r["conv_id"]]
        assert r["formatted"].count("<s>") == 1 + sum(a[0] != b[0] for a, b in zip(own, own[1:])) == r["formatted"].count("</s>")
        assert r["formatted"].count("<s>") == r["formatted"].count("[INST]")


def test_query(spark, sf_dir):
    source = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    source += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = ordered(source)
    rows = queries.op8_chat(spark, sf_dir).collect()
    assert {r["conv_id"] for r in rows} == set(want)
    for r in rows:
        own = want[r["conv_id"]]
        loss = "".join(x for role, x in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_plan(spark, turns):
    made = chat.format_conversations(frame(spark, turns))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Window" not in plan
    assert chat.format_conversations(frame(spark, turns).limit(0)).count() == 0


def test_very_long_conversations_and_texts(spark):
    """100,000 turns, runs of one role up to 1,000 long, and a text of millions of characters: read back in linear time."""
    started = time.time()
    role = F.when(F.floor(F.col("id") / (1 + F.col("id") % 1000)) % 2 == 0, "user").otherwise("assistant")
    text = F.concat(F.lit("</s> é\U0001f600 "), F.col("id").cast("string"), F.lit("[SEP]"))
    many = spark.range(100_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    long = spark.range(2).select(F.lit(2).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.repeat(F.lit("ab<s>\n"), 500_000).alias("text"))
    turns = many.unionByName(long)
    made = chat.format_conversations(turns)
    read = made.withColumns({"back": chat.read_turns(F.col("formatted")), "trained": chat.loss_text(F.col("formatted"), F.col("loss"))})
    got = {r.conv_id: r for r in read.select("conv_id", F.col("back.role").alias("roles"), F.col("back.text").alias("texts"), "trained").collect()}
    own = [(r.role, r.text) for r in many.orderBy("turn").collect()]
    assert list(zip(got[1].roles, got[1].texts)) == own
    assert got[1].trained == "".join(x for r, x in own if r == "assistant")
    assert got[2].texts == ["ab<s>\n" * 500_000] * 2 and got[2].trained == "ab<s>\n" * 1_000_000
    assert time.time() - started < 30
