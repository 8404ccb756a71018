"""Chat formatting: the machine against a plain walk, escapes as an exact round trip, borders of tasks, odd rows."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from ledgerline.llm.chat import INSTRUCT, Step, Template, digest_conversations, format_conversations

SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
     T.StructField("conv", T.StringType()), T.StructField("task", T.StringType()), T.StructField("state", T.StringType()), T.StructField("segments", T.StringType()), T.StructField("a.b", T.StringType())]
)

#: Every third "user" turn comes back to where the machine began: its state needs the whole history.
THIRDS = Template(
    "zero", ("zero",), ("[Z]", "[O]", "[T]", "[E]", "[R]", "[/R]"),
    tuple(s for here, to, mark in (("zero", "one", "[Z] "), ("one", "two", "[O] "), ("two", "zero", "[T] "))
          for s in (Step(here, "user", to, mark, " [E]", loss=here == "one"), Step(here, None, here, "[R]{role}[/R] ", " [E]", in_order=False))),
)


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "v") for r in rows], SCHEMA)


def walk(rows, template):
    """The plain version: one conversation after the other, turn by turn."""
    table = {(s.state, s.role): s for s in template.steps}
    convs = {}
    for c, at, role, text in rows:
        text = text or ""
        convs.setdefault(c, []).append((at is not None, at or 0, role is not None, role or "", hashlib.md5(text.encode()).hexdigest(), role, text))
    out = {}
    for c, turns in convs.items():
        state, whole, loss, valid, h, accepted = template.start, "", "", True, hashlib.sha256(), False
        for *_, role, text in sorted(turns, key=lambda t: t[:5]):
            step = table.get((state, role)) or table[(state, None)]
            whole += step.opening.replace("{role}", template.escape_text(role or "")) + template.escape_text(text) + step.closing
            loss += text if step.loss else ""
            h.update(f"{role or ''}\n{text}\n".encode())
            valid, accepted, state = valid and step.in_order, step.to in template.accept, step.to
        out[c] = (len(turns), h.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole), valid and accepted)
    return out


def got(df, template):
    return {r["conv_id"]: tuple(r)[1:] for r in digest_conversations(format_conversations(df, template), template).collect()}


ODD = ["", "</s>", "<\\s>", "<\\\\/s>", "[INST][/INST]", "<<s>s>", "[\\INST]", "a < b [x] \\", "[/ROLE] [END]\n", "ça ℵ 🙂 </s", "<conversation>", "[Z] [O]\\[E]"]


@pytest.mark.parametrize("template", [INSTRUCT, THIRDS])
def test_against_a_plain_walk_over_many_tasks(spark, template):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "[/ROLE] x"]), rng.choice([None, *ODD, "word " * rng.randrange(40)]))
            for c in range(12) for t in range(rng.randrange(1, 9))]
    rows += [(99, t, "user" if rng.random() < 0.9 else "assistant", f"long {t}") for t in range(400)]  # over many tasks
    rows += [(50, 3, "user", "same")] * 30 + [(51, None, "user", "no turn"), (51, 0, "assistant", "a"), (None, 0, "user", "no id"), (None, 1, "assistant", None)]
    rows += [(60, 0, "user", "x " * 300_000 + "</s>"), (60, 1, "assistant", "</s>" * 20_000)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = make(spark, rows)
        assert got(df, template) == walk(rows, template)
        formatted = format_conversations(df, template)
        assert formatted.where("conv = 99").select("task").distinct().count() > 2  # the long one was split
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table_and_turn_order(spark):
    assert got(make(spark, []), INSTRUCT) == {}
    fine = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")]
    bad = [(2, 0, "assistant", "a"), (3, 0, "user", "u"), (3, 1, "user", "u"), (3, 2, "assistant", "a"), (4, 0, "user", "u")]
    valid = {k: v[-1] for k, v in got(make(spark, fine + bad), INSTRUCT).items()}
    assert valid == {1: True, 2: False, 3: False, 4: False}
    first = format_conversations(make(spark, fine)).orderBy("task", "place").first()
    assert [tuple(s) for s in first["segments"]] == [("<conversation>\n[SYS] ", False), ("s", False), (" [/SYS]\n", False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD + list(INSTRUCT.controls) + ["\\", "<", "[", "/"]), st.text(max_size=6)), max_size=8).map("".join))
def test_escapes_are_a_round_trip(text):
    safe = INSTRUCT.escape_text(text)
    assert INSTRUCT.unescape_text(safe) == text
    assert not any(c in safe for c in INSTRUCT.controls)
    for step in INSTRUCT.steps:
        role = step.role if step.role is not None else text
        formatted = step.opening.replace("{role}", INSTRUCT.escape_text(role)) + safe + step.closing
        assert INSTRUCT.read_turn(formatted) == (role, text)


def test_templates_that_cannot_be_read_back_are_refused():
    step = Step("a", None, "a", "[X]{role}[Y]", "[Z]")
    Template("a", ("a",), ("[X]", "[Y]", "[Z]"), (step,))
    with pytest.raises(ValueError, match="no step"):
        Template("a", ("a",), ("[X]", "[Y]", "[Z]"), (Step("a", "user", "a", "[X]", "[Z]"),))
    with pytest.raises(ValueError, match="may not stand inside"):
        Template("a", ("a",), ("[X]", "[Y]", "[[Z]"), (Step("a", None, "a", "[X]{role}[Y]", "[[Z]"),))
    with pytest.raises(ValueError, match="straddle"):
        Template("a", ("a",), ("[X]", "[Y]", "[Z]"), (Step("a", None, "a", "[X]{role}[Y][", "[Z]"),))
    with pytest.raises(ValueError, match="two steps"):
        Template("a", ("a",), ("[X]", "[Y]", "[Z]"), (step, step))
