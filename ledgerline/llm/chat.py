"""Chat formatting: a finite-state machine over roles, written down as a declarative template.

A :class:`Template` lists steps (state, role) -> (next state, opening text, closing text, loss flag) and what to do
where a role is out of order. Every turn becomes three segments (opening, text, closing) with a loss flag each; the
concatenated segments are the formatted conversation, and :func:`read_turn` reads turns back from it. Control strings
inside texts are escaped reversibly, so markers are unambiguous.

Turns are dealt to tasks by ranges of (conversation, turn), so that a conversation may be as long as it likes. A task
runs the machine over its own turns once per state that its first conversation could be in at that point; the few
(task, conversation) pairs at the borders are then composed in order, which gives every task the state it starts in.
Formatting itself is a projection.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, ready, stored


@dataclass(frozen=True)
class Step:
    """What a turn of ``role`` does in ``state``; ``role`` None takes every role without a step of its own, and its
    ``opening`` holds ``{role}`` where the (escaped) role goes."""

    state: str
    role: str | None
    to: str
    opening: str
    closing: str
    loss: bool = False
    in_order: bool = True


@dataclass(frozen=True)
class Template:
    """A chat format. ``controls`` are the strings that texts may not hold as they are; ``escape`` is put after the
    first character of each (and of each escaped one), which is undone by taking one out."""

    start: str
    accept: tuple[str, ...]
    controls: tuple[str, ...]
    steps: tuple[Step, ...]
    escape: str = "\\"
    states: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        names = dict.fromkeys([self.start, *(x for s in self.steps for x in (s.state, s.to))])
        object.__setattr__(self, "states", tuple(names))
        table = {(s.state, s.role) for s in self.steps}
        if len(table) != len(self.steps):
            raise ValueError("two steps for one state and role")
        if missing := [s for s in self.states if (s, None) not in table]:
            raise ValueError(f"no step for other roles in {missing}")
        if len(self.escape) != 1 or any(len(c) < 2 or self.escape in c for c in self.controls):
            raise ValueError("controls have two or more characters, none of them the escape character")
        firsts = {c[0] for c in self.controls}
        if any(x in firsts for c in self.controls for x in c[1:]):
            raise ValueError("the first character of a control string may not stand inside one")
        for s in self.steps:
            closing = next((c for c in self.controls if c in s.closing), None)
            if closing is None or not any(c in s.opening for c in self.controls):
                raise ValueError(f"openings and closings need a control string: {s}")
            for c in self.controls:  # no marker may come about where fixed text and a turn's text meet
                if any(s.opening.endswith(c[:k]) or s.closing.startswith(c[k:]) for k in range(1, len(c))):
                    raise ValueError(f"{c!r} could straddle the border of a text in {s}")
        openings: dict[str, tuple] = {}
        for s in self.steps:
            if openings.setdefault(s.opening, (s.role, s.closing)) != (s.role, s.closing):
                raise ValueError(f"one opening for two roles: {s.opening!r}")

    def pattern(self, escapes: str) -> str:
        """A pattern with two groups: a control string's first character and the rest, ``escapes`` between them."""
        e = re.escape(self.escape)
        parts = {}
        for c in self.controls:
            parts.setdefault(c[0], []).append(re.escape(c[1:]))
        either = "|".join(f"(?<={re.escape(a)}){e}{escapes}(?:{'|'.join(rest)})" for a, rest in parts.items())
        return f"([{''.join(re.escape(a) for a in parts)}])({either})"

    def escaped(self, text: Column) -> Column:
        # the replacement text of Java's regular expressions: a backslash stands for itself when doubled
        e = "\\" + self.escape if self.escape in "\\$" else self.escape
        return F.regexp_replace(text, F.lit(self.pattern("*")), F.lit("$1" + e + "$2"))

    def escape_text(self, text: str) -> str:
        return re.sub(self.pattern("*"), lambda m: m[1] + self.escape + m[2], text)

    def unescape_text(self, text: str) -> str:
        return re.sub(self.pattern("+"), lambda m: m[1] + m[2][1:], text)

    def read_turn(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        for opening in sorted({s.opening for s in self.steps}, key=len, reverse=True):
            step = next(s for s in self.steps if s.opening == opening)
            if step.role is not None:
                if formatted.startswith(opening):
                    return step.role, self.unescape_text(self._body(formatted, len(opening), step.closing))
                continue
            before, after = opening.split("{role}")
            if formatted.startswith(before) and (at := formatted.find(after, len(before))) >= 0:
                role = self.unescape_text(formatted[len(before) : at])
                return role, self.unescape_text(self._body(formatted, at + len(after), step.closing))
        raise ValueError(f"not a turn: {formatted[:80]!r}")

    @staticmethod
    def _body(formatted: str, start: int, closing: str) -> str:
        end = formatted.find(closing, start)
        if end < 0 or end + len(closing) != len(formatted):
            raise ValueError(f"a turn that does not close: {formatted[-80:]!r}")
        return formatted[start:end]


def _instruct() -> Template:
    """Instructions in brackets, answers between the sentence marks; out of order roles go on from where they lead."""
    kinds = {"system": ("briefed", "[SYS] ", " [/SYS]\n", False), "user": ("asked", "[INST] ", " [/INST]", False), "assistant": ("answered", "<s> ", " </s>\n", True)}
    order = {"start": ("system", "user"), "briefed": ("user",), "asked": ("assistant",), "answered": ("user",)}
    steps = []
    for state, allowed in order.items():
        begin = "<conversation>\n" if state == "start" else ""
        steps += [Step(state, role, to, begin + opening, closing, loss, role in allowed) for role, (to, opening, closing, loss) in kinds.items()]
        steps.append(Step(state, None, "answered" if state == "start" else state, begin + "[ROLE] {role} [/ROLE] ", " [END]\n", in_order=False))
    controls = ("<conversation>", "<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[END]")
    return Template("start", ("answered",), controls, tuple(steps))


INSTRUCT = _instruct()


def _machine(template: Template):
    """Per turn the states it may stand in and lead to, by the state at the task's begin: one pass over sorted rows."""
    number = {s: i for i, s in enumerate(template.states)}
    move = {(number[s.state], s.role): number[s.to] for s in template.steps}
    n, start = len(number), number[template.start]
    named = {r for _, r in move if r is not None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, conv, now = True, object(), []
        for batch in batches:
            convs, roles = batch.column("conv").to_pylist(), batch.column("role").to_pylist()
            before, after = [], []
            for c, role in zip(convs, roles):
                if first or c != conv:
                    # only a task's first conversation may have begun in another task
                    now, conv, first = (list(range(n)), c, False) if first else ([start] * n, c, False)
                before.append(now)
                key = role if role in named else None
                now = [move[(s, key)] for s in now]
                after.append(now)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, kind), pa.array(after, kind)], names=[*batch.schema.names, "before", "after"])

    return run


def format_conversations(rows: DataFrame, template: Template = INSTRUCT, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: (conv, task, place, state, in_order, accepted, segments), ``segments`` an array of (text,
    loss). The rows of a conversation in order of (task, place), their segments joined, are its formatted text;
    ``accepted`` tells whether the conversation could end after the turn.

    Turns go by ``turn``, a null first; ties by role, then the text's md5; equal rows are turns of their own. A null text is
    empty, a null role is an unnamed role, which like every role without a step is formatted by the template's
    step for other roles. Rows without an id are one conversation. Out of order turns are kept, formatted and
    flagged. Extra columns are not read; an empty table gives an empty one.
    """
    ready(rows.sparkSession)
    slim = rows.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("at"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keys = ["conv", "at", "role", "digest", "nth"]
    # equal rows still have different keys, so that no range grows with a repeated turn
    slim = slim.withColumns({"digest": F.md5(F.col("text").cast("binary")), "nth": F.monotonically_increasing_id()})
    ranged = slim.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("task", F.spark_partition_id())
    ranged = ranged.withColumn("place", F.monotonically_increasing_id() - F.shiftleft(F.col("task").cast("long"), 33)).select("conv", "task", "place", "role", "text")
    schema = f"conv {dict(slim.dtypes)['conv']}, task int, place long, role string, text string, before array<int>, after array<int>"
    turns = stored(ranged.mapInArrow(lean(_machine(template)), schema), "turns")

    # a conversation that several tasks hold: what each task does to the state, composed in order
    ends = turns.groupBy("conv", "task").agg(F.max_by("after", "place").alias("after"))
    border = ends.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("task", "after"))).alias("tasks")).where(F.size("tasks") > 1)
    begin = F.lit(template.states.index(template.start))
    reached = F.aggregate(F.col("tasks.after"), F.array(begin), lambda done, f: F.concat(done, F.array(F.element_at(f, F.element_at(done, -1) + 1))))
    entry = border.select(F.col("conv").alias("_c"), F.explode(F.arrays_zip(F.col("tasks.task").alias("task"), reached.alias("entry"))).alias("e"))
    # a task holds a run of conversations, so at most two of them go on elsewhere: two rows a task
    entry = entry.where("e.task is not null").select("_c", F.col("e.task").alias("_t"), F.col("e.entry").alias("entry"))
    met = turns.join(F.broadcast(stored(entry, "entries")), F.col("conv").eqNullSafe(F.col("_c")) & (F.col("task") == F.col("_t")), "left")
    met = met.withColumn("_s", F.element_at("before", F.coalesce("entry", begin) + 1))

    names = F.array(*[F.lit(s) for s in template.states])
    kind = "map<string,struct<to:string,opening:string,closing:string,loss:boolean,in_order:boolean>>"
    entries = [F.struct(F.lit(s.to).alias("to"), F.lit(s.opening).alias("opening"), F.lit(s.closing).alias("closing"), F.lit(s.loss).alias("loss"), F.lit(s.in_order).alias("in_order")) for s in template.steps]
    # no role is empty in a key: the step for other roles has the state alone
    table = F.create_map(*[x for s, e in zip(template.steps, entries) for x in (F.lit(s.state if s.role is None else f"{s.state}\0{s.role}"), e)]).cast(kind)
    state = F.element_at(names, F.col("_s") + 1)
    met = met.withColumn("state", state).withColumn("step", F.coalesce(table[F.concat("state", F.lit("\0"), "role")], table[F.col("state")]))
    role = template.escaped(F.coalesce("role", F.lit("")))
    opening = F.replace(F.col("step.opening"), F.lit("{role}"), role)

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    segments = F.array(segment(opening, F.lit(False)), segment(template.escaped(F.col("text")), F.col("step.loss")), segment(F.col("step.closing"), F.lit(False)))
    return met.select("conv", "task", "place", "state", F.col("step.in_order").alias("in_order"), F.col("step.to").isin(*template.accept).alias("accepted"), segments.alias("segments"))


def _digests(template: Template):
    """Reads turns back from formatted text and digests them, conversation by conversation, in a stream: a
    conversation's hash is sequential by nature, but no more than a batch of its turns is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, open_ = None, False
        n = chars = loss_chars = 0
        turns = loss = None
        valid = accepted = True

        def row() -> tuple:
            return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid and accepted

        kind = None
        for batch in batches:
            kind = kind or pa.schema([("conv_id", batch.schema.field("conv").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])
            done = []
            for c, segments, in_order, ok in zip(*(batch.column(k).to_pylist() for k in ("conv", "segments", "in_order", "accepted"))):
                if not open_ or c != conv:
                    if open_:
                        done.append(row())
                    conv, open_, valid = c, True, True
                    n = chars = loss_chars = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                formatted = "".join(s["text"] for s in segments)
                role, text = template.read_turn(formatted)
                turns.update(f"{role}\n{text}\n".encode())
                masked = template.unescape_text("".join(s["text"] for s in segments if s["loss"]))
                loss.update(masked.encode())
                n, chars, loss_chars = n + 1, chars + len(formatted), loss_chars + len(masked)
                valid, accepted = valid and in_order, ok
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), kind)], schema=kind)
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row(), kind)], schema=kind)

    return run


def digest_conversations(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid) read back from the segments of
    :func:`format_conversations`; ``valid``: every turn in order, and the last in an accepting state."""
    placed = formatted.select("conv", "task", "place", "segments", "in_order", "accepted").repartition("conv").sortWithinPartitions("conv", "task", "place")
    schema = f"conv_id {dict(formatted.dtypes)['conv']}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    return placed.mapInArrow(lean(_digests(template)), schema)
