"""Chat formatting: a finite-state machine over roles and a declarative template.

Every turn becomes three segments (header, body, close) with a loss flag each; their
concatenation is the training text. Control strings inside roles and texts are escaped
reversibly, so :func:`turns_back` reads the turns from the formatted text alone.

Defined results: null texts and roles count as empty; turns are ordered by (turn, role, text),
null turns first; equal rows are turns of their own; rows with a null conv_id form one
conversation; an empty table gives an empty result; columns other than conv_id, turn, role and
text are ignored. A conversation is one training sample, so its turns meet in one row, however
many conversations there are.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "<start>"


@dataclass(frozen=True)
class Template:
    """Turn markers, the roles under the loss, and the machine over roles.

    ``transitions`` maps a state (the role of the turn before, or ``START``) to the roles that
    may come next; ``final`` lists the roles that may end a conversation.
    """

    open: str = "### "
    mid: str = ": "
    close: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",),
        "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        """Refuse markers that could not be told apart from escaped text."""
        for mark in (self.open, self.mid, self.close):
            if len(mark) < 2 or "\\" in mark:
                raise ValueError(f"marker {mark!r} needs two characters and no backslash")
            if any(mark[:k] == mark[-k:] for k in range(1, len(mark))):
                raise ValueError(f"marker {mark!r} overlaps itself")
        for a, b in product((self.open, self.mid, self.close), repeat=2):
            if a != b and a in b:
                raise ValueError(f"marker {b!r} contains {a!r}")


def escape(column: Column, marks: tuple[str, ...]) -> Column:
    """Double the backslashes, then break every marker by a backslash before its last character."""
    column = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    for mark in marks:
        column = F.replace(column, F.lit(mark), F.lit(mark[:-1] + "\\" + mark[-1]))
    return column


def unescape(column: Column) -> Column:
    return F.regexp_replace(column, r"(?s)\\(.)", "$1")


def _machine(turns: Column, template: Template) -> Column:
    """Fold the roles: the state, the turns seen and the first turn out of order."""
    allowed = [f"{state}\n{role}" for state, roles in template.transitions.items() for role in roles]
    start = F.struct(F.lit(START).alias("state"), F.lit(0).alias("seen"),
                     F.lit(None).cast("int").alias("bad"))

    def step(acc: Column, turn: Column) -> Column:
        fits = F.concat_ws("\n", acc["state"], turn["role"]).isin(allowed)
        bad = F.when(acc["bad"].isNull() & ~fits, acc["seen"]).otherwise(acc["bad"])
        return F.struct(turn["role"].alias("state"), (acc["seen"] + 1).alias("seen"),
                        bad.alias("bad"))

    return F.aggregate(turns, start, step)


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss), formatted, valid, first_bad_turn.

    ``first_bad_turn`` is the place (from 0) of the first turn that the machine refuses; it is
    null where the order holds but the conversation ends in a role that is not final. Invalid
    conversations are formatted all the same and flagged.
    """
    turns = rows.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def segments(turn: Column) -> Column:
        header = F.concat(
            F.lit(template.open),
            escape(turn["role"], (template.open, template.mid, template.close)),
            F.lit(template.mid))
        parts = ((header, F.lit(False)),
                 (escape(turn["text"], (template.open, template.close)),
                  turn["role"].isin(list(template.loss_roles))),
                 (F.lit(template.close), F.lit(False)))
        return F.array(*(F.struct(t.alias("text"), f.alias("loss")) for t, f in parts))

    folded = gathered.select(
        "conv_id", F.flatten(F.transform("turns", segments)).alias("segments"),
        _machine(F.col("turns"), template).alias("end"))
    return folded.select(
        "conv_id", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("end.bad").isNull() & F.col("end.state").isin(list(template.final))).alias("valid"),
        F.col("end.bad").alias("first_bad_turn"))


def turns_back(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) that a formatted text holds."""
    pieces = F.split(formatted, f"\\Q{template.close}\\E", -1)

    def turn(piece: Column) -> Column:
        parts = F.split(F.substr(piece, F.lit(len(template.open) + 1)), f"\\Q{template.mid}\\E", 2)
        return F.struct(unescape(parts[0]).alias("role"), unescape(parts[1]).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")
