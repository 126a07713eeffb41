"""Operator 3, chat formatting.

A conversation's turns run through a finite-state machine over roles, which
tells whether their order is valid, and come out as text segments with a loss flag each,
both by a declarative ``Template``.  Built-in functions only.

A template's markers are the text before a role, after it and after a turn's text.  In texts and roles the first
character of each marker is escaped, and ``&``, which starts the escapes; so no marker can begin in a text, whatever it says, and
``parse`` gives back every text exactly.  Escapes consist of ``&``, letters, digits and ``;``; a template with a marker that begins with one of
these, or that is empty, is refused.

A conversation is one output row, so all its turns meet in one task, and all rows without a conv_id do; their size is the
size of that row.

Edge cases: a null text or role is an empty one; null turns come first; rows of
one turn number are ordered by role and text, and repeated rows are repeated
turns; rows with a null conv_id are one conversation; conversations of invalid order
are formatted too, with ``valid`` false; an empty table gives no rows; other
columns are not carried along.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of characters in escapes; others have their code point.
NAMES = {"&": "&amp;", "<": "&lt;", ">": "&gt;"}


@dataclass(frozen=True)
class Template:
    """Markers, loss roles and role order of a chat format; ``{role}`` stands for the role."""

    opening: str = "<turn {role}>"
    closing: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    final: tuple[str, ...] = ("answered",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "briefed", ("start", "user"): "asked", ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered", ("answered", "user"): "asked",
            ("asked", "tool"): "asked", ("answered", "tool"): "asked",
        }
    )

    def __post_init__(self):
        if self.opening.count("{role}") != 1:
            raise ValueError("the opening marker needs {role} once")
        for marker in self.markers:
            if not marker or marker[0] in "&;" or marker[0].isalnum():
                raise ValueError(f"a marker can't be empty or begin with a letter, digit, & or ;: {marker!r}")

    @property
    def markers(self) -> tuple[str, str, str]:
        """What stands before a role, after it, and after a turn's text."""
        return (*self.opening.split("{role}"), self.closing)

    @property
    def escapes(self) -> list[tuple[str, str]]:
        """Characters and their escapes, in the order in which they are applied."""
        first = sorted({m[0] for m in self.markers})
        return [(c, NAMES.get(c, f"&u{ord(c):x};")) for c in ("&", *first)]


def escaped(text: Column, template: Template) -> Column:
    for char, name in template.escapes:
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def unescaped(text: Column, template: Template) -> Column:
    for char, name in reversed(template.escapes):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def _final_state(roles: Column, t: Template) -> Column:
    moves = F.create_map(*[F.lit(x) for (state, role), to in t.moves.items() for x in (f"{state}\n{role}", to)])
    step = lambda state, role: F.coalesce(F.try_element_at(moves, F.concat(state, F.lit("\n"), role)), F.lit("invalid"))
    return F.aggregate(roles, F.lit(t.start), step)


def format_conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """``conv_id, valid, segments array<struct<text, loss>>, formatted`` for each conversation."""
    t = template or Template()
    before, after, closing = t.markers
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    segments = F.flatten(
        F.transform(
            "turns",
            lambda x: F.array(
                segment(F.concat(F.lit(before), escaped(x["role"], t), F.lit(after)), F.lit(False)),
                segment(escaped(x["text"], t), x["role"].isin(*t.loss_roles)),
                segment(F.lit(closing), F.lit(False)),
            ),
        )
    )
    state = _final_state(F.transform("turns", lambda x: x["role"]), t)
    return whole.select("conv_id", state.isin(*t.final).alias("valid"), segments.alias("segments")).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def parse(formatted: Column, template: Template | None = None) -> Column:
    """Turns ``array<struct<role, text>>`` read back from a formatted conversation."""
    t = template or Template()
    before, after, closing = (re.sub(r"([^A-Za-z0-9])", r"\\\1", m) for m in t.markers)
    # Neither a role nor a text holds the first character of a marker, so each ends where the next marker begins.
    free = "[^" + "".join(sorted({rf"\x{{{ord(m[0]):x}}}" for m in t.markers})) + "]*"
    part = lambda group: F.regexp_extract_all(formatted, F.lit(f"{before}({free}){after}({free}){closing}"), F.lit(group))
    return F.zip_with(part(1), part(2), lambda role, text: F.struct(unescaped(role, t).alias("role"), unescaped(text, t).alias("text")))


def loss_text(segments: Column, template: Template | None = None) -> Column:
    """All text under the loss mask, unescaped."""
    joined = F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), "")
    return unescaped(joined, template or Template())
