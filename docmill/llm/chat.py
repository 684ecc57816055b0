"""Chat formatting: a finite-state machine over roles and a declarative template.

Everything is DataFrame functions. A turn gives three segments: its opening with
the role, its text, and its end; only texts of the template's loss roles carry
loss. Control strings inside texts and roles are escaped, and unescaping gives
back exactly what was there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """How turns are marked, which roles carry loss, and which role may follow in which state.

    A turn reads open + role + role_end + text + close. control lists strings
    that texts must not contain, besides those three. moves maps a state and a
    role to the next state; a role without a move leaves the turn invalid and
    the state as it is.
    """

    open: str = "<|im_start|>"
    role_end: str = "\n"
    close: str = "<|im_end|>\n"
    control: tuple[str, ...] = ("<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    ends: tuple[str, ...] = ("answered",)
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "opened", ("start", "user"): "asked", ("opened", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
    })


CHATML = Template()
INST = Template(open="[TURN]", role_end="]", close="[/TURN]", control=("[INST]", "[/INST]", "<s>", "</s>", "<|im_start|>", "<|im_end|>"))


def _lit(text: str) -> Column:
    return F.lit(text)


def escape(text: Column, template: Template, role: bool = False) -> Column:
    """No control string is left: the escape character becomes E0, and E1 follows each control string's first character (in roles, E2 stands for the role's end)."""
    found = sorted({template.open, template.close, *template.control} - {""})
    starts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in found)
    out = F.replace(F.coalesce(text, F.lit("")), _lit(ESCAPE), _lit(ESCAPE + "0"))
    out = F.regexp_replace(out, starts, "$0\\" + ESCAPE + "1")
    return F.replace(out, _lit(template.role_end), _lit(ESCAPE + "2")) if role else out


def unescape(text: Column, template: Template) -> Column:
    out = F.replace(text, _lit(ESCAPE + "1"), F.lit(""))
    out = F.replace(out, _lit(ESCAPE + "2"), _lit(template.role_end))
    return F.replace(out, _lit(ESCAPE + "0"), _lit(ESCAPE))


def format_conversations(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss), state, valid, first_bad_turn, n_bad_turns.

    Turns are ordered by turn, then role, then text, nulls first; repeated rows
    are turns of their own. Null texts and roles count as empty. Conversations
    with turns out of order are formatted like others; valid says whether every
    turn had a move and the last state is one the template ends in, and
    first_bad_turn the place (from 0) of the first turn without a move. A null
    conv_id is a conversation. An empty table gives an empty result; other
    columns are ignored.

    A conversation's texts meet in one task, as they end in one string.
    """
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    moves = F.create_map(*[F.lit(x) for (s, r), t in template.moves.items() for x in (f"{s}>{r}", t)])

    def step(acc: Column, t: Column) -> Column:
        to = F.try_element_at(moves, F.concat(acc["state"], F.lit(">"), F.coalesce(t["role"], F.lit(""))))
        return F.struct(
            F.coalesce(to, acc["state"]).alias("state"),
            (acc["at"] + 1).alias("at"),
            F.when(to.isNull() & (acc["bad"] < 0), acc["at"]).otherwise(acc["bad"]).alias("bad"),
            (acc["n"] + to.isNull().cast("int")).alias("n"),
        )

    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad"), F.lit(0).alias("n"))

    def segments(t: Column) -> Column:
        loss = F.coalesce(t["role"].isin(*template.loss_roles), F.lit(False))
        opening = F.concat(_lit(template.open), escape(t["role"], template, role=True), _lit(template.role_end))
        parts = ((opening, F.lit(False)), (escape(t["text"], template), loss), (_lit(template.close), F.lit(False)))
        return F.array(*[F.struct(text.alias("text"), flag.alias("loss")) for text, flag in parts])

    out = turns.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"), F.aggregate("turns", begin, step).alias("end"))
    valid = (F.col("end.n") == 0) & F.col("end.state").isin(*template.ends)
    return out.select("conv_id", "segments", F.col("end.state").alias("state"), valid.alias("valid"), F.when(F.col("end.bad") >= 0, F.col("end.bad")).alias("first_bad_turn"), F.col("end.n").alias("n_bad_turns"))


def formatted(template: Template = CHATML) -> Column:
    """The formatted text of a row of format_conversations."""
    return F.array_join(F.col("segments.text"), "")


def parse(text: Column, template: Template = CHATML) -> Column:
    """Turns (role, text) of a formatted text."""
    pieces = F.split(text, re.escape(template.open))
    end = len(template.role_end)

    def turn(piece: Column) -> Column:
        at = F.locate(template.role_end, piece)
        body = F.substr(piece, at + end, F.length(piece) - at - (end - 1) - len(template.close))
        return F.struct(unescape(F.substr(piece, F.lit(1), at - 1), template).alias("role"), unescape(body, template).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def loss_text(template: Template = CHATML) -> Column:
    """All text under the loss mask of a row of format_conversations, unescaped."""
    return F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
