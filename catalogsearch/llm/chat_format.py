"""Operator 13: chat formatting by a declarative template, in DataFrame functions alone.

A `Template` states the marks around a turn, which roles are learned from, and the moves of a finite-state machine over
roles. A conversation's rows are put in the order of their turns; the machine runs over the roles and names the first turn
that it does not allow, and every turn gives three text segments, each with a loss flag: the opening mark with the role,
the text, and the closing mark. Only texts of learned roles are under the loss mask. `formatted` is all segments joined.

Inside roles and texts, a backslash is put between `<` and `|` (after any that stand there already), so that no mark can
begin there; taking one away gives the original back. Line feeds and backslashes of a role are written as `\\l` and `\\b`
before that, as a line feed ends the role. `read_turns` splits the formatted text at the marks and undoes both.

Defined results: a null role or text is empty; turns with the same number stand in the order of role and text, as
escaped, null turns first; equal rows are all kept; a null conv_id is a conversation of its own; an order that the machine does not allow is
formatted all the same and has its turn in `bad_turn`; an empty table gives no rows; other columns are ignored. One
conversation is one row of the result, formatted text included.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, REJECTED = "start", "rejected"


@dataclass(frozen=True)
class Template:
    """Marks around a turn; both begin with `<|` and the role ends at a line feed. `moves` are (state, role) pairs that are
    allowed; a role's state has its name."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    moves: tuple[tuple[str, str], ...] = ((START, "system"), (START, "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user"))

    def __post_init__(self):
        if not (self.opening.startswith("<|") and self.closing.startswith("<|")):
            raise ValueError("marks begin with <|")
        if {s for s, _ in self.moves} & {REJECTED} or any(" " in s for s, _ in self.moves):
            raise ValueError("states are names without a space")


CHAT = Template()


def escape(text: Column) -> Column:
    """The text without any `<|`."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """The role without any `<|` or line feed."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\l")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\l"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _checked(turns: Column, template: Template) -> Column:
    """The machine's last state and the number, from 0, of the first turn that it does not allow (else null)."""
    moves = F.create_map(*[F.lit(x) for state, role in template.moves for x in (f"{state} {role}", role)])

    def step(so_far: Column, turn: Column) -> Column:
        to = F.try_element_at(moves, F.concat(so_far["state"], F.lit(" "), turn["role"]))
        bad = F.coalesce(so_far["bad_turn"], F.when(to.isNull(), so_far["seen"]))
        return F.struct(F.coalesce(to, F.lit(REJECTED)).alias("state"), (so_far["seen"] + 1).alias("seen"), bad.alias("bad_turn"))

    zero = F.struct(F.lit(START).alias("state"), F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("bad_turn"))
    return F.aggregate(turns, zero, step)


def format_conversations(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """`conv_id, segments, formatted, state, bad_turn` for each conversation of `conversations(conv_id, turn, role, text)`."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    turn = F.struct("turn", escape_role(F.col("role")).alias("label"), escape(F.col("text")).alias("body"), "role")
    turns = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def of_turn(t: Column) -> Column:
        plain, learned = F.lit(False), t["role"].isin(*template.learned)
        parts = [(F.concat(F.lit(template.opening), t["label"], F.lit("\n")), plain), (t["body"], learned), (F.lit(template.closing), plain)]
        return F.array(*[F.struct(part.alias("text"), loss.alias("loss")) for part, loss in parts])

    made = turns.select("conv_id", F.flatten(F.transform("turns", of_turn)).alias("segments"), _checked(F.col("turns"), template).alias("checked"))
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return made.select("conv_id", "segments", joined.alias("formatted"), "checked.state", "checked.bad_turn")


def read_turns(formatted: Column, template: Template = CHAT) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    parts = F.split(formatted, re.escape(template.opening))
    end = len(template.closing)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - F.lit(1 + end))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def chat_digests(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """Figures of each formatted conversation, read back from its text and its segments."""
    read = formatted.select("*", read_turns(F.col("formatted"), template).alias("turns"), loss_text(F.col("segments")).alias("learned"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "state", "bad_turn",
    )
