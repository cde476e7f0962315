"""Chat formatting by a finite-state machine over roles, from a declarative template.

A template names the control strings around a turn, the roles whose text carries the
training loss, and the machine: which role may follow in which state. All steps are
DataFrame functions: a conversation's turns are gathered in order, ``aggregate`` runs
the machine over their roles, and every turn yields segments of text with a loss flag.
Control strings inside texts are escaped reversibly, so that ``parsed`` reads the turns
and the loss mask back from the formatted text alone.

Defined results: null texts and null roles count as empty; turns are ordered by turn
(nulls first), ties by role, then text, and repeated rows stay repeated turns; rows
without a conversation id form one conversation. Conversations that the machine does
not accept are formatted too, with ``valid`` false and the place of the first turn that
does not fit. An empty table gives no rows; further columns are not read. A
conversation is one row of the result, so its text must fit in a row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Control strings, roles under the loss, and the machine (state -> role -> next state)."""

    open: str = "<|im_start|>"
    role_end: str = "\n"
    close: str = "<|im_end|>"
    after: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("answered", "asked")
    steps: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )


def escaped(value: Column) -> Column:
    """No ``<|`` and no bare escape character is left; ``unescaped`` gives the value back."""
    return F.replace(F.replace(value, F.lit(ESCAPE), F.lit(ESCAPE * 2)), F.lit("<|"), F.lit(f"<{ESCAPE}|"))


def escaped_role(role: Column, template: Template) -> Column:
    """A role stands before ``role_end``, so that character is escaped as well."""
    return F.replace(escaped(role), F.lit(template.role_end), F.lit(f"{ESCAPE}n"))


def unescaped(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)\\(.)", "$1")


def unescaped_role(role: Column, template: Template) -> Column:
    # an escaped escape character is set aside while the letter is read
    aside = F.replace(role, F.lit(ESCAPE * 2), F.lit(f"{ESCAPE}e"))
    return F.replace(
        F.replace(F.replace(aside, F.lit(f"{ESCAPE}n"), F.lit(template.role_end)), F.lit(f"<{ESCAPE}|"), F.lit("<|")),
        F.lit(f"{ESCAPE}e"),
        F.lit(ESCAPE),
    )


def _machine(roles: Column, template: Template) -> Column:
    """(state, failed): the state after all roles, and the place of the first that does not fit (-1: none)."""
    moves = F.create_map(
        *(F.lit(x) for state, by_role in template.steps.items() for role, to in by_role.items() for x in (f"{state}\x00{role}", to))
    )

    def step(held: Column, role: Column) -> Column:
        to = moves[F.concat(held["state"], F.lit("\x00"), role)]
        stuck = held["failed"] >= 0
        return F.struct(
            F.when(stuck | to.isNull(), held["state"]).otherwise(to).alias("state"),
            F.when(stuck, held["failed"]).when(to.isNull(), held["at"]).otherwise(F.lit(-1)).alias("failed"),
            (held["at"] + 1).alias("at"),
        )

    begin = F.struct(F.lit(template.start).alias("state"), F.lit(-1).alias("failed"), F.lit(0).alias("at"))
    return F.aggregate(roles, begin, step)


def formatted(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: Template = Template()
) -> DataFrame:
    """(conversation, segments, formatted, valid, first_bad_turn), one row per conversation.

    ``segments`` is an array of (text, loss); joined, it is ``formatted``.
    """
    empty = F.lit("")
    row = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text")
    )
    gathered = turns.groupBy(F.col(conversation).alias("id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))

    def of_turn(t: Column) -> Column:
        def segment(value: Column, loss: Column) -> Column:
            return F.struct(value.alias("text"), loss.alias("loss"))

        no = F.lit(False)
        head = F.concat(F.lit(template.open), escaped_role(t["role"], template), F.lit(template.role_end))
        return F.array(
            segment(head, no),
            segment(escaped(t["text"]), t["role"].isin(*template.loss_roles)),
            segment(F.lit(template.close + template.after), no),
        )

    made = gathered.select(
        "id",
        F.flatten(F.transform("turns", of_turn)).alias("segments"),
        _machine(F.transform("turns", lambda t: t["role"]), template).alias("machine"),
    )
    return made.select(
        F.col("id").alias(conversation),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        ((F.col("machine.failed") < 0) & F.col("machine.state").isin(*template.accepting)).alias("valid"),
        F.nullif(F.col("machine.failed"), F.lit(-1)).alias("first_bad_turn"),
    )


def parsed(formatted_text: Column, template: Template = Template()) -> Column:
    """Array of (role, text, loss) read back from formatted text."""
    parts = F.split(formatted_text, _literal(template.open))
    after_open = F.slice(parts, F.lit(2), F.size(parts))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, template.role_end, 1)
        rest = F.substring(part, F.length(role) + F.lit(len(template.role_end) + 1), F.length(part))
        body = F.substring(rest, F.lit(1), F.length(rest) - F.lit(len(template.close + template.after)))
        name = unescaped_role(role, template)
        return F.struct(name.alias("role"), unescaped(body).alias("text"), name.isin(*template.loss_roles).alias("loss"))

    return F.transform(after_open, turn)


def _literal(text: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() and c not in "_<>" else c for c in text)
