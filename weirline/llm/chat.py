"""Chat formatting: a finite-state machine over roles and a declarative template.

Each turn becomes three segments (opening control string, escaped text, closing
control string), each with a loss flag. Everything is built-in Spark expressions.

Escaping: no control string has a lead character (any control string's first)
behind its start. Inside texts and role names a backslash is doubled, and one is
put behind the lead character of each control string. An escaped text thus holds
no control string and can form none with its neighbours, so the first closing
string behind an opening one is the real one; dropping the backslash before each
character restores the text.

Defined results: null text and null role count as empty; a null ``conv_id`` is a
conversation of its own; equal ``turn`` values are ordered by role, then text;
repeated rows are turns of their own; null turns come first; an empty table gives
no rows; input columns besides the four are ignored. Unknown roles are formatted
with their name. Turn orders that the machine rejects are formatted all the same
and reported in ``valid`` and ``first_bad_turn``. One conversation has to fit one
row (2 GB), since its text is hashed as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, REJECT = "^", "!"


@dataclass(frozen=True)
class Form:
    """How a role's turns are written, and whether their text bears loss."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Forms by role, the form of unknown roles, and the machine's transitions.

    ``after[state]`` lists the roles that may follow; a state is ``START`` or the
    last role. A conversation is valid if it ends in one of ``final``."""

    forms: Mapping[str, Form] = field(
        default_factory=lambda: {
            "system": Form("[SYS]", "[/SYS]"),
            "user": Form("[INST]", "[/INST]"),
            "assistant": Form("<s>", "</s>", loss=True),
        }
    )
    named_open: str = "[ROLE]"
    named_mid: str = "[/ROLE]"
    named_close: str = "[/TURN]"
    after: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        leads = {c[:1] for c in self.controls}
        for control in self.controls:
            if len(control) < 2 or "\\" in control or leads & set(control[1:]):
                raise ValueError(f"control string {control!r} cannot be told from a text")
        if len(set(self.controls)) < len(self.controls):
            raise ValueError("control strings must differ")

    @property
    def controls(self) -> list[str]:
        each = [s for f in self.forms.values() for s in (f.open, f.close)]
        return [*each, self.named_open, self.named_mid, self.named_close]


def _one_of(strings) -> str:
    return "|".join(re.escape(s) for s in strings)


def escape(text: Column, template: Template) -> Column:
    leads = sorted({c[0] for c in template.controls})
    places = "|".join(
        f"{re.escape(lead)}(?={_one_of(c[1:] for c in template.controls if c[0] == lead)})"
        for lead in leads
    )
    return F.regexp_replace(text, rf"\\|{places}", r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _written(role: Column, text: Column, template: Template) -> Column:
    """A turn's three segments."""
    named = F.concat(
        F.lit(template.named_open), escape(role, template), F.lit(template.named_mid)
    )
    opening, closing, loss = named, F.lit(template.named_close), F.lit(False)
    for name, form in template.forms.items():
        here = role == name
        opening = F.when(here, F.lit(form.open)).otherwise(opening)
        closing = F.when(here, F.lit(form.close)).otherwise(closing)
        loss = F.when(here, F.lit(form.loss)).otherwise(loss)
    no = F.lit(False)
    return F.array(
        _segment(opening, no), _segment(escape(text, template), loss), _segment(closing, no)
    )


def _machine(roles: Column, template: Template) -> Column:
    """State after the last role and the first turn (from 0) that was refused."""
    steps = [
        pair
        for state, nexts in template.after.items()
        for role in nexts
        for pair in (F.lit(f"{state}\n{role}"), F.lit(role))
    ]
    table = F.create_map(*steps)

    def step(now, role):
        after = F.element_at(table, F.concat(now["state"], F.lit("\n"), role))
        return F.struct(
            F.coalesce(after, F.lit(REJECT)).alias("state"),
            (now["turn"] + 1).alias("turn"),
            F.when(now["bad"].isNotNull(), now["bad"])
            .when(after.isNull(), now["turn"])
            .alias("bad"),
        )

    start = F.struct(
        F.lit(START).alias("state"), F.lit(0).alias("turn"), F.lit(None).cast("int").alias("bad")
    )
    return F.aggregate(roles, start, step)


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``segments`` (text and
    loss flag; joined they are ``formatted``), ``valid`` and ``first_bad_turn``.

    Turns are written before the shuffle, which carries each of them once."""
    template = template or Template()
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    each = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"), role.alias("role"), text.alias("raw"),
            _written(role, text, template).alias("written"),
        ).alias("t"),
    )
    joined = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    segments = F.flatten(F.transform("t", lambda t: t["written"]))
    state = _machine(F.transform("t", lambda t: t["role"]), template)
    known = joined.select("conv_id", segments.alias("segments"), state.alias("state"))
    return known.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        F.col("state.state").isin(*template.final).alias("valid"),
        F.col("state.bad").alias("first_bad_turn"),
    )


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """The turns (role, text) that a formatted conversation holds, from it alone."""
    template = template or Template()
    kinds = [
        f"{re.escape(f.open)}.*?{re.escape(f.close)}" for f in template.forms.values()
    ]
    kinds.append(f"{re.escape(template.named_open)}.*?{re.escape(template.named_close)}")
    found = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(kinds)), F.lit(0))

    def read(turn):
        mid = F.instr(turn, template.named_mid)
        first = len(template.named_open) + 1
        role = F.substring(turn, F.lit(first), mid - first)
        start, closing = mid + len(template.named_mid), F.lit(len(template.named_close))
        for name, form in template.forms.items():
            here = F.startswith(turn, F.lit(form.open))
            role = F.when(here, F.lit(name)).otherwise(role)
            start = F.when(here, F.lit(len(form.open) + 1)).otherwise(start)
            closing = F.when(here, F.lit(len(form.close))).otherwise(closing)
        text = F.substring(turn, start, F.length(turn) - closing - start + 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(found, read)


def digests(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Figures read back from formatted conversations and their loss mask."""
    read = chats.withColumn("turns", read_turns(F.col("formatted"), template))
    whole = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    learned = F.transform(
        F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])
    )
    read = read.withColumns({"whole": F.array_join(whole, ""), "learned": F.array_join(learned, "")})
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("whole", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "first_bad_turn",
    )
