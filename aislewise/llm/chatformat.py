"""Chat formatting by a finite-state machine over roles, in DataFrame functions only.

A declarative template gives the allowed roles after each state and, for each role, the marks
before and after a turn's text and whether the text is under the loss mask. The machine is
folded over the turns of a conversation; its state after a turn is the turn's role. Every turn
emits three segments (mark, text, mark) with their loss flags.

Control strings inside texts are escaped by a backslash after their first character, one more
than they already have, so escaping is reversible and no mark can be forged. Roles that the
template does not know are written into the mark.

Defined cases: a null text or role is empty; turns go by turn number (null first), then role,
then text; repeated rows are turns of their own; a null conversation id is a conversation;
a conversation with turns out of order is formatted too and reported as not valid, with the
place of the first wrong turn; an empty table gives no rows. A conversation is one value of
the result, so it is gathered into one row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``turns`` per role, ``follows`` the roles allowed after each state ("" at the start)."""

    turns: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("<<SYS>>", "<</SYS>>"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    })
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    #: Marks of a turn of any other role: role start, role end, turn end.
    other: tuple[str, str, str] = ("<<ROLE>>", "<</ROLE>>", "<</TURN>>")

    def control(self) -> list[str]:
        return [m for t in self.turns.values() for m in (t.before, t.after)] + list(self.other)

    def inside(self, marks: str, more: str = "") -> str:
        """Pattern of ``marks`` between the first character and the rest of a control string,
        with ``more`` before the rest."""
        return "|".join(rf"(?<=\Q{m[0]}\E){marks}(?={more}\Q{m[1:]}\E)" for m in self.control())

    def turn_pattern(self) -> str:
        """One formatted turn; escaped texts hold no control string, so it ends at the first."""
        known = [rf"\Q{t.before}\E.*?\Q{t.after}\E" for t in self.turns.values()]
        role, end, after = self.other
        return "(?s)" + "|".join([*known, rf"\Q{role}\E.*?\Q{end}\E.*?\Q{after}\E"])


def escape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, F.lit(template.inside(r"\\*")), F.lit(r"\\$0"))


def unescape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, F.lit(template.inside(r"\\", r"\\*")), F.lit(""))


def first_wrong_turn(roles: Column, template: Template) -> Column:
    """Place (from 1) of the first turn that the machine does not accept, null without one."""
    moves = F.create_map(*[F.lit(x) for pair in (
        (f"{state}>{role}", True) for state, after in template.follows.items() for role in after) for x in pair])
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("wrong"))

    def step(machine: Column, role: Column) -> Column:
        at = machine["at"] + 1
        accepted = moves[F.concat(machine["state"], F.lit(">"), role)].isNotNull()
        return F.struct(role.alias("state"), at.alias("at"),
                        F.coalesce(machine["wrong"], F.when(~accepted, at)).alias("wrong"))

    return F.aggregate(roles, start, step, lambda machine: machine["wrong"])


def segments_of(role: Column, text: Column, template: Template) -> Column:
    """The three (text, loss) segments of a turn."""

    def parts(before: Column, after: Column, loss: bool) -> Column:
        return F.array(*[
            F.struct(t.alias("text"), F.lit(flag).alias("loss"))
            for t, flag in ((before, False), (escape(text, template), loss), (after, False))])

    start, end, after = template.other
    other = parts(F.concat(F.lit(start), escape(role, template), F.lit(end)), F.lit(after), False)
    chosen = None
    for name, turn in template.turns.items():
        own = parts(F.lit(turn.before), F.lit(turn.after), turn.loss)
        chosen = F.when(role == name, own) if chosen is None else chosen.when(role == name, own)
    return chosen.otherwise(other)


def format_conversations(turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, segments, valid, wrong_turn): ``segments`` are (text, loss), to be joined as they are."""
    template = template or Template()
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("segments", segments_of(F.col("role"), F.col("text"), template))
    gathered = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "segments"))).alias("turns"))
    wrong = first_wrong_turn(F.transform("turns", lambda t: t["role"]), template)
    return gathered.select(
        F.col("conv").alias(conv_col), F.flatten(F.transform("turns", lambda t: t["segments"])).alias("segments"),
        wrong.isNull().alias("valid"), wrong.alias("wrong_turn"))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column, template: Template) -> Column:
    """All text under the loss mask, unescaped."""
    marked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: unescape(s["text"], template)), "")


def read_turns(formatted: Column, template: Template) -> Column:
    """The turns (role, text) of a formatted conversation."""
    start, end, after = template.other

    def parse(turn: Column) -> Column:
        def between(before: str, last: str) -> Column:
            body = F.substring(turn, F.lit(len(before) + 1), F.length(turn) - (len(before) + len(last)))
            return unescape(body, template)

        role = F.substring_index(F.substring(turn, F.lit(len(start) + 1), F.length(turn)), end, 1)
        inner = F.substring(turn, F.lit(len(start) + len(end) + 1) + F.length(role),
                            F.length(turn) - F.length(role) - (len(start) + len(end) + len(after)))
        chosen = None
        for name, t in template.turns.items():
            own = F.struct(F.lit(name).alias("role"), between(t.before, t.after).alias("text"))
            hit = turn.startswith(t.before)
            chosen = F.when(hit, own) if chosen is None else chosen.when(hit, own)
        return chosen.otherwise(F.struct(unescape(role, template).alias("role"), unescape(inner, template).alias("text")))

    return F.transform(F.regexp_extract_all(formatted, F.lit(template.turn_pattern()), F.lit(0)), parse)
