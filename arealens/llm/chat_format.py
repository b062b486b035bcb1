"""Chat formatting: a state machine over roles checks the turn order, a template emits text segments.

Everything is DataFrame operations. Control strings inside texts are escaped, so that the formatted
text can be read back turn by turn.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Template(NamedTuple):
    """A turn is ``start role separator text end``; loss is kept on the texts of ``loss_roles``."""

    start: str = "<|im_start|>"
    separator: str = "\n"
    end: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)


CHAT = Template()

#: (state, role) -> state; any other pair leads to "error", which is never left.
TRANSITIONS = {
    ("start", "system"): "system",
    ("start", "user"): "user",
    ("system", "user"): "user",
    ("user", "assistant"): "assistant",
    ("assistant", "user"): "user",
    ("assistant", "tool"): "tool",
    ("tool", "assistant"): "assistant",
}
FINAL = ("assistant",)


def escape(text: Column) -> Column:
    """A backslash before every backslash and between the two characters that open a control string."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def next_state(state: Column, role: Column) -> Column:
    out = F.lit("error")
    for (before, kind), after in TRANSITIONS.items():
        out = F.when((state == before) & (role == kind), F.lit(after)).otherwise(out)
    return out


def format_conversations(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): conv_id, n_turns, state, valid, segments, formatted.

    ``segments`` are (text, loss) in order, ``formatted`` is their concatenation. Turns are ordered by
    turn, then role, then text, so ties and repeated rows have a fixed place and each is a turn. Null
    roles and texts are empty. ``state`` is the machine's last state, ``valid`` whether it may end there;
    invalid conversations are formatted all the same. Rows without conv_id form one conversation; further
    columns are ignored; an empty table gives no rows. A conversation is one output value and so has
    to fit one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    whole = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(template.start), escape_role(t["role"]), F.lit(template.separator))
        parts = ((head, F.lit(False)), (escape(t["text"]), t["role"].isin(*template.loss_roles)), (F.lit(template.end), F.lit(False)))
        return F.array(*[F.struct(p.alias("text"), loss.alias("loss")) for p, loss in parts])

    state = F.aggregate("turns", F.lit("start"), lambda s, t: next_state(s, t["role"]))
    out = whole.select("conv_id", F.size("turns").cast("long").alias("n_turns"), state.alias("state"), F.flatten(F.transform("turns", segments)).alias("segments"))
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return out.select("conv_id", "n_turns", "state", F.col("state").isin(*FINAL).alias("valid"), "segments", formatted.alias("formatted"))


def parse_formatted(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    parts = F.slice(F.split(formatted, _literal(template.start)), 2, F.greatest(F.size(F.split(formatted, _literal(template.start))) - 1, F.lit(0)))
    role = r"(?s)^((?:[^\\\n]++|\\.)*+)" + _literal(template.separator)

    def turn(part: Column) -> Column:
        body = F.regexp_replace(part, role, "")
        name = F.regexp_extract(part, role, 1)
        return F.struct(unescape(name).alias("role"), unescape(F.substring(body, F.lit(1), F.length(body) - len(template.end))).alias("text"))

    return F.transform(parts, turn)


def _literal(text: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|" else c for c in text)


def loss_text(segments: Column) -> Column:
    """The unescaped text under the loss mask, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digest_conversations(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, state, valid; read back from the formatted output."""
    made = format_conversations(rows, template)
    turns = parse_formatted(F.col("formatted"), template)
    read = made.select("conv_id", "state", "valid", "formatted", turns.alias("turns"), loss_text(F.col("segments")).alias("loss"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "state",
        "valid",
    )
