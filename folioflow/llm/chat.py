"""Chat formatting from a declarative template, with a state machine over roles.

Edge cases: a null role or text counts as empty; turns sort by (turn, role, text), nulls first, so
ties and repeated rows have one order and are all kept; a null conversation id is one conversation;
no rows give no rows; further input columns are ignored. A conversation that breaks the turn order
is formatted all the same, with ``valid`` false and the position of its first wrong turn.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_ERROR, _SEP = "error", "\x1f"


@dataclass(frozen=True)
class ChatTemplate:
    """``open role mid text close`` per turn.

    ``transitions`` are (state, role, next state); ``protected`` are further strings that a text must
    not carry verbatim. The first character of a control string may not occur again in any of them:
    then a backslash put after each such first character breaks every control string in a text, and
    taking one backslash out again restores it.
    """

    open: str = "<|im_start|>"
    mid: str = "<|im_sep|>"
    close: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    protected: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    start: str = "start"
    transitions: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "system"),
        ("start", "user", "user"),
        ("system", "user", "user"),
        ("user", "assistant", "assistant"),
        ("assistant", "user", "user"),
    )
    accepting: tuple[str, ...] = ("assistant", "user")

    def __post_init__(self):
        firsts = {c[:1] for c in self.controls}
        if any(len(c) < 2 or "\\" in c or firsts & set(c[1:]) for c in self.controls):
            raise ValueError("control strings need two characters, no backslash, and first characters of their own")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.mid, self.close, *self.protected)


def _quote(s: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in s)


def _pattern(template: ChatTemplate, inner: str) -> str:
    """Places after the first character of a control string, backslashes between allowed."""
    parts = []
    for first in sorted({c[0] for c in template.controls}):
        rests = "|".join(_quote(c[1:]) for c in template.controls if c[0] == first)
        parts.append(rf"(?<={_quote(first)}){inner}(?=\\*(?:{rests}))")
    return "|".join(parts)


def escape(text: Column, template: ChatTemplate) -> Column:
    return F.regexp_replace(text, _pattern(template, ""), r"\\")


def unescape(text: Column, template: ChatTemplate) -> Column:
    return F.regexp_replace(text, _pattern(template, r"\\"), "")


def _check(turns: Column, template: ChatTemplate) -> Column:
    """Runs the state machine: ``(state, first_error)``."""
    table = F.create_map(*[F.lit(x) for s, r, n in template.transitions for x in (s + _SEP + r, n)])

    def step(acc, turn):
        after = F.coalesce(F.try_element_at(table, F.concat(acc["state"], F.lit(_SEP), turn["role"])), F.lit(_ERROR))
        wrong = F.when((after == _ERROR) & acc["first_error"].isNull(), acc["seen"]).otherwise(acc["first_error"])
        return F.struct(after.alias("state"), wrong.alias("first_error"), (acc["seen"] + 1).alias("seen"))

    zero = F.struct(
        F.lit(template.start).alias("state"), F.lit(None).cast("long").alias("first_error"), F.lit(0).cast("long").alias("seen")
    )
    return F.aggregate(turns, zero, step)


def format_chats(turns: DataFrame, template: ChatTemplate = ChatTemplate(), conv="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """One row per conversation: ``formatted``, its ``segments`` with loss flags, ``valid``, ``first_error``.

    A conversation is one training text, so its turns have to meet in one row.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def piece(value, loss):
        return F.struct(value.alias("text"), loss.alias("loss"))

    def segments(t):
        no = F.lit(False)
        head = F.concat(F.lit(template.open), escape(t["role"], template), F.lit(template.mid))
        body = piece(escape(t["text"], template), t["role"].isin(list(template.loss_roles)))
        return F.array(piece(head, no), body, piece(F.lit(template.close), no))

    made = chats.withColumns(
        {"segments": F.flatten(F.transform("turns", segments)), "_run": _check(F.col("turns"), template)}
    )
    return made.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        (F.col("_run.state").isin(list(template.accepting))).alias("valid"),
        F.col("_run.first_error").alias("first_error"),
    )


def read_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns ``(role, text)`` of a formatted conversation."""
    closed = F.split(formatted, _quote(template.close), -1)
    pieces = F.slice(closed, 1, F.greatest(F.size(closed) - 1, F.lit(0)))

    def parts(piece):
        halves = F.split(piece, _quote(template.mid), 2)
        role = F.substring(F.get(halves, F.lit(0)), len(template.open) + 1, 1 << 30)
        return F.struct(unescape(role, template).alias("role"), unescape(F.get(halves, F.lit(1)), template).alias("text"))

    return F.transform(pieces, parts)


def read_loss(segments: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss mask, unescaped segment by segment."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")


def chat_digests(chats: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Counts and digests read back from the output of ``format_chats``."""
    read = chats.withColumns({"_turns": read_turns(F.col("formatted"), template), "_loss": read_loss(F.col("segments"), template)})
    told = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "first_error",
    )
