"""Chat formatting from a declarative template (DataFrame functions only).

A template names, per role, the mark that opens and closes a turn and whether
its text counts for the loss; a transition table is the finite-state machine
that says which role may follow which. Marks begin with ``<`` or ``[``. Inside
texts every ``<``, ``[`` and ``\\`` is followed by an inserted ``\\``, so no
text can form a mark and the text comes back by dropping the inserted ones.
Roles without marks get a generic mark that holds the role in hexadecimal.

``valid`` is true when the turns follow the machine to a final state; turns of
invalid conversations are formatted all the same. Null text and null role count
as empty. Turns are ordered by turn (null first), then role, then text, so ties
and repeated rows have one result; a null ``conv_id`` is one conversation;
other columns are ignored. One conversation is one output value, so its turns
meet in one row: that is the result's size, whatever the plan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    #: role -> (opening mark, closing mark, text counts for the loss)
    turns: dict[str, tuple[str, str, bool]] = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>", False),
        "user": ("[INST]", "[/INST]", False),
        "assistant": ("<s>", "</s>", True)})
    #: state -> roles that may come next; the state after a turn is its role
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)
    other: tuple[str, str] = ("<role ", "</role>")


TEMPLATE = Template()


def _pick(key: Column, table: dict[str, str], default: Column) -> Column:
    out = default
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", r"$1")


def format_conversations(df: DataFrame, template: Template = TEMPLATE, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, valid, segments
    array<struct<text, loss>>, formatted``; ``formatted`` is the segments'
    texts in a row."""
    t = template
    role = F.coalesce(F.col(f"`{role_col}`"), F.lit(""))
    hexed = F.hex(role.cast("binary"))
    turn = F.struct(
        F.col(f"`{turn_col}`").alias("turn"), role.alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        _pick(role, {k: v[0] for k, v in t.turns.items()}, F.concat(F.lit(t.other[0]), hexed, F.lit(">"))).alias("open"),
        escape(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("body"),
        _pick(role, {k: v[1] for k, v in t.turns.items()}, F.lit(t.other[1])).alias("close"),
        role.isin([k for k, v in t.turns.items() if v[2]]).alias("loss"))
    conv = (df.select(F.col(f"`{conv_col}`").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")))
    steps = {f"{a}>{b}": b for a, nexts in t.follows.items() for b in nexts}

    def step(state: Column, x: Column) -> Column:
        return _pick(F.concat(state, F.lit(">"), x["role"]), steps, F.lit("error"))

    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return (conv.select(
        "conv_id",
        F.aggregate("turns", F.lit("start"), step).isin(list(t.final)).alias("valid"),
        F.flatten(F.transform("turns", lambda x: F.array(
            part(x["open"], F.lit(False)), part(x["body"], x["loss"]), part(x["close"], F.lit(False)))))
        .alias("segments"))
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def parse_formatted(formatted: Column, template: Template = TEMPLATE) -> tuple[Column, Column]:
    """(roles, texts) of a formatted string, read back by its marks."""
    t = template
    opens = [re.escape(v[0]) for v in t.turns.values()] + [re.escape(t.other[0]) + "[0-9A-F]*>"]
    closes = [re.escape(v[1]) for v in t.turns.values()] + [re.escape(t.other[1])]
    pattern = F.lit(f"(?s)({'|'.join(opens)})(.*?)(?:{'|'.join(closes)})")
    marks = F.regexp_extract_all(formatted, pattern, F.lit(1))
    texts = F.regexp_extract_all(formatted, pattern, F.lit(2))
    start = len(t.other[0]) + 1

    def role(mark: Column) -> Column:
        digits = F.substring(mark, start, F.length(mark) - start)
        other = F.when(mark.startswith(t.other[0]), F.decode(F.unhex(digits), "UTF-8")).otherwise("")
        return _pick(mark, {v[0]: k for k, v in t.turns.items()}, other)

    return F.transform(marks, role), F.transform(texts, unescape)


def conversation_digests(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Digest columns read back from the output of ``format_conversations``."""
    roles, texts = parse_formatted(F.col("formatted"), template)
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return (formatted.withColumn("roles", roles).withColumn("texts", texts).withColumn("loss_text", loss)
            .select("conv_id", F.size("roles").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.zip_with("roles", "texts", lambda r, x: F.concat(
                        r, F.lit("\n"), x, F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
                    F.length("loss_text").cast("long").alias("loss_chars"),
                    F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"), "valid"))
