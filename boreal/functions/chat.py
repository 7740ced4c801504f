"""Chat messages: checks and renderings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boreal.functions.text import clean


def message(role: str, content: Column | str) -> Column:
    content = F.lit(content) if isinstance(content, str) else content
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def first_of(messages: Column, role: str) -> Column:
    own = F.filter(messages, lambda m: m["role"] == role)
    return F.coalesce(F.try_element_at(own, F.lit(1))["content"], F.lit(""))


def chatml(messages: Column) -> Column:
    turn = lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("\n<|im_end|>"))
    return F.array_join(F.transform(messages, turn), "\n")


def alpaca(messages: Column) -> Column:
    return F.concat(F.lit("### Instruction:\n"), first_of(messages, "user"), F.lit("\n\n### Response:\n"), first_of(messages, "assistant"))


def completion(messages: Column) -> Column:
    return first_of(messages, "assistant")


RENDERINGS = {"chatml": chatml, "alpaca": alpaca, "completion": completion}


def well_formed(messages: Column) -> Column:
    """Whether there are messages and each has a role and a content."""
    filled = lambda m: (F.coalesce(clean(m["role"]), F.lit("")) != "") & (F.coalesce(clean(m["content"]), F.lit("")) != "")
    return F.coalesce((F.size(messages) > 0) & F.forall(messages, filled), F.lit(False))


def trainer_text(text: Column, messages: Column) -> Column:
    """What a trainer reads: the rendered text, else its messages, else nothing."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.when(F.size(messages) > 0, chatml(messages)), F.lit(""))
