"""Rendering of context, messages and batch instructions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators.examples import citation

SYSTEM = "Answer from the documentation blocks only. Say what is missing where they fall short. Cite sources as [file — heading]. Answer in the language of the question."


def render_context(context: Column) -> Column:
    """A block per chunk: its citation token, then its content."""
    block = lambda c: F.concat(citation(F.coalesce(c["source"], F.lit("")), F.coalesce(c["heading"], F.lit(""))), F.lit("\n"), X.stripped(c["content"]))
    return F.array_join(F.transform(context, block), "\n\n")


def user_message(question: Column, context: Column) -> Column:
    return F.concat(F.lit("## Project documentation\n\n"), render_context(context), F.lit("\n\n## Question\n\n"), X.stripped(question))


def messages(question: Column, context: Column, answer: Column | None = None, system: str = SYSTEM) -> Column:
    """system, user and, where there is an answer, assistant."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    start = F.array(turn("system", F.lit(system)), turn("user", user_message(question, context)))
    return start if answer is None else F.when(answer.isNull(), start).otherwise(F.concat(start, F.array(turn("assistant", X.stripped(answer)))))


def batch_instruction(slots: Column, distractors: Column, conflict: Column) -> Column:
    """What a generation call has to produce: one numbered line per slot (answerable, category), and warnings."""
    lines = F.array_join(F.transform(slots, lambda s, i: F.concat((i + 1).cast("string"), F.lit(". answerable="), s["answerable"], F.lit(", category="), s["category"])), "\n")
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Write "), F.size(slots).cast("string"), F.lit(" question and answer pairs from the blocks below, in this mix:")),
        lines,
        F.when(distractors, F.lit("Some blocks have nothing to do with the rest: neither use nor cite them.")),
        F.when(conflict, F.lit("Two blocks disagree: one pair must name the conflict and cite both.")),
    )


def within_length(rows: DataFrame, limit: int, length: str = "n_tokens") -> DataFrame:
    """Rows of at most `limit` tokens: longer ones are left out, not cut."""
    return rows.where(F.col(length) <= limit)
