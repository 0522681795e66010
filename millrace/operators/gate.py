"""The quality gate: one projection that gives every example its issues and metrics. No shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators.examples import keyed


@dataclass(frozen=True)
class GateConfig:
    min_question: int = 10
    max_question: int = 500
    min_answer: int = 20
    max_answer: int = 4000
    rambling_chars: int = 1200
    rambling_ratio: float = 1.5
    technical_floor: float = 0.75
    unsupported_budget: int = 0
    unsupported_budget_none: int = 3
    require_citation: bool = True
    layout_tag: str = "structured-layout"
    conflict_tag: str = "contradiction"


def facts(examples: DataFrame) -> DataFrame:
    """The lexical facts that gate and scorer share, each computed once: answer_norm, hay (normalised context),
    cites, cite_keys, unsupported, technical, technical_share, lexical_share. Expects keyed() columns and answer."""
    lowered = F.transform("cites", lambda c: F.struct(F.lower(c["source"]).alias("source"), F.lower(c["heading"]).alias("heading")))
    first = examples.withColumns({"answer_norm": X.normalised("answer"), "hay": X.normalised("context_text"), "question_norm": X.normalised("question"), "cites": X.citations("answer"), "answer_identifiers": X.identifiers("answer"), "technical": X.technical_words("answer"), "answer_words": X.content_words("answer"), "context_words": F.array_distinct(X.content_words("context_text"))})
    return first.withColumns(
        {
            "cite_keys": lowered,
            "unsupported": X.missing_identifiers(F.col("answer_identifiers"), F.concat("hay", F.lit(" "), "question_norm")),
            "technical_share": X.technical_share(F.col("technical"), F.col("hay")),
            "lexical_share": X.lexical_share(F.col("answer_words"), F.col("context_words")),
        }
    ).drop("question_norm", "answer_identifiers", "technical", "context_words")


def _issue(code: str, when: Column, detail: Column | None = None) -> Column:
    struct = F.struct(F.lit(code).alias("code"), (detail if detail is not None else F.lit("")).cast("string").alias("detail"))
    return F.when(when, F.array(struct)).otherwise(F.array().cast("array<struct<code:string,detail:string>>"))


def _each(code: str, items: Column, detail) -> Column:
    return F.transform(items, lambda i: F.struct(F.lit(code).alias("code"), detail(i).alias("detail")))


def gate(examples: DataFrame, cfg: GateConfig = GateConfig()) -> DataFrame:
    """Adds issues (array of code, detail), ok, and the metrics answer_context_ratio, citation_count,
    unsupported_identifiers, groundedness, technical_groundedness.

    Expects shaped() examples. Null answerable counts as full; null texts and arrays as empty.
    """
    empty = F.array().cast("array<string>")
    col = F.col
    df = facts(keyed(examples.withColumns({c: F.coalesce(c, empty) for c in ("tags", "must_not_include")})))
    df = df.withColumn("_unresolved", X.among(col("cite_keys"), col("context_keys"), wanted=False))
    question, answer, context = F.length("question"), F.length("answer"), F.length("context_text")
    label = F.coalesce("answerable", F.lit("full"))
    none, partial = label == "none", label == "partial"
    conflict = F.array_contains("tags", cfg.conflict_tag)
    ratio = answer / F.greatest(context, F.lit(1))
    refusing, missing = X.declines(col("answer_norm")), F.size("unsupported")
    show = lambda c: F.concat(F.lit("["), c["source"], F.lit(" - "), c["heading"], F.lit("]"))
    budget = F.when(none, cfg.unsupported_budget_none).otherwise(cfg.unsupported_budget)
    issues = F.concat(
        _issue("question_short", question < cfg.min_question, question),
        _issue("question_long", question > cfg.max_question, question),
        _issue("answer_short", answer < cfg.min_answer, answer),
        _issue("answer_long", answer > cfg.max_answer, answer),
        _issue("empty_context", X.stripped("context_text") == ""),
        _issue("rambling", ~F.array_contains("tags", cfg.layout_tag) & (answer > cfg.rambling_chars) & (ratio > cfg.rambling_ratio), F.round(ratio, 2)),
        _each("citation_heading", X.among(col("_unresolved"), col("context_sources"), part="source"), show),
        _each("citation_source", X.among(col("_unresolved"), col("context_sources"), wanted=False, part="source"), show),
        _issue("no_citation", F.lit(cfg.require_citation) & ~none & (F.size("cites") == 0)),
        _issue("unsupported_identifiers", missing > budget, F.array_join(F.slice("unsupported", 1, 6), ", ")),
        _issue("technical_floor", ~none & (col("technical_share") < cfg.technical_floor), F.round("technical_share", 2)),
        _issue("refusal_missing", none & ~refusing),
        _issue("gap_not_flagged", partial & ~conflict & ~refusing),
        _issue("conflict_not_named", conflict & ~X.names_conflict(col("answer_norm"))),
        _issue("conflict_sources", conflict & (F.size(F.array_distinct(F.transform("cites", lambda c: c["source"]))) < 2) & (F.size("cites") < 2)),
        _each("forbidden_fact", X.containing(col("must_not_include"), col("answer_norm")), lambda t: t),
        _each("gold_outside_context", X.among(col("gold_keys"), col("context_keys"), wanted=False), lambda k: F.concat(k["source"], F.lit("#"), k["heading"])),
    )
    return df.withColumns(
        {
            "issues": issues,
            "answer_context_ratio": F.round(ratio, 3),
            "citation_count": F.size("cites"),
            "unsupported_identifiers": missing,
            "groundedness": F.round("lexical_share", 3),
            "technical_groundedness": F.round("technical_share", 3),
        }
    ).withColumn("ok", F.size("issues") == 0).drop("_unresolved")


def gate_batch(rows: DataFrame, cfg: GateConfig = GateConfig(), order: str = "ord") -> DataFrame:
    """gate() over rows that may repeat ids: every row of an id after its first, in `order`, has the issue duplicate_id, whether the first passed or not."""
    nth = F.row_number().over(Window.partitionBy("id").orderBy(order))
    again = F.array(F.struct(F.lit("duplicate_id").alias("code"), F.lit("").alias("detail")))
    out = gate(rows, cfg).withColumn("_nth", nth)
    return out.withColumn("issues", F.when(F.col("_nth") > 1, F.concat("issues", again)).otherwise(F.col("issues"))).withColumn("ok", F.size("issues") == 0).drop("_nth")


def listed_issues(gated: DataFrame) -> DataFrame:
    """id, code, detail of every issue. The outer form keeps the optimiser from working the issues out a second time in a filter."""
    return gated.select("id", F.explode_outer("issues").alias("i")).where("i is not null").select("id", "i.code", "i.detail")


def issue_histogram(gated: DataFrame, top: int | None = None) -> DataFrame:
    """Issues per code, most first, ties by code; only the `top` most frequent where given."""
    counts = listed_issues(gated).groupBy("code").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "code").limit(top) if top else counts


def verdict(gated: DataFrame) -> DataFrame:
    """One row: rows, failures, whether all passed."""
    return gated.agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("failures")).withColumn("passed", F.col("failures") == 0)
