"""Tallies that describe a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_card(examples: DataFrame) -> DataFrame:
    """facet, value, n in one pass: all rows, and rows per category, answerable, project, origin and split where there is one. Null shows as 'None', a missing origin as 'unknown'."""
    facets = [c for c in ("category", "answerable", "project", "origin", "split") if c in examples.columns]
    named = examples.select(*[F.coalesce(c, F.lit("unknown" if c == "origin" else "None")).alias(c) for c in facets])
    sets = named.groupingSets([[], *[[c] for c in facets]], *facets).agg(F.count("*").alias("n"), *[F.grouping(c).alias(f"g_{c}") for c in facets])
    facet = F.coalesce(*[F.when(F.col(f"g_{c}") == 0, c) for c in facets], F.lit("all"))
    return sets.select(facet.alias("facet"), F.coalesce(*facets, F.lit("")).alias("value"), "n")


def split_card(placed: DataFrame) -> DataFrame:
    """split, facet, value, n in one pass: rows per split, and per split and category, answerable, project, origin, teacher where there is one."""
    facets = [c for c in ("category", "answerable", "project", "origin", "teacher") if c in placed.columns]
    named = placed.select(F.coalesce("split", F.lit("None")).alias("split"), *[F.coalesce(c, F.lit("unknown" if c in ("origin", "teacher") else "None")).alias(c) for c in facets])
    sets = named.groupingSets([["split"], *[["split", c] for c in facets]], "split", *facets).agg(F.count("*").alias("n"), *[F.grouping(c).alias(f"g_{c}") for c in facets])
    facet = F.coalesce(*[F.when(F.col(f"g_{c}") == 0, c) for c in facets], F.lit("all"))
    return sets.select("split", facet.alias("facet"), F.coalesce(*facets, F.lit("")).alias("value"), "n")


def dataset_means(examples: DataFrame) -> DataFrame:
    """One row: rows, mean sources, mean answer length, rows with a chunk marked irrelevant, rows with code."""
    return examples.agg(
        F.count("*").alias("n"),
        F.round(F.avg("source_count"), 2).alias("mean_sources"),
        F.round(F.avg(F.length(F.coalesce("answer", F.lit("")))), 2).alias("mean_answer_chars"),
        F.count_if(F.exists("context", lambda c: c["relevant"].eqNullSafe(False))).alias("with_distractors"),
        F.count_if("contains_code").alias("with_code"),
    )


def token_stats(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """Longest, mean (one decimal) and sum of a length column."""
    return lengths.agg(F.max(column).alias("longest"), F.round(F.avg(column), 1).alias("mean"), F.sum(column).alias("total"))


def review_status(decisions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates approved, rejected and still open; decisions: id, approved."""
    joined = candidates.select("id").join(decisions.groupBy("id").agg(F.bool_or("approved").alias("approved")), "id", "left")
    return joined.agg(F.count_if(F.col("approved")).alias("approved"), F.count_if(~F.col("approved")).alias("rejected"), F.count_if(F.col("approved").isNull()).alias("open"))
