"""Shape of an example and the columns that rules and metrics derive from it, each worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as X


def value(c: Column | str) -> Column:
    """An enumerated value in its one spelling: lower case, '-' and blanks as '_', none around it. Null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)^[\s_-]+|[\s_-]+$", ""), r"(?U)[\s_-]+", "_")


def project_name(c: Column | str) -> Column:
    """A project in its one spelling: lower case, '_' and blanks as '-'; null is empty."""
    return F.coalesce(F.translate(value(c), "_", "-"), F.lit(""))


def shaped(examples: DataFrame) -> DataFrame:
    """One row per id with question and answer stripped, enumerated values and project in one spelling, source_count
    and contains_code filled in. Of repeated rows the latest counts; rows without id are left out."""
    last = Window.partitionBy("id").orderBy(F.col("created_at").desc_nulls_last(), F.xxhash64("question", "answer"))
    one = examples.where("id is not null").withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    return derived(one)


def derived(examples: DataFrame) -> DataFrame:
    """Fills what an example derives from itself: stripped texts, one spelling, source_count, contains_code."""
    return examples.withColumns(
        {
            "question": X.stripped("question"),
            "answer": X.stripped("answer"),
            "category": value("category"),
            "answerable": value("answerable"),
            "difficulty": value("difficulty"),
            "project": project_name("project"),
            "context": F.coalesce("context", F.array().cast(examples.schema["context"].dataType)),
            "source_count": F.coalesce("source_count", F.size(F.coalesce("context", F.array().cast(examples.schema["context"].dataType)))),
            "contains_code": F.coalesce("contains_code", F.contains(F.coalesce("answer", F.lit("")), F.lit("`"))),
        }
    )


def citation(source: Column, heading: Column) -> Column:
    return F.concat(F.lit("["), source, F.lit(" — "), heading, F.lit("]"))


def _chunk_key(c: Column) -> Column:
    return F.struct(F.lower(X.stripped(c["source"])).alias("source"), F.lower(X.stripped(c["heading"])).alias("heading"))


def _split_reference(s: Column) -> Column:
    return F.struct(F.lower(X.stripped(F.substring_index(s, "#", 1))).alias("source"), F.lower(X.stripped(F.when(F.contains(s, F.lit("#")), F.substring(s, F.instr(s, "#") + 1, 1 << 30)).otherwise(""))).alias("heading"))


def keyed(examples: DataFrame) -> DataFrame:
    """Adds context_text, context_keys, context_sources, gold_keys (the named sources, else every chunk not marked
    irrelevant) and distractor_keys. Keys are lower-cased (source, heading) pairs, distinct."""
    empty = F.array().cast("array<string>")
    keys = lambda chunks: F.array_distinct(F.transform(chunks, _chunk_key))
    block = lambda c: F.concat(citation(_or(c["source"]), _or(c["heading"])), F.lit("\n"), _or(c["heading"]), F.lit("\n"), _or(c["content"]))
    named = F.coalesce("relevant_sources", empty)
    return examples.withColumns(
        {
            "context_text": F.array_join(F.transform("context", block), "\n\n"),
            "context_keys": keys(F.col("context")),
            "gold_keys": F.when(F.size(named) > 0, F.array_distinct(F.transform(named, _split_reference))).otherwise(keys(F.filter("context", lambda c: ~c["relevant"].eqNullSafe(False)))),
            "distractor_keys": keys(F.filter("context", lambda c: c["relevant"].eqNullSafe(False))),
        }
    ).withColumn("context_sources", F.array_distinct(F.transform("context_keys", lambda k: k["source"])))


def _or(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))
