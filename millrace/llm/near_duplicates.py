"""Problem 5: near-duplicate records with small edits, found by T-occurrence search (overlap_join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import expand_members, representatives, word_hashes
from millrace.llm.overlap_join import set_classes, similar_classes
from millrace.operators.components import connected_components
from millrace.session import written


def _classes(rows: DataFrame, texts: tuple[str, ...], id_col: str) -> tuple[DataFrame, DataFrame]:
    sets = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), word_hashes(*texts).alias("tokens"), F.lit(3).alias("side"))
    return set_classes(sets, "near-duplicates")


def near_duplicate_pairs(rows: DataFrame, texts: tuple[str, ...] = ("question", "answer"), id_col: str = "id", threshold: float = 0.8) -> DataFrame:
    """All pairs of ids (id_a < id_b) whose word sets over `texts` have likeness >= threshold.

    Null text is empty text; records without any word are alike only in having nothing to compare and form no
    pair. Repeated rows of an id count once, rows without id are left out, extra columns are ignored, an empty
    table gives no rows. A class of k equal word sets is expanded to its k(k-1)/2 pairs, whatever k is;
    near_duplicate_links and near_duplicate_groups hold the same in rows that grow with the ids only.
    """
    classes, members = _classes(rows, texts, id_col)
    members = written(members.join(classes.where(F.size("tokens") > 0).select("c"), "c", "left_semi").select("c", "id"), "near-duplicate-members")
    return expand_members(similar_classes(classes, threshold), members)


def near_duplicate_links(rows: DataFrame, texts: tuple[str, ...] = ("question", "answer"), id_col: str = "id", threshold: float = 0.8) -> DataFrame:
    """Pairs of class representatives (id_a < id_b) with their likeness: a class is all ids of one word set, its representative the smallest. near_duplicate_groups has the class of every id. Edge cases as in near_duplicate_pairs."""
    classes, members = _classes(rows, texts, id_col)
    first = written(representatives(members).select("c", "rep"), "near-duplicate-representatives")
    found = similar_classes(classes, threshold).join(first.select(F.col("c").alias("c1"), F.col("rep").alias("a")), "c1").join(first.select(F.col("c").alias("c2"), F.col("rep").alias("b")), "c2")
    return found.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), F.round("likeness", 6).alias("likeness"))


def near_duplicate_groups(rows: DataFrame, texts: tuple[str, ...] = ("question", "answer"), id_col: str = "id", threshold: float = 0.8) -> DataFrame:
    """One row per id: class_id (smallest id with the very same word set), group_id (smallest id linked to it,
    directly or through others), class_rows (ids of the class), n_links (other word sets it is linked to). Edge
    cases as in near_duplicate_pairs; an id without words is its own class and group.
    """
    classes, members = _classes(rows, texts, id_col)
    members = written(members, "near-duplicate-members")
    links = written(similar_classes(classes, threshold).select("c1", "c2"), "near-duplicate-links")
    degree = links.select(F.col("c1").alias("c")).union(links.select(F.col("c2").alias("c"))).groupBy("c").agg(F.count("*").alias("n_links"))
    label = connected_components(links.select(F.col("c1").alias("a"), F.col("c2").alias("b"))).select(F.col("node").alias("c"), "component")
    known = classes.select("c", (F.size("tokens") == 0).alias("blank")).join(representatives(members), "c").join(degree, "c", "left").join(label, "c", "left").withColumn("component", F.coalesce("component", "c"))
    first = known.groupBy("component").agg(F.min("rep").alias("group_id"))
    per_class = known.join(first, "component").select("c", "blank", "rep", "group_id", "m", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    own = lambda c: F.when(F.col("blank"), F.col("id")).otherwise(F.col(c))
    return members.join(per_class, "c").select("id", own("rep").alias("class_id"), own("group_id").alias("group_id"), F.when(F.col("blank"), F.lit(1)).otherwise(F.col("m")).cast("long").alias("class_rows"), "n_links")
