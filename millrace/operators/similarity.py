"""Exact set-similarity anti-join: rows too like a reference row are dropped, by prefix filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.session import written


def token_sets(rows: DataFrame, text: str, id_col: str = "id") -> DataFrame:
    """id, tokens: distinct content words of the text, hashed to 64 bits."""
    return rows.select(F.col(id_col).alias("id"), F.array_distinct(F.transform(X.content_words(text), lambda w: F.xxhash64(w))).alias("tokens"))


def _prefixes(sets: DataFrame, counts: DataFrame, threshold: float) -> DataFrame:
    """The first size - ceil(threshold * size) + 1 tokens of every set, rarest first by the exact counts of all sets."""
    n = F.size("tokens")
    need = n - F.ceil(F.lit(threshold) * n - F.lit(1e-9)).cast("int") + 1
    each = sets.where(n > 0).select("id", n.alias("n"), need.alias("need"), F.explode("tokens").alias("token")).join(counts, "token")
    ordered = each.groupBy("id", "n", "need").agg(F.array_sort(F.collect_list(F.struct("times", "token"))).alias("t"))
    return ordered.select("id", "n", F.posexplode(F.slice("t", F.lit(1), F.col("need"))).alias("place", "x")).select("id", "n", "place", F.col("x.token").alias("token"))


def similar_to(rows: DataFrame, reference: DataFrame, threshold: float = 0.9) -> DataFrame:
    """id, other, similarity: all pairs of a row and a reference row whose sets have Jaccard >= threshold.

    Both sides: id, tokens. Sets meet on the rare tokens of their prefixes; sizes and places prune the meeting, and
    the exact value is computed for the pairs that are left. Empty sets match nothing.
    """
    counts = written(rows.select(F.explode("tokens").alias("token")).union(reference.select(F.explode("tokens"))).groupBy("token").agg(F.count("*").alias("times")), "token-counts")
    x, y = _prefixes(rows, counts, threshold).alias("x"), _prefixes(reference, counts, threshold).alias("y")
    col = F.col
    room = F.least(col("x.n") - col("x.place"), col("y.n") - col("y.place"))
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (col("x.n") + col("y.n")) - F.lit(1e-9))
    met = x.join(y, (col("x.token") == col("y.token")) & (col("x.n") >= threshold * col("y.n") - 1e-9) & (col("y.n") >= threshold * col("x.n") - 1e-9) & (room >= need))
    pairs = met.select(col("x.id").alias("id"), col("y.id").alias("other")).distinct()
    both = pairs.join(rows.select("id", col("tokens").alias("a")), "id").join(reference.select(col("id").alias("other"), col("tokens").alias("b")), "other")
    return both.select("id", "other", X.jaccard(col("a"), col("b")).alias("similarity")).where(col("similarity") >= threshold - 1e-9)


def drop_near_duplicates(rows: DataFrame, reference: DataFrame, text: str = "question", threshold: float = 0.9) -> DataFrame:
    """rows without those whose text has a near-duplicate in reference. Equal sets are compared once, by their fingerprint."""
    ours, theirs = (written(token_sets(df, text).withColumn("f", F.xxhash64(F.array_sort("tokens"))), "token-sets") for df in (rows, reference))
    classes = lambda df: df.groupBy("f").agg(F.first("tokens").alias("tokens")).select(F.col("f").alias("id"), "tokens")
    like = similar_to(classes(ours), classes(theirs), threshold).select(F.col("id").alias("f")).distinct()
    return rows.join(ours.join(like, "f", "left_semi").select("id"), "id", "left_anti")
