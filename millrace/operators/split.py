"""Splits by whole groups and families, without leakage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import hash_order
from millrace.operators.dedup import exact_dedup
from millrace.operators.similarity import drop_near_duplicates
from millrace.session import written


@dataclass(frozen=True)
class SplitConfig:
    train: float = 0.8
    validation: float = 0.1
    test: float = 0.1
    group_by: str = "project"
    near_duplicate: float = 0.9
    seed: int = 42


def family(c: Column | str = "id") -> Column:
    """An id without the ending of a variant made of noise, var or aug and a number."""
    return F.regexp_replace(c, r"-(noise|var|aug)[0-9]+$", "")


def group_key(mode: str) -> Column:
    """Group of an example: its project, its first source, or one group for all; 'unknown' without either."""
    first = F.try_element_at("context", F.lit(1))["source"]
    given = {"project": F.coalesce(F.nullif("project", F.lit("")), first), "document": first, "none": F.lit("all")}[mode]
    return F.coalesce(given, F.lit("unknown"))


def prefix_until(sizes: DataFrame, n: str, target: float, order: list[str]) -> DataFrame:
    """Rows of a table of sizes, in order, as long as what came before stays under the target. Ranges of the order are summed up and accumulated, then rows inside each range, so no task holds all rows."""
    ranged = written(sizes.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "size-ranges")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_p").agg(F.sum(n).alias("_m")).withColumn("_base", F.coalesce(F.sum("_m").over(earlier.orderBy("_p")), F.lit(0))).where(F.col("_base") < target).select("_p", "_base")
    before = F.col("_base") + F.coalesce(F.sum(n).over(earlier.partitionBy("_p").orderBy(*order)), F.lit(0))
    return ranged.join(F.broadcast(sums), "_p").withColumn("_before", before).where(F.col("_before") < target).drop("_before", "_base", "_p")


def hold_out_groups(sizes: DataFrame, target: float) -> DataFrame:
    """Names of the smallest groups (name, n) that together reach the target; none if that were all of them."""
    taken = prefix_until(sizes, "n", target, ["n", "name"]).select("name")
    counts = taken.agg(F.count("*").alias("k")).crossJoin(sizes.agg(F.count("*").alias("every")))
    return taken.join(F.broadcast(counts.where("k < every")), how="cross").select("name")


def cut_families(families: DataFrame, target: float, seed: int, steps: int = 4096) -> DataFrame:
    """Families (family, n), in hash order, as long as what came before stays under the target.

    The order is total, but no task holds all families: they fall into `steps` even ranges of their hash, the small
    table of range sums is accumulated, and a window runs inside each range.
    """
    ordered = families.withColumn("h", hash_order(seed, "family")).withColumn("step", (F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / float(1 << 32) * steps).cast("int"))
    sums = ordered.groupBy("step").agg(F.sum("n").alias("m")).withColumn("base", F.coalesce(F.sum("m").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("base") < target).select("step", "base")
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("step").orderBy("h", "family").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ordered.join(F.broadcast(sums), "step").withColumn("before", F.col("base") + inside).where(F.col("before") < target).select("family")


def split_examples(examples: DataFrame, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """The kept rows with `split` and a shuffled `position` key.

    Exact duplicates go first; then the smallest groups that reach the test share are held out whole (with one
    group only, or group_by='none', test is cut by families instead); validation is cut from the rest by families;
    last, validation and test rows with a near-duplicate question in train are dropped.
    """
    rows = written(exact_dedup(examples).withColumns({"_group": group_key(cfg.group_by), "_family": family()}), "split-rows")
    n = rows.count()
    sizes = rows.groupBy(F.col("_group").alias("name")).agg(F.count("*").alias("n"))
    tests = written(hold_out_groups(sizes, cfg.test * n), "held-out")
    by_family = cfg.group_by == "none" or tests.isEmpty()
    share = cfg.validation / max(cfg.train + cfg.validation, 1e-9)
    if by_family:
        families = rows.groupBy(F.col("_family").alias("family")).agg(F.count("*").alias("n"))
        tested = cut_families(families, cfg.test * n, cfg.seed + 1).select(F.col("family").alias("_family"), F.lit("test").alias("split"))
        placed = rows.join(tested, "_family", "left")
    else:
        placed = rows.join(tests.select(F.col("name").alias("_group"), F.lit("test").alias("split")), "_group", "left")
    placed = written(placed, "split-tested")
    rest = placed.where("split is null")
    m = rest.count()
    families = rest.groupBy(F.col("_family").alias("family")).agg(F.count("*").alias("n"))
    held = cut_families(families, share * m, cfg.seed).select(F.col("family").alias("_family"), F.lit("validation").alias("_v"))
    out = written(placed.join(held, "_family", "left").withColumn("split", F.coalesce("split", "_v", F.lit("train"))).drop("_v"), "split-placed")
    train = out.where("split = 'train'")
    safe = drop_near_duplicates(out.where("split <> 'train'"), train, "question", cfg.near_duplicate)
    return train.unionByName(safe).withColumn("position", hash_order(cfg.seed, "split", "id")).drop("_group", "_family")


def split_shares(placed: DataFrame) -> DataFrame:
    """split, n, share of all rows."""
    n = placed.groupBy("split").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 4))


def leaked_groups(placed: DataFrame, group: str = "project") -> DataFrame:
    """Non-empty groups that stand both in train and in test."""
    has = lambda s: placed.where(F.col("split") == s).where(F.coalesce(group, F.lit("")) != "").select(group)
    return has("train").intersect(has("test"))
