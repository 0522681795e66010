"""Problem 6: the same or almost the same records in evaluation splits and in train.

Records are brought to a canonical form (case, punctuation and white space removed) and hashed; equal hashes join
evaluation with train. Hashes alone find only equal records, so records are also joined by likeness of their word
sets, two-sided: those of one set are alike, classes of different sets meet in overlap_join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import label_key, product, record_hash, word_hashes
from millrace.llm.overlap_join import set_classes, similar_classes
from millrace.session import written

TRAIN, EVAL = 1, 2


def _matches(examples: DataFrame, splits: DataFrame, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Members (c, id, split, side, and record, the hash of the canonical record) and links (c1, c2) between classes, each class with itself where both sides have it."""
    side = F.when(label_key("split") == "train", TRAIN).when(label_key("split").isin("validation", "test"), EVAL)
    placed = splits.where("id is not null").select("id", label_key("split").alias("split"), side.alias("side")).where("side is not null").distinct()
    texts = examples.where("id is not null").select("id", word_hashes(text).alias("tokens"), record_hash(text).alias("record"))
    sided = texts.join(placed.groupBy("id").agg(F.bit_or("side").cast("int").alias("side")), "id")
    classes, members = set_classes(sided.select("id", "tokens", "side", "record"), "split-overlap", keep=("record",))
    members = written(members.join(placed, "id").select("c", "id", "split", "side", "record"), "split-overlap-members")
    equal = classes.where((F.col("side") == TRAIN + EVAL) & (F.size("tokens") > 0)).select(F.col("c").alias("c1"), F.col("c").alias("c2"))
    return members, similar_classes(classes, threshold, sides=True).select("c1", "c2").union(equal)


def split_overlap_pairs(examples: DataFrame, splits: DataFrame, text: str = "question", threshold: float = 0.8) -> DataFrame:
    """Pairs of ids (id_a < id_b), one in train, the other in validation or test, with likeness >= threshold over the words of `text`.

    Split labels count in any spelling; ids without a split, splits of unknown ids and other labels are left out;
    repeated rows count once; texts without words match nothing; an id that stands in both splits isn't paired
    with itself. Every train id of a class is paired with every evaluation id of a linked class, whatever their
    numbers; split_overlap_records says the same in one row per id and link.
    """
    members, links = _matches(examples, splits, text, threshold)
    both = links.union(links.select("c2", "c1")).distinct()
    train, held = (members.where(F.col("side") == side).select("c", "id").distinct() for side in (TRAIN, EVAL))
    pairs = product(both, train, held).where("a <> b")
    return pairs.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()


def split_overlap_records(examples: DataFrame, splits: DataFrame, text: str = "question", threshold: float = 0.8) -> DataFrame:
    """One row per evaluation id and split with an overlap: id, split, train_id (smallest train id with an equal or almost equal text), n_equal (train ids of the same canonical record), n_alike (train ids of likeness >= threshold, equal ones included)."""
    members, links = _matches(examples, splits, text, threshold)
    train = members.where(F.col("side") == TRAIN).select("c", "id", "record").distinct()
    both = links.union(links.select("c2", "c1")).distinct().toDF("ct", "c")
    alike = both.join(train.groupBy(F.col("c").alias("ct")).agg(F.count_distinct("id").alias("n"), F.min("id").alias("first")), "ct").groupBy("c").agg(F.sum("n").alias("n_alike"), F.min("first").alias("train_id"))
    equal = train.where("record is not null").groupBy("record").agg(F.count_distinct("id").alias("n_equal"))
    held = members.where(F.col("side") == EVAL).select("c", "id", "split", "record").distinct()
    return held.join(alike, "c").join(equal, "record", "left").select("id", "split", "train_id", F.coalesce("n_equal", F.lit(0)).cast("long").alias("n_equal"), "n_alike")


def split_overlap_report(examples: DataFrame, splits: DataFrame, text: str = "question", threshold: float = 0.8) -> DataFrame:
    """Per evaluation split and project: rows, ids whose canonical record stands equally in train, and ids with an equal or almost equal text in train.

    Equal are records of the same words in the same order; likeness, as in split_overlap_pairs, is over word sets.
    Counts come from records and classes, no pair of copies is multiplied out. Projects count in any spelling; none is ''.
    """
    members, links = _matches(examples, splits, text, threshold)
    train = members.where(F.col("side") == TRAIN)
    equal = train.where("record is not null").select("record").distinct().withColumn("equal", F.lit(1))
    links = written(links, "split-overlap-links")
    both = links.union(links.select("c2", "c1")).toDF("ct", "c")
    alike = both.join(train.select(F.col("c").alias("ct")).distinct(), "ct").select("c").distinct().withColumn("alike", F.lit(1))
    project = examples.where("id is not null").groupBy("id").agg(F.min(label_key("project")).alias("project"))
    held = members.where(F.col("side") == EVAL).join(project, "id").join(equal, "record", "left").join(alike, "c", "left")
    return held.groupBy("split", "project").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("equal").isNotNull()).alias("n_equal"),
        F.count_if(F.col("equal").isNotNull() | F.col("alike").isNotNull()).alias("n_overlap"),
    )
