"""Column helpers the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members of one class that meet in one task when a class is expanded to pairs; larger classes meet block by block.
BLOCK = 1000


def label_key(c: Column | str) -> Column:
    """Spellings that differ in letter case, blanks, '-' or '_' only become one value; null is the empty value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[\s_\-]+", "")


def word_list(*texts: str) -> Column:
    """Words of the texts as they stand: maximal runs of letters and digits, lower-cased. Null text is empty text."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(t), F.lit("")) for t in texts]))
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), 0)


def record_hash(*texts: str) -> Column:
    """64-bit hash of the canonical record: the words of the texts in their order, repeats included. Null without words."""
    words = word_list(*texts)
    return F.when(F.size(words) > 0, F.xxhash64(F.array_join(words, " ")))


def word_hashes(*texts: str) -> Column:
    """Sorted distinct 64-bit hashes of the words of the texts: maximal runs of letters and digits, lower-cased. Null text is empty text."""
    words = F.array_distinct(word_list(*texts))
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def block_pairs(rows: DataFrame, member: str, size: str, block: int) -> DataFrame:
    """rows with columns own, low, high: every row once per pair of blocks it takes part in.

    A class of `size` rows falls into ceil(size / block) blocks by the hash of `member`; two rows of a class meet in
    exactly one pair (low, high) of blocks if met_once() holds, so no task sees more than about two blocks at once.
    """
    parts = F.ceil(F.col(size) / F.lit(block)).cast("int")
    each = rows.withColumns({"own": F.pmod(F.xxhash64(member), parts).cast("int"), "_other": F.explode(F.sequence(F.lit(0), parts - 1))})
    return each.withColumns({"low": F.least("own", "_other"), "high": F.greatest("own", "_other")}).drop("_other")


def met_once(a: str, b: str) -> Column:
    """Of two aliased sides of block_pairs joined on class, low and high: whether this is the block pair of the two rows."""
    return (F.col(f"{a}.own") != F.col(f"{b}.own")) | (F.col(f"{a}.low") == F.col(f"{a}.high"))


def representatives(members: DataFrame) -> DataFrame:
    """c, rep (smallest id) and m (ids) of every class of members (c, id)."""
    return members.groupBy("c").agg(F.min("id").alias("rep"), F.count("*").alias("m"))


def product(links: DataFrame, left: DataFrame, right: DataFrame, block: int = BLOCK) -> DataFrame:
    """a, b: every member of c1 in left (c, id) with every member of c2 in right (c, id), for every link (c1, c2). The right members of a large class are spread over blocks, so its pairs come from many tasks."""
    parts = right.groupBy("c").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("parts")).withColumnRenamed("c", "c2")
    cut = links.select("c1", "c2").join(parts, "c2").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = right.withColumnRenamed("c", "c2").join(parts, "c2").select("c2", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), F.col("id").alias("b"))
    return cut.select("c1", "c2", "part").join(left.select(F.col("c").alias("c1"), F.col("id").alias("a")), "c1").join(spread, ["c2", "part"]).select("a", "b")


def expand_members(links: DataFrame, members: DataFrame, inner: bool = True, block: int = BLOCK) -> DataFrame:
    """All pairs of ids (id_a < id_b, each once) that links between classes, and equality inside a class, stand for.

    links: columns c1, c2 of different classes, each link once. members: columns c, id. The result is as large as
    its definition: k ids of one class are k(k-1)/2 pairs. It has the same form for every class size; where classes
    are too large for it, representatives() with the links say the same in one row per id and link. inner=False
    leaves equality inside classes out.
    """
    pairs = product(links, members, members, block)
    if inner:
        many = members.join(representatives(members).where("m > 1").select("c", "m"), "c")
        cut = block_pairs(many, "id", "m", block).select("c", "id", "own", "low", "high")
        met = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in ("c", "low", "high")]
        own = cut.alias("x").join(cut.alias("y"), met[0] & met[1] & met[2] & (F.col("x.id") < F.col("y.id")) & met_once("x", "y"))
        pairs = pairs.union(own.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
    return pairs.where("a <> b").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
