"""Problem 4: splits that keep related records together, by grouped iterative stratification."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import label_key
from millrace.operators.components import connected_components
from millrace.session import written

# Fixed value: the ending of a variant's id.
VARIANT = r"(?i)([-_](noise|var|aug)[0-9]+)+$"
#: Components of at least 1/UNITS of all rows are placed one by one; smaller ones are first gathered, whole, into batches per label.
UNITS = 2_000
#: Batches per label at least, so that a rare label can be shared out however many labels there are.
BATCHES = 32
#: Splits to fill; a parameter table, larger ones are refused.
MAX_SPLITS = 1000
#: Columns whose values are balanced.
LABEL = ("category", "answerable")


def original_id(c: Column | str) -> Column:
    return F.regexp_replace(c, VARIANT, "")


def related_groups(examples: DataFrame, id_col: str = "id", project: str = "project") -> DataFrame:
    """id, component of every distinct id: records are related if they have the same non-empty project, in any
    spelling, or the same original id, and so on through others.

    A record hangs on its original id, an original id on its projects. Only original ids with several projects
    link projects with each other, so components are searched among projects, not among records. Repeated rows
    count once (all their projects count), rows without id are left out.
    """
    rows = examples.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), original_id(F.col(id_col)).alias("root"), label_key(project).alias("project")).distinct()
    roots = rows.groupBy("root").agg(F.min(F.when(F.col("project") != "", F.col("project"))).alias("p"))
    links = rows.where("project <> ''").join(roots, "root").where("project <> p").select(F.col("p").alias("a"), F.col("project").alias("b")).distinct()
    joined = connected_components(links)
    named = roots.join(joined, F.col("p") == F.col("node"), "left").select("root", F.when(F.col("p").isNull(), F.concat(F.lit("id:"), "root")).otherwise(F.concat(F.lit("project:"), F.coalesce("component", "p"))).alias("component"))
    return rows.select("id", "root").distinct().join(named, "root").select("id", "component")


def stratify(units: list[tuple[str, dict[str, int]]], shares: list[tuple[str, float]]) -> dict[str, str]:
    """Split of each unit (name, rows per label). Again and again the label with the fewest rows still to place is
    taken, and its units, largest first, go to the split that lacks most rows of the label, then most rows in all,
    in relation to its share. Ties go by name and by the order of shares.
    """
    total: dict[str, int] = defaultdict(int)
    for _, labels in units:
        for label, n in labels.items():
            total[label] += n
    want = {s: {label: share * n for label, n in total.items()} for s, share in shares}
    room = {s: share * sum(total.values()) for s, share in shares}
    by_label: dict[str, list[int]] = defaultdict(list)
    for k, (_, labels) in enumerate(units):
        for label in labels:
            by_label[label].append(k)
    open_, out = dict(total), {}
    queue = [(n, label) for label, n in total.items()]
    heapq.heapify(queue)
    while queue:
        left, label = heapq.heappop(queue)
        if open_.get(label) != left:  # placed since, or counted down and queued again
            continue
        for k in sorted(by_label[label], key=lambda k: (-units[k][1][label], -sum(units[k][1].values()), units[k][0])):
            name, labels = units[k]
            if name in out:
                continue
            size = sum(labels.values())
            to = max(shares, key=lambda s: (min(0.0, room[s[0]] - size), want[s[0]][label], room[s[0]]))[0]
            out[name] = to
            room[to] -= size
            for other, n in labels.items():
                want[to][other] -= n
                if other in open_:
                    open_[other] -= n
                    if other != label:
                        heapq.heappush(queue, (open_[other], other))
        del open_[label]
    return out


def labels_of(examples: DataFrame, label: tuple[str, ...] = LABEL) -> DataFrame:
    """id, label of every distinct id: its spelling-free values of `label`, joined by '/'. Should an id's rows differ, the smallest is kept."""
    value = F.concat_ws("/", *[label_key(c) for c in label])
    return examples.where("id is not null").groupBy("id").agg(F.min(value).alias("label"))


def assign_splits(examples: DataFrame, targets: DataFrame, label: tuple[str, ...] = LABEL, units: int = UNITS) -> DataFrame:
    """id, component, split of every distinct id, with shares as in targets (split, share) and no related group parted.

    Label vectors (rows per value of `label`) are summed per component; every label counts, however rare. Components
    of fewer than 1/units of all rows are gathered whole into batches by their rarest label and a hash of their name,
    at least BATCHES to a label, so that no more than about 2 x units + BATCHES x labels vectors, which hold only the
    labels they have, are placed on the driver, however many components there are. Where a component is larger than its split's share, shares can't be met; split_report and
    label_report show what came out. Targets with null split or no positive share are left out, shares are scaled to
    1; without any target the table is empty.
    """
    wanted = targets.where("split is not null and share > 0").groupBy("split").agg(F.max("share").alias("share")).limit(MAX_SPLITS + 1).collect()
    if len(wanted) > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits")
    shares = sorted(((r.split, float(r.share)) for r in wanted), key=lambda x: (-x[1], x[0]))
    spark = examples.sparkSession
    out = "id string, component string, split string"
    if not shares:
        return spark.createDataFrame([], out)
    shares = [(s, x / sum(v for _, v in shares)) for s, x in shares]
    rows = written(related_groups(examples).join(labels_of(examples, label), "id"), "grouped-split")
    counts = rows.groupBy("label").agg(F.count("*").alias("n_label"))
    n_labels, n_rows = counts.agg(F.count("*"), F.coalesce(F.sum("n_label"), F.lit(0))).first()
    if not n_labels:
        return spark.createDataFrame([], out)
    vectors = rows.groupBy("component", "label").agg(F.count("*").alias("n")).join(counts, "label")
    size = vectors.groupBy("component").agg(F.sum("n").alias("size"), F.min(F.struct("n_label", "label")).alias("rare"))
    small = F.col("size") < F.lit(max(1.0, n_rows / units))
    batch = F.pmod(F.xxhash64("component"), F.lit(max(BATCHES, math.ceil(units / (n_labels + 1)))))
    named = size.select("component", F.when(small, F.concat(F.lit("batch:"), F.col("rare.label"), F.lit(":"), batch.cast("string"))).otherwise(F.col("component")).alias("unit"))
    per_unit = vectors.join(named, "component").groupBy("unit", "label").agg(F.sum("n").alias("n")).toPandas()
    placed = stratify([(u, dict(zip(g["label"], g["n"].tolist(), strict=True))) for u, g in per_unit.groupby("unit", sort=True)], shares)
    to = spark.createDataFrame(list(placed.items()), "unit string, split string")
    return rows.join(named.join(F.broadcast(to), "unit").select("component", "split"), "component").select("id", "component", "split")


def parted_groups(examples: DataFrame, splits: DataFrame, targets: DataFrame) -> DataFrame:
    """group_id, id, split of every example whose related group stood in more than one split before and has been put into one.

    All examples are assigned anew (assign_splits); groups whose members stand in several splits of `splits` (id,
    split) are returned with the split they now have. group_id is the smallest id of the group. Earlier labels count
    in any spelling, empty ones don't; members without an earlier split belong to the group. Without any target
    nothing is assigned and the table is empty.
    """
    now = written(assign_splits(examples, targets), "assigned-splits")
    before = splits.where("id is not null").select("id", label_key("split").alias("before")).where("before <> ''").distinct()
    parted = now.select("id", "component").join(before, "id").groupBy("component").agg(F.min("before").alias("low"), F.max("before").alias("high")).where("low <> high").select("component")
    first = now.groupBy("component").agg(F.min("id").alias("group_id"))
    return now.join(first.join(parted, "component"), "component").select("group_id", "id", "split")


def split_report(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """Per split: ids, groups, share reached, share wanted."""
    per = assigned.groupBy("split").agg(F.count("*").alias("n_ids"), F.count_distinct("component").alias("n_groups"))
    total = assigned.agg(F.count("*").alias("n"))
    return targets.groupBy("split").agg(F.max("share").alias("share_wanted")).join(per, "split", "left").join(F.broadcast(total), how="cross").select("split", F.coalesce("n_ids", F.lit(0)).alias("n_ids"), F.coalesce("n_groups", F.lit(0)).alias("n_groups"), F.round(F.coalesce("n_ids", F.lit(0)) / F.greatest("n", F.lit(1)), 4).alias("share_reached"), "share_wanted")


def label_report(assigned: DataFrame, examples: DataFrame, targets: DataFrame, label: tuple[str, ...] = LABEL) -> DataFrame:
    """Per label and split: ids of the label in the split, ids of the label, share reached, share wanted. Every label has a row for every split, also where nothing of it came."""
    per = assigned.join(labels_of(examples, label), "id").groupBy("label", "split").agg(F.count("*").alias("n_ids"))
    total = per.groupBy("label").agg(F.sum("n_ids").alias("n_label"))
    wanted = targets.where("split is not null and share > 0").groupBy("split").agg(F.max("share").alias("share_wanted"))
    found = total.crossJoin(wanted).join(per, ["label", "split"], "left").withColumn("n_ids", F.coalesce("n_ids", F.lit(0)))
    return found.select("label", "split", "n_ids", "n_label", F.round(F.col("n_ids") / F.col("n_label"), 4).alias("share_reached"), "share_wanted")
