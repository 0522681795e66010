"""Problem 1: a sample that matches target category proportions, by raking and weighted exponential keys."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import label_key
from millrace.session import written

ANY = "any"
#: Rows of the table of targets; a parameter table, larger ones are refused. It bounds the cells that are raked.
MAX_TARGETS = 10_000
#: Steps in which keys are counted before the cut-off key is ranked exactly within one step.
STEPS = 1 << 16
ROUNDS, CLOSE = 500, 1e-9


def _key(value: str | None) -> str:
    return "".join(x for x in (value or "").lower() if not x.isspace() and x not in "-_")


def rake(available: dict[tuple[str, str], int], margins: list[list[tuple[str, str, float]]]) -> dict[tuple[str, str], float]:
    """Shares of the sample per cell (category, answerable), by iterative proportional fitting.

    Starts from the pool's own shares and scales the cells of each target to its share, margin after margin, until
    nothing moves. What a margin's shares leave of 1 stays with the cells that none of its targets covers; if that is
    nothing, those cells are emptied. Targets without any row can't be fitted; their share stays unfilled.
    """
    total = sum(available.values())
    if not total:
        return {}
    cells = sorted(available)
    p = np.array([available[c] for c in cells], dtype=float) / total
    masks = []
    for margin in margins:
        rows = [(np.array([(cat in (ANY, c)) and (ans in (ANY, a)) for c, a in cells]), share) for cat, ans, share in margin]
        covered = np.any([m for m, _ in rows], axis=0)
        masks.append((rows, ~covered, max(0.0, 1 - sum(s for _, s in rows))))
    for _ in range(ROUNDS):
        before = p.copy()
        for rows, rest, left in masks:
            for mask, share in [*rows, (rest, left)]:
                have = p[mask].sum()
                if have > 0:
                    p[mask] *= share / have
        if np.abs(p - before).max() < CLOSE:
            break
    return dict(zip(cells, p.tolist(), strict=True))


def repaired(drawn: dict[tuple[str, str], int], available: dict[tuple[str, str], int], targets: list[tuple[str, str, float]], size: int) -> dict[tuple[str, str], int]:
    """Rows per cell after the repair of a drawn sample.

    targets: category, answerable, rows wanted. Every target that got fewer rows than wanted is topped up from the rows
    left in its cells, small targets first; then rows beyond `size` are given back by cells all of whose targets
    have more than they want. A target stays short only where nothing is left in its cells.
    """
    out = {c: drawn.get(c, 0) for c in sorted(available)}
    of = {k: [c for c in out if _covers(t, c)] for k, t in enumerate(targets)}
    need = [math.ceil(t[2] - 1e-9) for t in targets]
    held = lambda k: sum(out[c] for c in of[k])
    for k in sorted(of, key=lambda k: (need[k], targets[k][:2])):
        for c, more in _shared(need[k] - held(k), {c: available[c] - out[c] for c in of[k]}).items():
            out[c] += more
    for c in sorted(out, key=lambda c: (any(c in own for own in of.values()), c)):
        spare = [held(k) - need[k] for k in of if c in of[k]]
        over = min([sum(out.values()) - size, out[c], *spare])
        out[c] -= max(0, over)
    return out


def _covers(target: tuple, cell: tuple[str, str]) -> bool:
    return target[0] in (ANY, cell[0]) and target[1] in (ANY, cell[1])


def _shared(n: int, room: dict[tuple[str, str], int]) -> dict[tuple[str, str], int]:
    """n rows divided among cells in proportion to their room, no cell more than it has; the rounding goes to the largest remainders."""
    total = sum(room.values())
    n = min(n, total)
    if n <= 0:
        return {}
    out = {c: n * r // total for c, r in room.items()}
    for c in sorted(room, key=lambda c: (-(n * room[c] % total), c))[: n - sum(out.values())]:
        out[c] += 1
    return out


def _plans(targets: DataFrame) -> dict[str, list]:
    rows = targets.where("plan is not null").select("plan", "category", "answerable", F.coalesce("sample_share", F.lit(0.0)).alias("sample_share"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("min_rows", F.lit(0)).alias("min_rows")).distinct().limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: tuple(map(str, r))):
        out[r.plan].append(r)
    return dict(out)


def _pool(examples: DataFrame, plans: dict[str, list]) -> DataFrame:
    """id, category, answerable of every distinct id, with values that no target names put together under ''."""
    cats = sorted({_key(r.category) for rows in plans.values() for r in rows} - {ANY})
    answers = sorted({_key(r.answerable) for rows in plans.values() for r in rows} - {ANY})
    one = examples.where("id is not null").groupBy("id").agg(F.min(F.struct(label_key("category").alias("category"), label_key("answerable").alias("answerable"))).alias("v")).select("id", "v.*")
    named = lambda c, known: F.when(F.col(c).isin(known), F.col(c)).otherwise("").alias(c) if known else F.lit("").alias(c)
    return one.select("id", named("category", cats), named("answerable", answers))


@dataclass(frozen=True)
class Plan:
    """One sample to draw: its targets (category, answerable, share, rows wanted, and the row they come from), size, and weight per cell."""

    name: str
    targets: list[tuple]
    size: int
    weights: dict[tuple[str, str], float]


def _raked(plans: dict[str, list], have: dict[tuple[str, str], int], joint: bool) -> list[Plan]:
    """A plan's targets are margins by what they name: categories, answerabilities, or both. All margins of a sample are raked together; joint=True makes one sample of all plans."""
    total, out = sum(have.values()), []
    for name, rows in ({"joint": [r for own in plans.values() for r in own]} if joint and plans else plans).items():
        share = max(r.sample_share for r in rows)
        margins, targets = defaultdict(list), []
        for r in rows:
            c, a = _key(r.category), _key(r.answerable)
            margins[r.plan, c == ANY, a == ANY].append((c, a, float(r.target_share)))
            wanted = max(float(r.min_rows), (share if joint else r.sample_share) * r.target_share * total)
            targets.append((c, a, wanted, r))
        shares = rake(have, list(margins.values()))
        weights = {c: shares[c] * total / n for c, n in have.items() if shares.get(c, 0) > 0}
        out.append(Plan(name, targets, round(share * total), weights))
    return out


CELL = ["plan", "category", "answerable"]


def _table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, "plan string, category string, answerable string, " + columns))


def _keyed(pool: DataFrame, plans: list[Plan], seed: int) -> DataFrame:
    """Pool rows per plan with key = -ln(u) / weight: the smallest keys are a weighted sample without replacement. Rows of weight 0 have no key; they are drawn only in the repair, by u."""
    have = {c for p in plans for c in p.weights}
    cells = _table(pool.sparkSession, [(p.name, *c, p.weights[c]) for p in plans for c in sorted(have & p.weights.keys())], "weight double")
    names = F.explode(F.array(*[F.lit(p.name) for p in plans]))
    unit = (F.xxhash64(F.lit(seed), "plan", "id").bitwiseAND((1 << 52) - 1) + 1) / float(1 << 52)
    each = pool.withColumn("plan", names).withColumn("u", unit).join(cells, CELL, "left")
    return each.select(*CELL, "id", "u", (-F.log("u") / F.col("weight")).alias("key"))


def _first(keyed: DataFrame, group: list[str], value: str, quota: DataFrame) -> DataFrame:
    """The `quota` rows of each group with the smallest value (0..1). quota: the columns of group, quota.

    Rows are counted in STEPS even steps of the value; rows of steps below the one that holds the last row are taken
    as they are, only the rows of that step are ranked. No group is sorted as a whole.
    """
    placed = keyed.join(quota, group).where("quota > 0").withColumn("step", F.least(F.floor(F.col(value) * STEPS), F.lit(STEPS - 1)).cast("int"))
    steps = placed.groupBy(*group, "step").agg(F.count("*").alias("n"), F.first("quota").alias("quota"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*group).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = steps.withColumn("before", before).where("before < quota").groupBy(*group).agg(F.max("step").alias("last"), F.max("before").alias("before"))
    placed = placed.join(F.broadcast(cut), group)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(value, "id"))
    edge = placed.where("step = last").withColumn("rank", rank).where("rank <= quota - before")
    return placed.where("step < last").select(*keyed.columns).union(edge.select(*keyed.columns))


def _sampled(examples: DataFrame, targets: DataFrame, seed: int, joint: bool) -> tuple[DataFrame | None, list[Plan], dict, dict]:
    """The sample, the plans, the rows per cell of the pool, and the rows per plan and cell of the sample."""
    plans = _plans(targets)
    pool = written(_pool(examples, plans), "sample-pool")
    have = {(r.category, r.answerable): r.n for r in pool.groupBy("category", "answerable").agg(F.count("*").alias("n")).collect()}
    drawing = _raked(plans, have, joint)
    if not have or not drawing:
        return None, drawing, have, {}
    spark = examples.sparkSession
    keyed = _keyed(pool, drawing, seed)
    # 1 - exp(-key) spreads the keys of a pool of mean weight 1 over (0, 1)
    weighted = keyed.where("key is not null").withColumn("spread", 1 - F.exp(-F.col("key")))
    sizes = F.broadcast(spark.createDataFrame([(p.name, p.size) for p in drawing], "plan string, quota long"))
    drawn = defaultdict(dict)
    for r in _first(weighted, ["plan"], "spread", sizes).groupBy(*CELL).agg(F.count("*").alias("n")).collect():
        drawn[r.plan][r.category, r.answerable] = r.n
    after = {p.name: repaired(drawn[p.name], have, [t[:3] for t in p.targets], p.size) for p in drawing}
    quotas = _table(spark, [(name, *c, n) for name, cells in sorted(after.items()) for c, n in cells.items()], "quota long")
    # inside a cell all weights are equal, so the order of u from above is the order of the keys
    rows = _first(keyed.withColumn("spread", 1 - F.col("u")), CELL, "spread", quotas)
    return rows.select(*CELL, "id"), drawing, have, after


REPORT = "plan string, category string, answerable string, available long, wanted double, drawn long, gap double, unfillable boolean"


def proportional_sample(examples: DataFrame, targets: DataFrame, seed: int = 17, joint: bool = False) -> DataFrame:
    """The drawn ids: plan, category, answerable (cell, '' for values no target names), id.

    Weights are raked to the targets, margin after margin; every row has a key -ln(u) / weight with u a hash of seed,
    plan and id, and the smallest keys of the whole pool are drawn. Then targets short of their minimum or share are
    topped up with the next keys of their cells, and cells with too many give their last keys back. The same input
    gives the same sample. Values count in any spelling, 'any' sets no condition, null is no value; repeated ids
    count once, rows without id are left out; without rows or targets the sample is empty.
    """
    rows, *_ = _sampled(examples, targets, seed, joint)
    return rows if rows is not None else examples.sparkSession.createDataFrame([], "plan string, category string, answerable string, id string")


def sample_report(examples: DataFrame, targets: DataFrame, seed: int = 17, joint: bool = False) -> DataFrame:
    """Per target of the drawn sample: rows available, rows wanted (the larger of the minimum and the share), rows drawn, residual gap, and whether the pool can't fill it (all there is was drawn, and it is too little). Edge cases as in proportional_sample."""
    rows, plans, have, _ = _sampled(examples, targets, seed, joint)
    drawn = defaultdict(dict)
    if rows is not None:
        for r in rows.groupBy(*CELL).agg(F.count("*").alias("n")).collect():
            drawn[r.plan][r.category, r.answerable] = r.n
    report = []
    for p in plans:
        for c, a, wanted, r in p.targets:
            there, got = (sum(n for cell, n in cells.items() if _covers((c, a), cell)) for cells in (have, drawn[p.name]))
            report.append((p.name, r.category, r.answerable, there, float(wanted), got, float(max(0.0, wanted - got)), bool(got < wanted and got == there)))
    return examples.sparkSession.createDataFrame(report, REPORT)


def unfillable_cells(examples: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets (plan, category, answerable) that stay short in the drawn sample because the examples can't fill them."""
    return sample_report(examples, targets).where("unfillable").select("plan", "category", "answerable")
