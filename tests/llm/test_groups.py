"""Sampling by proportions and splits by related groups."""

import random
from collections import Counter, defaultdict

import pytest

from millrace.llm.grouped_split import assign_splits, label_report, parted_groups, related_groups, split_report, stratify
from millrace.llm.proportional_sample import proportional_sample, rake, repaired, sample_report, unfillable_cells

TARGETS = "plan string, category string, answerable string, sample_share double, target_share double, min_rows int"
EXAMPLES = "id string, category string, answerable string, project string, plan string, quota int, component string"


def examples(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], EXAMPLES)


def test_raking_meets_several_margins():
    pool = {("a", "x"): 400, ("a", "y"): 100, ("b", "x"): 100, ("b", "y"): 300, ("", "x"): 100}
    p = rake(pool, [[("a", "any", 0.3), ("b", "any", 0.7)], [("any", "x", 0.5), ("any", "y", 0.5)]])
    assert p[("", "x")] == 0
    assert p[("a", "x")] + p[("a", "y")] == pytest.approx(0.3, abs=1e-6)
    assert p[("a", "x")] + p[("b", "x")] == pytest.approx(0.5, abs=1e-6)
    # raking keeps the odds ratio of the pool
    assert p[("a", "x")] * p[("b", "y")] / (p[("a", "y")] * p[("b", "x")]) == pytest.approx(12, rel=1e-4)
    assert rake({}, []) == {}


def test_sample_meets_quotas_and_reports_gaps(spark):
    rng = random.Random(2)
    rows = [(f"i{k}", rng.choice(["API", "api ", "data-flow", "Data_Flow", "rare" if k < 40 else "api", None]), rng.choice(["full", "FULL", "none", None]), "p") for k in range(3000)]
    rows += rows[:50] + [(None, "api", "full", "p")]
    targets = [("one", "api", "any", 0.2, 0.5, 3), ("one", "data flow", "any", 0.2, 0.48, 3), ("one", "rare", "any", 0.2, 0.0, 5), ("one", "absent", "any", 0.2, 0.02, 2), ("two", "api", "none", 0.9, 1.0, 1)]
    df, t = examples(spark, rows), spark.createDataFrame(targets, TARGETS)
    sample = proportional_sample(df, t).collect()
    assert len(sample) == len({(r.plan, r.id) for r in sample})
    report = {(r.plan, r.category): r for r in sample_report(df, t).collect()}
    drawn = Counter((r.plan, r.category) for r in sample)
    for (plan, category), r in report.items():
        key = "".join(category.split())
        assert drawn[(plan, key)] == r.drawn <= r.available
    assert all(r.gap == 0 or r.drawn == r.available for r in report.values())
    assert abs(report["one", "api"].drawn - 300) <= 7 and abs(report["one", "data flow"].drawn - 288) <= 7
    assert report["one", "rare"].drawn >= min(5, report["one", "rare"].available)
    gaps = {tuple(r) for r in unfillable_cells(df, t).collect()}
    assert gaps == {("one", "absent", "any"), ("two", "api", "none")}
    again = proportional_sample(df.repartition(5), t).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, sample))
    assert proportional_sample(df.limit(0), t).count() == 0 and sample_report(df, t.limit(0)).count() == 0
    margins = spark.createDataFrame([("m1", "api", "any", 0.2, 0.4, 1), ("m1", "dataflow", "any", 0.2, 0.6, 1), ("m2", "any", "full", 0.2, 0.7, 1), ("m2", "any", "none", 0.2, 0.3, 1)], TARGETS)
    joint = {(r.category, r.answerable): r for r in sample_report(df, margins, joint=True).collect()}
    assert abs(joint["api", "any"].drawn - 240) <= 20 and abs(joint["any", "full"].drawn - 420) <= 20 and all(r.gap == 0 for r in joint.values())
    one = proportional_sample(df, margins, joint=True).collect()
    assert {r.plan for r in one} == {"joint"} and abs(len(one) - 600) <= 20
    # the margins leave the odds ratio to the pool, in which category and answerability are independent
    cells = Counter((r.category, r.answerable) for r in one)
    assert abs(cells["api", "full"] - 0.4 * 0.7 * 600) < 30 and cells["", "full"] == 0


def test_weighted_keys_follow_the_weights(spark):
    rows = [(f"a{k}", "a", "full", None) for k in range(900)] + [(f"b{k}", "b", "full", None) for k in range(300)]
    t = spark.createDataFrame([("p", "a", "any", 0.1, 0.25, 0), ("p", "b", "any", 0.1, 0.75, 0)], TARGETS)
    taken = Counter()
    for seed in range(6):
        sample = proportional_sample(examples(spark, rows), t, seed=seed).collect()
        assert Counter(r.category for r in sample) == {"a": 30, "b": 90}
        taken.update(r.id for r in sample)
    assert len(taken) > 400 and max(taken.values()) <= 6  # other rows under other seeds


def test_repair_tops_up_small_targets_and_keeps_the_size():
    available = {("a", "x"): 100, ("a", "y"): 50, ("b", "x"): 3, ("c", "y"): 40}
    targets = [("a", "any", 20.0), ("b", "any", 5.0), ("c", "y", 10.0)]
    out = repaired({("a", "x"): 30, ("a", "y"): 3}, available, targets, 33)
    assert out["b", "x"] == 3 and out["c", "y"] == 10 and out["a", "x"] + out["a", "y"] == 20
    short = repaired({("a", "x"): 2}, available, targets, 2)
    assert sum(short.values()) == 33 and short["a", "x"] + short["a", "y"] == 20


def grouped(rows):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    import re

    for i, project in rows:
        root = "r" + re.sub(r"(?i)([-_](noise|var|aug)\d+)+$", "", i)
        parent[find("i" + i)] = find(root)
        key = re.sub(r"[\s_-]", "", (project or "").lower())
        if key:
            parent[find(root)] = find("p" + key)
    out = defaultdict(set)
    for i, _ in rows:
        out[find("i" + i)].add(i)
    return {frozenset(v) for v in out.values()}


def test_related_groups_follow_chains(spark):
    rng = random.Random(4)
    rows = [(f"p-{rng.randrange(60):03d}" + rng.choice(["", "-noise1", "_VAR2", "-aug3-noise1"]), rng.choice([None, "", "One", "one ", "o-ne", "two", *[f"q{k}" for k in range(30)]])) for _ in range(150)]
    df = examples(spark, [(i, "c", "full", p) for i, p in rows])
    got = defaultdict(set)
    for r in related_groups(df).collect():
        got[r.component].add(r.id)
    assert {frozenset(v) for v in got.values()} == grouped(rows)
    splits = [(i, rng.choice(["train", "Train ", "test", "validation", None])) for i, _ in rows[::2]] + [("stranger", "test")]
    sp = spark.createDataFrame(splits, "id string, split string")
    labels = defaultdict(set)
    for i, s in splits:
        if s:
            labels[i].add(s.strip().lower())
    wanted = {(min(g), i) for g in grouped(rows) for i in g if len(set().union(*[labels[x] for x in g])) > 1}
    t = spark.createDataFrame([("train", 0.8), ("test", 0.2)], "split string, share double")
    got = parted_groups(df, sp, t).collect()
    assert {(r.group_id, r.id) for r in got} == wanted and len({r.group_id for r in got}) == len({(r.group_id, r.split) for r in got})
    assert parted_groups(df.limit(0), sp, t).count() == 0 and parted_groups(df, sp.limit(0), t).count() == 0


def test_stratified_assignment(spark):
    rng = random.Random(6)
    rows = [(f"p{g}-{k}", rng.choice(["a", "b", "rare" if g % 9 == 0 else "a"]), rng.choice(["full", None]), f"project {g}") for g in range(120) for k in range(rng.randint(1, 12))]
    rows += [(f"s{k}", "a", "none", None) for k in range(300)] + rows[:4]
    df = examples(spark, rows)
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1), (None, 1.0)], "split string, share double")
    for units in (2000, 20):
        out = assign_splits(df, targets, units=units)
        placed = {r.id: r for r in out.collect()}
        assert set(placed) == {r[0] for r in rows}
        by = defaultdict(set)
        for r in placed.values():
            by[r.component].add(r.split)
        assert all(len(s) == 1 for s in by.values())
        share = {r.split: r.share_reached for r in split_report(out, targets).where("split is not null").collect()}
        assert abs(share["train"] - 0.8) < 0.03 and abs(share["test"] - 0.1) < 0.03
    assert assign_splits(df.limit(0), targets).count() == 0 and assign_splits(df, targets.limit(0)).count() == 0


def test_every_label_is_stratified(spark):
    # 100 labels of 20 rows, and 40 rarer ones of 10 rows, each row its own group
    rows = [(f"c{c}-{k}", f"c{c}", "full", None) for c in range(140) for k in range(20 if c < 100 else 10)]
    df = examples(spark, rows)
    targets = spark.createDataFrame([("train", 0.8), ("test", 0.2)], "split string, share double")
    out = assign_splits(df, targets)
    report = {(r.label, r.split): r for r in label_report(out, df, targets).collect()}
    assert len(report) == 280 and sum(r.n_ids for r in report.values()) == len(rows)
    for c in range(140):
        n = 20 if c < 100 else 10
        one, two = report[f"c{c}/full", "train"], report[f"c{c}/full", "test"]
        assert one.n_label == two.n_label == one.n_ids + two.n_ids == n
        assert abs(two.n_ids - 0.2 * n) <= 0.1 * n


def test_rarest_label_first():
    units = [("big", {"a": 80, "z": 1}), *[(f"u{k}", {"a": 1}) for k in range(19)], ("z", {"z": 1})]
    out = stratify(units, [("train", 0.8), ("test", 0.2)])
    assert out["big"] == "train" and sum(n for u, ls in units for n in ls.values() if out[u] == "test") in (19, 20, 21)
