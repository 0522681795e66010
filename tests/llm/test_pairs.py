"""Similarity joins against brute force, with hot groups, blocks, nulls, repeats and clashing columns."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from millrace.llm import overlap_join
from millrace.llm.common import expand_members
from millrace.llm.near_duplicates import near_duplicate_groups, near_duplicate_links, near_duplicate_pairs
from millrace.llm.overlap_join import merge_skip, merged, similar_classes
from millrace.llm.split_overlap import split_overlap_pairs, split_overlap_records, split_overlap_report

SCHEMA = "id string, question string, answer string, c long, tokens string, side int, project string"


def words(*texts):
    return frozenset(re.findall(r"[^\W_]+", " ".join(t or "" for t in texts).lower()))


def brute(rows, key, threshold=0.8):
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets.setdefault(r[0], key(r))
    ids = sorted(sets)
    out = set()
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                out.add((a, b))
    return out


def rows_with_edits(seed, n=80):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(n):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(1, 14))]
        for v in range(rng.randint(1, 4)):
            copy = list(text)
            if v and copy:
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                rng.shuffle(copy)
            cut = rng.randrange(len(copy) + 1)
            rows.append((f"d{k:03d}-{v}", " ".join(copy[:cut]) or None, " ".join(copy[cut:]).upper(), 1, "x", 2, "p"))
    rows += rows[:5] + [("empty1", None, None, 0, None, 0, None), ("empty2", "", " -- ", 0, None, 0, None), (None, "w1 w2", "w3", 0, None, 0, None)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_equal_brute_force(spark, seed):
    rows = rows_with_edits(seed)
    found = [tuple(r) for r in near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(rows, lambda r: words(r[1], r[2]))


@pytest.mark.parametrize("mu", [0.002, 0.5])
def test_every_division_and_block_gives_the_same_pairs(spark, mu):
    rng = random.Random(5)
    sets = spark.createDataFrame([(k, sorted(rng.sample(range(25), rng.randint(2, 12))), 3) for k in range(150)], "c long, tokens array<long>, side int").cache()
    data = {r.c: set(r.tokens) for r in sets.collect()}
    wanted = {(a, b): len(data[a] & data[b]) / len(data[a] | data[b]) for a in data for b in data if a < b and len(data[a] & data[b]) >= 0.7 * len(data[a] | data[b]) - 1e-9}
    for block, cells, most in ((10**6, 1 << 10, 100), (3, 4, 100), (3, 4, 2)):
        found = similar_classes(sets, 0.7, block=block, cells=cells, mu=mu, most=most).collect()
        got = {tuple(sorted((r.c1, r.c2))): r.likeness for r in found}
        assert len(got) == len(found) and got == pytest.approx(wanted)


def test_merge_skip_counts_like_a_plain_count():
    rng = random.Random(8)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randint(1, 25))) for _ in range(rng.randint(1, 7))]
        c2, spans = [], []
        for own in lists:
            spans.append((len(c2), len(c2) + len(own)))
            c2 += own
        per = {x: rng.randint(1, 4) for x in range(40)}
        k, none = [per[x] for x in c2], [0] * len(c2)
        counted = Counter(c2)
        assert {c: n for c, n, *_ in merge_skip(spans, c2, k, none, none)} == {c: n for c, n in counted.items() if n >= per[c]}


def test_sets_that_span_batches_are_merged_once():
    rng = random.Random(9)
    rows = sorted((c1, 0, place, c2) for c1 in range(12) for place in range(3) for c2 in rng.sample(range(100), rng.randint(1, 20)))
    whole = pa.RecordBatch.from_pydict({"c1": [r[0] for r in rows], "slot": [r[1] for r in rows], "place": [r[2] for r in rows], "c2": [r[3] for r in rows], "need": [0] * len(rows), "k": [2] * len(rows), "room": [0] * len(rows)})
    counts = Counter((r[0], r[3]) for r in rows)
    for size in (1, 7, 10**6):
        out = [(r["c1"], r["c2"], r["m"]) for b in merged(whole.slice(a, size) for a in range(0, len(rows), size)) for r in b.to_pylist()]
        assert sorted(out) == sorted((*p, n) for p, n in counts.items() if n >= 2)


def records_shuffled(spark, job):
    spark.sparkContext.setJobGroup(name := f"shuffled-{random.random()}", name)
    try:
        out = job()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {k for j in tracker.getJobIdsForGroup(name) for k in tracker.getJobInfo(j).stageIds}
    return out, sum(store.lastStageAttempt(k).shuffleWriteRecords() for k in stages)


def test_lists_of_frequent_words_grow_as_the_sets(spark):
    # 4 words of a set's own, 16 of 40 that are on two fifths of all sets; every tenth set has a copy with a word more
    rng, shuffled = random.Random(11), {}
    for n in (400, 1600):
        rows = [(k, sorted([10**6 + 4 * k + j for j in range(4)] + rng.sample(range(40), 16)), 3) for k in range(n)]
        rows += [(n + c, [*tokens, 10**7 + c], 3) for c, tokens, _ in rows[::10]]
        sets = spark.createDataFrame(rows, "c long, tokens array<long>, side int")
        found, shuffled[n] = records_shuffled(spark, lambda: similar_classes(sets, 0.8, block=20).collect())  # noqa: B023
        assert sorted(tuple(sorted((r.c1, r.c2))) for r in found) == [(k, n + k) for k in range(0, n, 10)]
    assert shuffled[1600] < 6 * shuffled[400]


@pytest.mark.parametrize("meet", [1, 3])
def test_parts_of_long_lists_give_the_same_pairs(spark, meet):
    rng = random.Random(12)
    data = {}
    for k in range(120):
        words = rng.sample(range(60), rng.randint(2, 45))
        data |= {2 * k: set(words), 2 * k + 1: set(words) ^ set(rng.sample(range(60), rng.randint(1, 4)))}
    sets = spark.createDataFrame([(c, sorted(w), rng.choice([1, 2, 3])) for c, w in data.items() if len(w) > 1], "c long, tokens array<long>, side int").cache()
    side = {r.c: r.side for r in sets.collect()}
    for sides in (False, True):
        wanted = {(a, b) for a in side for b in side if a < b and len(data[a] & data[b]) >= 0.8 * len(data[a] | data[b]) - 1e-9 and (not sides or side[a] & 1 and side[b] & 2 or side[a] & 2 and side[b] & 1)}
        found = [tuple(sorted((r.c1, r.c2))) for r in similar_classes(sets, 0.8, sides=sides, block=4, meet=meet).collect()]
        assert len(found) == len(set(found)) and set(found) == wanted


def test_lists_that_span_batches_meet_once(monkeypatch):
    rng = random.Random(13)
    rows = sorted((key, c, rng.randint(8, 12), rng.randint(0, 2), True) for key in range(5) for c in rng.sample(range(100), rng.randint(1, 40)))
    column = lambda x: [r[x] for r in rows]
    fixed = dict.fromkeys(("side", "spread"), [3] * len(rows)) | dict.fromkeys(("s0", "s1"), [0] * len(rows)) | {"k": [1] * len(rows), "upto": [12] * len(rows)}
    whole = pa.RecordBatch.from_pydict({"key": column(0), "c": column(1), "n": column(2), "place": column(3), "home": column(4)} | fixed)
    need = lambda a, b: math.ceil(0.8 / 1.8 * (a + b) - 1e-9)
    wanted = sorted((x[1], y[1], x[3]) for x in rows for y in rows if x[0] == y[0] and (x[2], x[1]) < (y[2], y[1]) and x[2] >= 0.8 * y[2] - 1e-9 and min(x[2] - x[3], y[2] - y[3]) >= need(x[2], y[2]))
    for held, at_once, size in ((10**6, 10**6, 10**6), (1, 5, 7), (30, 3, 1)):
        monkeypatch.setattr(overlap_join, "HELD", held)
        monkeypatch.setattr(overlap_join, "AT_ONCE", at_once)
        out = [(r["c1"], r["c2"], r["place"]) for b in overlap_join.matched((whole.slice(a, size) for a in range(0, len(rows), size)), 0.8, False) for r in b.to_pylist()]
        assert wanted and sorted(out) == wanted


def test_large_groups_keep_all_pairs_and_have_representatives(spark):
    rows = [(f"a{k:03d}", "one two three four five", "x", 0, None, 0, None) for k in range(30)] + [("b", "one two three four five six", "x", 0, None, 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    pairs = near_duplicate_pairs(df).collect()
    ids = sorted(r[0] for r in rows)
    assert len(pairs) == 31 * 30 // 2 and {tuple(p) for p in pairs} == {(a, b) for a in ids for b in ids if a < b}
    assert [(r.id_a, r.id_b, r.likeness) for r in near_duplicate_links(df).collect()] == [("a000", "b", round(6 / 7, 6))]
    groups = {r.id: r for r in near_duplicate_groups(df).collect()}
    assert {r.class_id for r in groups.values()} == {"a000", "b"} and {r.group_id for r in groups.values()} == {"a000"}
    assert groups["a007"].class_rows == 30 and groups["b"].n_links == 1


def test_links_and_groups_imply_the_pairs(spark):
    df = spark.createDataFrame(rows_with_edits(6), SCHEMA)
    group = {r.id: r for r in near_duplicate_groups(df).collect()}
    members = {}
    for r in group.values():
        members.setdefault(r.class_id, []).append(r.id)
    links = {(r.id_a, r.id_b) for r in near_duplicate_links(df).collect()}
    implied = {tuple(sorted((a, b))) for x, y in links for a in members[x] for b in members[y]} | {(a, b) for m in members.values() for a in m for b in m if a < b}
    assert implied == {tuple(r) for r in near_duplicate_pairs(df).collect()}


def test_groups_are_the_components_of_the_pairs(spark):
    rows = rows_with_edits(3)
    out = {r.id: r for r in near_duplicate_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    ids = sorted({r[0] for r in rows if r[0]})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute(rows, lambda r: words(r[1], r[2])):
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    assert {i: find(i) for i in ids} == {i: out[i].group_id for i in ids}
    assert out["empty1"].group_id == "empty1" and out["empty2"].group_id == "empty2"


def test_no_rows_no_pairs(spark):
    assert near_duplicate_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near_duplicate_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_text(spark):
    long = " ".join(f"t{k}" for k in range(60_000))
    rows = [("a", long, None, 0, None, 0, None), ("b", long + " more", None, 0, None, 0, None), ("c", long[: len(long) // 2], None, 0, None, 0, None)]
    assert {tuple(r) for r in near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA)).collect()} == {("a", "b")}


def test_expansion_counts_each_link_once(spark):
    links = spark.createDataFrame([(1, 2)], "c1 long, c2 long")
    members = spark.createDataFrame([(1, "a"), (1, "d"), (2, "b"), (3, "z")], "c long, id string")
    assert sorted(map(tuple, expand_members(links, members).collect())) == [("a", "b"), ("a", "d"), ("b", "d")]
    assert sorted(map(tuple, expand_members(links, members, inner=False).collect())) == [("a", "b"), ("b", "d")]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_expansion_in_blocks(spark, block):
    sizes = {1: 11, 2: 5, 3: 1, 4: 7}
    ids = {c: [f"{c}-{k:02d}" for k in range(n)] for c, n in sizes.items()}
    members = spark.createDataFrame([(c, i) for c, own in ids.items() for i in own], "c long, id string")
    got = [tuple(r) for r in expand_members(spark.createDataFrame([(1, 2), (3, 1)], "c1 long, c2 long"), members, block=block).collect()]
    inside = {(a, b) for own in ids.values() for a in own for b in own if a < b}
    across = {tuple(sorted((a, b))) for x, y in ((1, 2), (3, 1)) for a in ids[x] for b in ids[y]}
    assert len(got) == len(set(got)) and set(got) == inside | across


SPLITS = [("Train", "train"), (" VALIDATION ", "validation"), ("test", "test"), ("trai n", "train"), ("other", None), (None, None)]


def test_cross_split_pairs(spark):
    rng = random.Random(7)
    rows = rows_with_edits(4, 60)
    rows += [(f"same{k}", "hot words all alike", None, 0, None, 0, "P one") for k in range(8)]
    labels = {}
    splits = []
    for i in sorted({r[0] for r in rows if r[0]}):
        if rng.random() < 0.9:
            raw, label = rng.choice(SPLITS)
            splits += [(i, raw, "v")] * rng.randint(1, 2)
            labels[i] = label
    splits += [("unknown", "train", "v"), (None, "test", "v")]
    ex, sp = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(splits, "id string, split string, side string")
    pairs = [tuple(r) for r in split_overlap_pairs(ex, sp).collect()]
    assert len(pairs) == len(set(pairs))
    wanted = {p for p in brute(rows, lambda r: words(r[1])) if {labels.get(p[0]), labels.get(p[1])} in ({"train", "test"}, {"train", "validation"})}
    assert set(pairs) == wanted
    records = {r.id: r for r in split_overlap_records(ex, sp).collect()}
    alike = {}
    for a, b in wanted:
        alike.setdefault(b if labels[a] == "train" else a, []).append(a if labels[a] == "train" else b)
    assert {i: (r.train_id, r.n_alike) for i, r in records.items()} == {i: (min(own), len(own)) for i, own in alike.items()}
    report = {(r.split, r.project): r for r in split_overlap_report(ex, sp).collect()}
    held = {x for p in wanted for x in p if labels[x] != "train"}
    assert sum(r.n_overlap for r in report.values()) == len(held)
    assert sum(r.n for r in report.values()) == sum(v in ("validation", "test") for v in labels.values())


def test_equal_records_keep_order_and_repeats(spark):
    texts = {"t1": "Which port does A call on B?", "t2": "really slow", "t3": "?!", "e1": "which  PORT does a call on b", "e2": "Which port does B call on A?", "e3": "really, really slow", "e4": "...", "e5": "something else here"}
    ex = spark.createDataFrame([(i, q, None, 1, None, 1, "p") for i, q in texts.items()], SCHEMA)
    sp = spark.createDataFrame([(i, "train" if i[0] == "t" else "test") for i in texts], "id string, split string")
    (r,) = split_overlap_report(ex, sp).collect()
    assert (r.n, r.n_equal, r.n_overlap) == (5, 1, 3)
    assert {r.id: r.n_equal for r in split_overlap_records(ex, sp).collect()} == {"e1": 1, "e2": 0, "e3": 0}


def test_cross_split_of_empty_tables(spark):
    ex, sp = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "id string, split string")
    assert split_overlap_pairs(ex, sp).count() == 0 and split_overlap_report(ex, sp).count() == 0
