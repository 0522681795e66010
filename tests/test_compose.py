"""Sections drawn for planned generation calls."""

import pytest

from millrace.operators.compose import LEAST_POOL, PlanConfig, distractors, draw_bundles, negatives, shortfall

INDEX = "project string, source string, heading string, content string"


def test_bundles_draw_sections(spark):
    rows = [("big", f"b{k}.md", "H", f"text {k}") for k in range(400)] + [("one", "single.md", "H", "alone")]
    rows += [("few", f"f{k}.md", "H", "few") for k in range(3)] + [("few", "b1.md", "H", "key of big")]
    index = spark.createDataFrame(rows, INDEX)
    n = {"big": 400, "one": 1, "few": 4}
    out = draw_bundles(index, PlanConfig(conflict=1.0, distractors=0.5)).collect()
    assert len(out) == 405
    for r in out:
        keys = [(c.source, c.heading) for c in r.context]
        own = [c for c in r.context if c.relevant]
        assert len(set(keys)) == len(keys) and min(2, n[r.project]) <= len(own) == r.n_relevant <= min(5, n[r.project])
        assert r.n_distractors in (0, 2, 3, 4)
        held = {t for p, *_, t in rows if p == r.project}
        assert all((c.content in held) == c.relevant for c in r.context)
        assert r.conflict == (r.n_relevant >= 2) == (r.slots[0].answerable == "partial" and r.slots[0].category == "contradictory_context")
        assert ("nothing to do with the rest" in r.prompt) == (r.n_distractors > 0) and all(c.content in r.prompt for c in r.context)
    assert 120 < sum(r.n_distractors > 0 for r in out) < 280
    again = draw_bundles(index.repartition(5), PlanConfig(conflict=1.0, distractors=0.5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


@pytest.mark.parametrize("foreign", [2, 4, 10, 150])
def test_distractors_are_complete(spark, foreign):
    sections = [("main", f"m{k}.md", "H", "x") for k in range(200)] + [(f"p{k % 3}", f"f{k}.md" if k % 2 else "m1.md", "H" if k % 2 else f"G{k}", "x") for k in range(foreign)]
    sections += [(f"p{k}", "m0.md", "H", "collides with an own key") for k in range(3)]
    ex = [(f"e{k}", ["main", "p1", "absent", None][k % 4], ["full", "partial", None, "none"][k // 4 % 4], [("m0.md", "H"), ("m3.md", "H")]) for k in range(64)]
    df = spark.createDataFrame(ex, "id string, project string, answerable string, context array<struct<source:string,heading:string>>")
    got = {}
    for r in distractors(df, spark.createDataFrame(sections, INDEX)).collect():
        got.setdefault(r.id, []).append((r.pos, r.project, r.source, r.heading))
    for i, project, answerable, context in ex:
        pool = {(p, s, h) for p, s, h, _ in sections if p != project and (s, h) not in context}
        own = sorted(got.get(i, []))
        if answerable == "none" or len(pool) < LEAST_POOL:
            assert not own
        else:
            assert len(own) in (3, 4) and [n for n, *_ in own] == list(range(1, len(own) + 1)) and len({x[1:] for x in own}) == len(own) and {x[1:] for x in own} <= pool
    assert distractors(df.limit(0), spark.createDataFrame(sections, INDEX)).count() == 0 and distractors(df, spark.createDataFrame([], INDEX)).count() == 0


def test_negatives_try_on_and_tell_what_is_short(spark):
    loud = "latency heap backup license coverage datacenter vulnerab roadmap incident on-call"
    rows = [("quiet", f"q{k}.md", "H", "silence") for k in range(5)] + [("loud", f"l{k}.md", "H", loud) for k in range(5)] + [("mixed", f"x{k}.md", "H", loud if k % 4 else "silence") for k in range(40)]
    index = spark.createDataFrame(rows, INDEX)
    made = negatives(index, 4)
    per = {r.project: r for r in shortfall(made, index, 4).collect()}
    assert (per["quiet"].made, per["loud"].made, per["loud"].short) == (4, 0, 4) and per["mixed"].made >= 1
    out = made.collect()
    assert len({r.id for r in out}) == len(out) and all(2 <= len(r.context) <= 4 and r.answerable == "none" for r in out)
