"""The engine's own operators on small fixtures."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators import chunking, compose, dedup, parsing, similarity, split
from millrace.operators.components import connected_components
from millrace.operators.examples import shaped
from millrace.operators.gate import gate
from millrace.operators.score import confusion, score
from millrace.sources.files import EXAMPLE

ANSWER = "The `UserRepository` reads `/auth/login` [api.md — Login]."


def example(**changes):
    base = {"id": "e1", "question": "How does the login endpoint work?", "context": [{"source": "api.md", "heading": "Login", "content": "UserRepository serves /auth/login with a timeout of 30."}], "answer": ANSWER, "category": "api", "answerable": "full", "project": "p", "tags": [], "must_not_include": []}
    base.update(changes)
    return base


def frame(spark, *rows):
    return shaped(spark.createDataFrame(list(rows), EXAMPLE).withColumn("created_at", F.current_timestamp()))


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first().x


def test_lexical_functions(spark):
    assert one(spark, X.identifiers("t"), "UserRepo uses user_id and `a b c d` via /me, not è/me; JWT") == ["UserRepo", "user_id", "/me", "JWT"]
    assert one(spark, X.normalised("t"), "ＡＢ — Ｃ…") == "ab - c..."
    assert [tuple(c) for c in one(spark, X.citations("t"), "x [a.md — B c] y [d - e][no]")] == [("a.md", "B c"), ("d", "e")]
    assert one(spark, X.question_words("t"), "How does the /me route work, the route?") == ["me", "route", "work"]
    assert one(spark, X.word_count("t"), "a  b c\n") == 3
    assert one(spark, X.first_sentence("t"), "Short. " + "x" * 60 + ". Then more.") == "Short. " + "x" * 60 + "."
    assert one(spark, X.jaccard(X.content_words("t"), F.array().cast("array<string>")), "word") == 0.0
    assert one(spark, X.token_f1(X.words("t"), F.array(F.lit("x1"), F.lit("x1"))), "x1 x1 y1") == pytest.approx(0.8)
    for fn in (X.identifiers, X.technical_words, X.citations, X.content_words):
        assert one(spark, fn("t"), None) == []


@pytest.mark.parametrize(
    "changes, code",
    [
        ({}, None),
        ({"question": "Short?"}, "question_short"),
        ({"answer": "Tiny [api.md — Login]"[:15]}, "answer_short"),
        ({"answer": ANSWER.replace("Login]", "Logout]")}, "citation_heading"),
        ({"answer": ANSWER.replace("api.md", "made.md")}, "citation_source"),
        ({"answer": "The `UserRepository` reads `/auth/login`."}, "no_citation"),
        ({"answer": ANSWER + " See `PaymentGateway`."}, "unsupported_identifiers"),
        ({"answerable": "none"}, "refusal_missing"),
        ({"answerable": "partial"}, "gap_not_flagged"),
        ({"tags": ["contradiction"]}, "conflict_not_named"),
        ({"must_not_include": ["USERREPOSITORY"]}, "forbidden_fact"),
        ({"relevant_sources": ["other.md#X"]}, "gold_outside_context"),
    ],
)
def test_gate_rules(spark, changes, code):
    row = gate(frame(spark, example(**changes))).first()
    codes = [i.code for i in row.issues]
    assert (codes == [] and row.ok) if code is None else (code in codes and not row.ok)


def test_gate_of_nulls(spark):
    row = gate(frame(spark, {"id": "n"})).first()
    assert {"question_short", "answer_short", "empty_context", "no_citation"} <= {i.code for i in row.issues}


def test_gold_scores_itself(spark):
    rows = frame(spark, example(), example(id="e2", answerable="none", answer="This is not documented in the sections.", relevant_sources=[]))
    out = {r.id: r for r in score(rows.withColumn("prediction", F.col("answer"))).collect()}
    assert out["e1"].answer_correctness == 1.0 and not out["e1"].hallucinated and out["e1"].useful
    assert out["e2"].refusal_correct and out["e2"].wholesale_refusal
    m = confusion(score(rows.withColumn("prediction", F.lit("This is not documented in the sections.")))).first()
    assert (m.true_positive, m.false_negative, m.false_positive, m.true_negative) == (0, 1, 0, 1) and m.answer_precision is None


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(2000, 2100)] + [(None, 1), (7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_question_dedup_equals_one_greedy_pass(spark):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "User_A", "User_B", "/x"]
    rows = [(f"q{k}", k, " ".join(rng.sample(words, rng.randint(0, 4))), [{"source": rng.choice("abc"), "heading": "h"}], "api", "full") for k in range(150)]
    df = spark.createDataFrame(rows, "id string, ord long, question string, context array<struct<source:string,heading:string>>, category string, answerable string")
    got = {r.id: (r.reason, r.duplicate_of) for r in dedup.question_dedup(df).collect()}
    kept, buckets, exact, subjects, wanted = [], {}, {}, {}, {}
    for i, _, q, c, *_ in rows:
        tokens = frozenset(re.findall(r"[a-z0-9_][a-z0-9_./-]*", q.lower()))
        key, sig = " ".join(sorted(tokens)), c[0]["source"]
        subject = tuple(sorted(t.lower() for t in q.split() if "_" in t or "/" in t))
        near = next((o for t, o in buckets.get(sig, []) if len(t & tokens) >= 0.82 * len(t | tokens)), None)
        if not tokens:
            wanted[i] = ("empty_question", None)
        elif key in exact:
            wanted[i] = ("duplicate_question", exact[key])
        elif near:
            wanted[i] = ("near_duplicate", near)
        elif subject and (sig, subject) in subjects:
            wanted[i] = ("same_subject", subjects[sig, subject])
        elif len(buckets.get(sig, [])) >= 6:
            wanted[i] = ("context_limit", None)
        else:
            wanted[i] = (None, None)
            exact[key] = i
            if subject:
                subjects[sig, subject] = i
            buckets.setdefault(sig, []).append((tokens, i))
    assert got == wanted


def test_group_holdout_prefix(spark):
    hold = lambda sizes, target: {r.name for r in split.hold_out_groups(spark.createDataFrame(sizes, "name string, n long"), target).collect()}
    assert hold([("a", 53), ("b", 45), ("c", 45), ("d", 41)], 18.4) == {"d"}
    assert hold([("g1", 38), ("g2", 73), ("g3", 195), ("g4", 228), ("g5", 229), ("g6", 273), ("g7", 359), ("g8", 529)], 192.4) == {"g1", "g2", "g3"}
    assert hold([("only", 5)], 1) == set()


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    make = lambda p: [(f"{p}{k}", " ".join(rng.choices([f"w{j}" for j in range(14)], k=rng.randint(0, 9)))) for k in range(80)]
    left, right = make("l"), make("r")
    sets = lambda rows: {i: set(q.split()) for i, q in rows}
    like = {i for i, a in sets(left).items() for b in sets(right).values() if a and b and len(a & b) >= 0.7 * len(a | b) - 1e-9}
    got = {r.id for r in similarity.drop_near_duplicates(spark.createDataFrame(left, "id string, question string"), spark.createDataFrame(right, "id string, question string"), threshold=0.7).collect()}
    assert got == {i for i, _ in left} - like


def test_sections():
    text = "# Top\n" + "x" * 90 + "\n```\n# not a heading\n~~~\n```\n## Small\nshort\n### Deep\n" + "y" * 90 + "\n##### Body\n"
    got = chunking.sections(text)
    assert [(h, p) for h, p, _ in got] == [("Top", ["Top"]), ("Deep", ["Top", "Small", "Deep"])]
    assert "# not a heading" in got[0][2] and "##### Body" in got[1][2]


@pytest.mark.parametrize("raw, n", [('{"examples": [{"a": 1}, {"a": 2}]}', 2), ('Hi\n```json\n[{"a": 1}]\n```', 1), ('noise [{"a": 1}] noise', 1), ("no json", 0), (None, 0), ('{"a": 1}', 1), ('{"examples": [', 0)])
def test_tolerant_parse(spark, raw, n):
    row = parsing.parse_responses(spark.createDataFrame([(raw,)], "response string")).first()
    assert len(row["items"]) == n and row.parsed == (n > 0)


@pytest.mark.parametrize(
    "style, context",
    [
        ("json", '[{"doc_id": "D1", "source": "a - b", "date": "2024-01-01", "content": "text"}]'),
        ("xml", '<doc id="D1" source="a - b" date="2024-01-01">text</doc>'),
        ("md", "---[D1] a - b · 2024-01-01 · x ---\ntext"),
    ],
)
def test_three_encodings_give_one_chunk(spark, style, context):
    records = spark.createDataFrame([("r", context + "\n\nQUESTION: why?", "because [D1]", style, ["gap"]), ("bad", "nothing", "x", style, None), ("miss", context + "\n\nQUESTION: why?", "see [D9]", style, None)], "id string, message string, answer string, style string, traits array<string>")
    out = {r.id: r for r in parsing.import_chats(records, spark.createDataFrame([], "id string, answer string")).collect()}
    assert out["r"].answer == "because [a / b — D1 · 2024-01-01]" and out["r"].answerable == "partial" and out["r"].error is None
    assert out["bad"].error == "no question marker" and "D9" in out["miss"].error


def test_references(spark):
    ref = lambda t: tuple(one(spark, compose.reference(F.col("t"), F.lit("own")), t))
    assert ref("a.md#GET: x") == ("own", "a.md", "GET: x") and ref("other:a.md#H") == ("other", "a.md", "H")
