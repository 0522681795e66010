"""Canonical form, leakage, splitting, packing and broken pairs."""

import itertools
import random

import numpy as np
import pytest

from millrace.llm import broken_pairs as B
from millrace.llm.canonical import Forms, Lookalikes, canonicalise, lookalike_members, lookalike_pairs
from millrace.llm.leakage import leaked_items, leaked_report, window_signatures
from millrace.llm.packing import fill_report, pack, read_vocabulary, sum_of_squares, token_counter, token_counts
from millrace.llm.splitting import IMBALANCE, PIECE, cut_costs, split_oversized, split_text

DOCS = "doc_id long, text string, c string, v string, id long, minimum long"


def forms(text):
    return Forms().of(text)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", None, 1, 2) for i, t in rows], DOCS)


# one form of text


@pytest.mark.parametrize(
    "a, b",
    [
        ("plain Text", "ｐｌａｉｎ Ｔｅｘｔ"),
        ("un caffè", "un caffè"),
        ("two words", "two words"),
        ("two words", "two words"),
        ("zero width", "ze​ro wi­dth﻿"),
        ("Scope", "Ѕсоре"),
        ("TOKEN", "ΤΟΚΕΝ"),
        ("ё", "ë"),
        ("настройка", "нaстpойкa"),
        ("hello", "һello"),
        ("port", "ρort"),
        ("value", "νalue"),
        ("apple", "ɑpple"),
        ("user", "υser"),
        ("line", "ⅼine"),
        ("hour", "հօսr"),
    ],
)
def test_same_look_same_form(a, b):
    assert forms(a)[0] == forms(b)[0] and forms(a)[1] == forms(b)[1]


@pytest.mark.parametrize("a, b", [("Case", "case"), ("caffè", "caffe"), ("x²", "x2"), ("line\nend", "line end"), ("①", "1"), ("ﬁne", "fine")])
def test_different_look_stays_different(a, b):
    assert forms(a)[0] != forms(b)[0]


def test_genuine_words_keep_their_script():
    assert forms("настройка τιμή")[0] == "настройка τιμή"
    assert forms(None) == ("", "") and forms("ΤΟΚΕΝ") == ("TOKEN", "token")


def test_lookalike_pairs(spark):
    rows = [(1, "a b"), (2, "a b"), (3, "a b"), (4, "A b"), (5, None), (6, ""), (7, "​"), (2, "a b"), (None, "a b")]
    got = [tuple(r) for r in lookalike_pairs(docs(spark, rows)).collect()]
    assert sorted(got) == [(1, 2), (2, 3), (5, 7), (6, 7)]
    hot = [(k, "same") for k in range(40)] + [(100, "ｓame"), (101, "ѕame")]
    assert len(lookalike_pairs(docs(spark, hot)).collect()) == 81
    assert lookalike_pairs(docs(spark, [])).count() == 0
    assert {r.doc_id: r.canonical for r in canonicalise(docs(spark, [(1, "Ｘ" * 100_000), (2, None)])).collect()} == {1: "x" * 100_000, 2: ""}


@pytest.mark.parametrize("block", [2, 2000])
def test_large_lookalike_class_keeps_every_pair(spark, block):
    spelled = ["".join(w) for w in itertools.product("sｓѕ", "aａа", "mｍ", "eｅ")]
    hot = [(100 + k, w) for k, w in enumerate(spelled)] + [(200 + k, spelled[1]) for k in range(5)] + [(300, spelled[0]), (1, "lone"), (2, "lone"), (3, "SAME")]
    wanted = {(i, j) for i, x in hot for j, y in hot if i < j and x != y and 100 <= i and 100 <= j}
    got = [tuple(r) for r in lookalike_pairs(docs(spark, hot), block=block).collect()]
    assert len(got) == len(set(got)) and set(got) == wanted
    both = [(1, "same"), (1, "ｓame"), (2, "same"), (3, "ｓame")]  # an id with two texts
    assert {tuple(r) for r in lookalike_pairs(docs(spark, both), block=block).collect()} == {(1, 2), (1, 3), (2, 3)}
    members = [tuple(r) for r in lookalike_members(docs(spark, hot)).collect()]
    assert wanted == {(a, b) for c, s, a in members for d, t, b in members if c == d and s != t and a < b}


def test_a_larger_table_of_lookalikes_can_be_read(tmp_path):
    (tmp_path / "table.txt").write_text("# comment\n0581 ;\t0032 ;\tMA\n0261 ; 0067 ; MA # g\n10412 ; 004F ; MA\n00DF ; 0062 006F ; MA\n")
    table = Lookalikes.read(str(tmp_path / "table.txt"))
    assert table.to_latin["\U00010412"] == "O" and "ß" not in table.to_latin and table.to_latin["а"] == "a"
    assert Forms(table).of("\U00010412ne") == ("One", "one")


# leakage


def test_leaks_equal_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([3, 12, 40]))), "s") for k in range(30)]
    rows = []
    for k in range(60):
        text = rng.choices(vocabulary, k=rng.randint(0, 200))
        own = rng.choice(items)[1].split()
        cut = rng.randrange(len(own))
        piece = own[cut : cut + rng.choice([5, 11, 12, 13, 40])]
        at = rng.randrange(len(text) + 1)
        rows.append((k, " \n".join(text[:at] + [w.upper() for w in piece] + text[at:])))
    rows += rows[:3] + [(900, None), (None, items[0][1])]
    items += items[:2] + [(None, "a b", "s"), (800, None, "s")]
    it = spark.createDataFrame(items, "item_id long, text string, suite string")
    runs = lambda t: {tuple((t or "").lower().split()[k : k + 12]) for k in range(len((t or "").split()) - 11)}
    wanted = {(d, i): len(runs(t) & runs(s)) for d, t in rows if d is not None for i, s, _ in items if i is not None and runs(t) & runs(s)}
    for size in ("10m", "-1"):  # with and without broadcasts
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        try:
            got = {(r.doc_id, r.item_id): r.n_windows for r in leaked_items(docs(spark, rows), it).collect()}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == wanted
    report = {r.item_id: r.n_documents for r in leaked_report(docs(spark, rows), it).collect()}
    assert report == {i: len({d for d, j in wanted if j == i}) for _, i in wanted}
    assert leaked_items(docs(spark, []), it).count() == 0 and leaked_items(docs(spark, rows), it.limit(0)).count() == 0


def test_equal_windows_have_equal_signatures():
    x = np.random.default_rng(0).integers(0, 2**63, 50).astype(np.uint64)
    for functions in (1, 3):
        whole = window_signatures(x, 12, 5, functions)
        assert len(whole) == 39 and len(np.unique(whole)) > 1
        assert all(window_signatures(x[k : k + 12], 12, 5, functions)[0] == whole[k] for k in range(39))
    one = window_signatures(x, 5, 5, 1)  # windows of one shingle: its hash
    assert np.array_equal(window_signatures(x, 12, 5, 1), np.array([one[k : k + 8].min() for k in range(39)]))
    assert len(window_signatures(x[:11], 12, 5)) == 0


# splitting


def check_spans(text, spans, limit, overlap):
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(0 < b - a <= limit for a, b in spans)
    assert all(y[0] == x[1] - overlap and y[1] > x[1] for x, y in itertools.pairwise(spans))


@pytest.mark.parametrize("text", ["word " * 400, "x" * 1500, "Line one.\n\nPara two, with a clause; more.\r\n" * 40, "日本語の設定。" * 200, "é" * 800, " " * 900])
def test_pieces_cover_the_text(text):
    for limit, overlap in ((100, 0), (100, 20), (333, 50), (7, 3)):
        check_spans(text, split_text(text, limit, overlap), limit, overlap)


@pytest.mark.parametrize("text, limit, overlap", [("aa bb. cc dd\nee ff, gg hh. ii", 12, 2), ("One two. Three, four five six.\n\nSeven eight nine ten eleven. " * 14, 330, 30)])
def test_best_cuts_over_all_boundaries(text, limit, overlap):
    cost = cut_costs(text)
    n, even_n = len(text), -(-(len(text) - overlap) // (limit - overlap))
    even = (n + (even_n - 1) * overlap) / even_n

    price = lambda a, b: IMBALANCE * ((b - a - even) / even) ** 2 + PIECE + (cost[b] + cost[b - overlap] / 2 if b < n else 0.0)
    least = {}  # cheapest sequence whose last piece ends at a position, over all boundaries
    for end in (e for e in range(overlap + 1, n + 1) if limit < 64 or cost[e] < 40):
        starts = [0] if end <= limit else []
        starts += [e - overlap for e in least if e < end and end - e + overlap <= limit]
        least[end] = min((price(s, end) + (least[s + overlap] if s else 0.0) for s in starts), default=float("inf"))
    assert sum(price(a, b) for a, b in split_text(text, limit, overlap)) == pytest.approx(least[n])


def test_split_oversized_rows(spark):
    rows = [(1, "h", "a b. " * 100, "2025-01-01"), (1, "h", "a b. " * 100, "2025-01-02"), (2, None, "short", None), (3, "h", None, None), (None, "h", "z " * 300, None), (4, "old", "c d. " * 100, "2025-01-01"), (4, "new", "short now", "2025-01-03"), (5, None, "q" * 60_000, None)]
    chunks = spark.createDataFrame([(i, h, c, "last", t) for i, h, c, t in rows], "chunk_id long, heading string, content string, last string, t string").selectExpr("*", "cast(t as timestamp) as loaded_at")
    limits = spark.createDataFrame([("p", 100, 10), ("bad", 10, 10), (None, 5, 1), ("q", 450, 0), ("p", 100, 10)], "profile string, max_chars int, overlap_chars int")
    got = split_oversized(chunks, limits).collect()
    assert {(r.profile, r.chunk_id) for r in got} == {("p", 1), ("q", 1), ("p", 5), ("q", 5)}
    for key in {(r.profile, r.chunk_id) for r in got}:
        own = sorted((r.piece, r.start, r.end, r.content, r.heading, r.n_pieces) for r in got if (r.profile, r.chunk_id) == key)
        text = {1: "a b. " * 100, 5: "q" * 60_000}[key[1]]
        check_spans(text, [(a, b) for _, a, b, *_ in own], *{"p": (100, 10), "q": (450, 0)}[key[0]])
        assert all(text[a:b] == c and n == len(own) for _, a, b, c, _, n in own)
    assert split_oversized(chunks.limit(0), limits).count() == 0 and split_oversized(chunks, limits.limit(0)).count() == 0


# packing


def test_sum_of_squares_follows_its_rule():
    rng = random.Random(3)
    sizes, capacity = [rng.randint(0, 12) for _ in range(400)], 12
    box, fills = sum_of_squares(np.array(sizes), capacity)
    open_, levels = [0] * (capacity + 1), []
    for size, b in zip(sizes, box, strict=True):
        if size == 0:
            continue
        before = sum(x * x for x in open_)
        options = {}
        for h in [0, *[h for h in range(1, capacity) if open_[h]]]:
            if h + size <= capacity:
                after = list(open_)
                if h:
                    after[h] -= 1
                if h + size < capacity:
                    after[h + size] += 1
                options[h] = sum(x * x for x in after) - before
        level = levels[b] if b < len(levels) else 0
        assert options[level] == min(options.values())
        if level:
            open_[level] -= 1
        if b == len(levels):
            levels.append(0)
        levels[b] += size
        if levels[b] < capacity:
            open_[levels[b]] += 1
    assert levels == fills.tolist() and max(levels) <= capacity and sum(levels) == sum(sizes)


@pytest.mark.parametrize("capacity, least", [(512, 0.97), (1024, 0.97), (4096, 0.97)])
def test_little_room_is_left_over(capacity, least):
    sizes = np.minimum(capacity, np.random.default_rng(capacity).lognormal(5.3, 0.9, 6000).astype(int) + 1)
    _, fills = sum_of_squares(sizes, capacity)
    assert fills.sum() == sizes.sum() and fills.sum() / (len(fills) * capacity) >= least


def test_packing_keeps_items_whole(spark):
    sizes = spark.createDataFrame([(k, (k * 37) % 90) for k in range(200)] + [(500, 250), (501, 100), (502, 0), (503, None), (7, 40), (None, 5)], "doc_id long, n_tokens long")
    kinds = spark.createDataFrame([("a", 100), ("b", 64), (None, 9), ("zero", 0)], "kind string, capacity_tokens int")
    placed = pack(sizes, kinds, bucket_rows=60)
    rows = placed.collect()
    assert {r.kind for r in rows} == {"a", "b"}
    for kind, capacity in (("a", 100), ("b", 64)):
        own = [r for r in rows if r.kind == kind]
        boxes, per_doc = {}, {}
        for r in own:
            boxes[(r.bucket, r.container)] = boxes.get((r.bucket, r.container), 0) + r.n_tokens
            per_doc.setdefault(r.doc_id, []).append((r.piece, r.first_token, r.n_tokens))
        assert max(boxes.values()) <= capacity and len(per_doc) == 204
        for doc, pieces in per_doc.items():
            pieces.sort()
            total = sum(n for *_, n in pieces)
            assert [f for _, f, _ in pieces] == [k * capacity for k in range(len(pieces))]
            assert len(pieces) == max(1, -(-total // capacity)), doc
    report = {r.kind: r for r in fill_report(placed, kinds).collect()}
    assert report["a"].n_items == 204 and report["a"].n_cut == 1 and report["a"].fill > 0.8
    assert sorted(map(tuple, rows)) == sorted(map(tuple, pack(sizes.repartition(7), kinds, bucket_rows=60).collect()))
    assert pack(sizes.limit(0), kinds).count() == 0 and pack(sizes, kinds.limit(0)).count() == 0


def test_token_counts(spark):
    got = {r.doc_id: r.n_tokens for r in token_counts(docs(spark, [(1, "hello world"), (2, None), (3, ""), (4, "è " * 5000), (None, "x")])).collect()}
    count = token_counter(read_vocabulary())
    assert got == {1: 2, 2: 0, 3: 0, 4: count("è " * 5000)} and got[4] >= 5000


# broken pairs

GOOD_Q = "Which step of the router validates the payload that the queue receives from the broker?"
GOOD = "The router validates the payload before the queue accepts it, and logs a warning [01-overview.md — Flow]. It then keeps the old value in the same transaction."
CASES = [
    (GOOD_Q, GOOD, None),
    (GOOD_Q, "The router validates it.\n\n```yaml\nkey: 1\n```", None),
    (GOOD_Q, "The router validates it.\n- `pool_idle_count`: 53", None),
    (GOOD_Q, "The router validates it before use. Whether it also resets the queue cannot be determined from these pages.", None),
    (GOOD_Q, "Requests that cannot be answered by the router are parked in the queue until 5 workers are free.", None),
    (GOOD_Q, None, "empty"),
    (None, "", "empty"),
    (GOOD_Q, "​", "empty"),
    (GOOD_Q, "N/A", "empty"),
    (GOOD_Q, "```\n```", "empty"),
    (GOOD_Q, GOOD[:95], "truncated"),
    (GOOD_Q, "The router validates the payload [01-over", "truncated"),
    (GOOD_Q, "The router validates it.\n\n```yaml\nkey: 1", "truncated"),
    (GOOD_Q, "The router validates the payload, and the", "truncated"),
    (GOOD_Q, "I cannot answer this from the context: nothing about the broker is documented.", "refusal"),
    (GOOD_Q, "Non posso rispondere: il broker è nominato, ma non si documenta nulla.", "refusal"),
    (GOOD_Q, GOOD_Q, "copy"),
    (GOOD_Q, "Q: " + GOOD_Q.lower(), "copy"),
    (GOOD_Q, GOOD_Q + "\n\n" + GOOD_Q, "copy"),
    (GOOD_Q, "Il modulo ritenta il lotto aperto dal nodo finché la coda resta sotto 12, e mantiene il valore già presente. Questo non è un errore.", "language"),
    ("Perché il nodo risponde con un cursore scaduto dopo il riavvio della coda?", "The node falls back to the copy held in the queue while the limit stays under 5, and keeps the old value.", "language"),
]


def test_defects(spark):
    rows = [(f"id{n:03d}-{k}", q, a, "Full ") for n in range(12) for k, (q, a, _) in enumerate(CASES)]
    rows += [(f"ok{n:03d}", GOOD_Q, GOOD + f" It restarts {n} times.", "full") for n in range(300)]
    rows += rows[:3] + [("nolabel", GOOD_Q, CASES[14][1], None), ("none", GOOD_Q, CASES[14][1], "none"), (None, GOOD_Q, None, "full")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "id string, question string, answer string, answerable string, full string, defect string")
    got = {r.id: r.defect for r in B.broken_pairs(df).collect()}
    for n in range(12):
        for k, (_, _, defect) in enumerate(CASES):
            assert got.get(f"id{n:03d}-{k}") == defect, CASES[k]
    assert not {i for i in got if i.startswith("ok")} and "nolabel" not in got and "none" not in got
    assert B.broken_pairs(df.limit(0)).count() == 0


def test_refusals_and_languages_beyond_the_lists_and_several_labels(spark):
    german = "Welcher Schritt des Routers prüft die Nutzdaten, bevor die Warteschlange sie vom Broker annimmt und ablegt?"
    dutch = "De router controleert het bericht voordat de wachtrij het aanneemt en schrijft daarna een waarschuwing naar het logboek."
    refusals = ["I am not able to help with that request.", "That is outside my scope.", "Non posso rispondere a questa domanda: nelle sezioni non si documenta nulla di simile."]
    rows = [(f"r{k}-{n}", GOOD_Q, a, "full") for n in range(20) for k, a in enumerate(refusals)] + [(f"nl{n}", german, dutch, "full") for n in range(20)]
    rows += [(f"none{n}", GOOD_Q, f"The sections do not say which step does it in case {n}; nothing is documented.", "none") for n in range(80)]
    rows += [(f"ok{n:03d}", GOOD_Q, GOOD + f" It restarts {n} times.", "full") for n in range(400)] + [(f"de{n:03d}", german, f"Der Router prüft die Nutzdaten, bevor die Warteschlange sie annimmt, und schreibt {n} Warnungen in das Protokoll [a.md — B].", "full") for n in range(100)]
    df = spark.createDataFrame(rows, "id string, question string, answer string, answerable string")
    got = {}
    for r in B.pair_defects(df).collect():
        got.setdefault(r.id, set()).add(r.defect)
    for n in range(20):
        assert "refusal" in got.get(f"r0-{n}", ()) and "refusal" in got.get(f"r1-{n}", ())
        assert got[f"r2-{n}"] == {"refusal", "language"} and got.get(f"nl{n}") == {"language"}
    assert not {i for i in got if i[:2] in ("ok", "de")}
    assert {r.defect for r in B.broken_pairs(df).where("id like 'r2-%'").collect()} == {"refusal"}


def test_validated_cutoff_and_spoilt_pairs():
    assert B.validated_cutoff(np.array([0.05, 0.3, 0.6, 0.7]), np.array([False, False, True, True])) == pytest.approx(0.45)
    made = B.spoilt([(GOOD_Q, GOOD), ("Perché il nodo risponde con un cursore scaduto dopo il riavvio della coda?", "Il nodo usa la copia della coda finché il limite resta sotto 5 e mantiene il valore già presente.")], ["cannot answer"])
    assert set(made) == set(B.DEFECTS) and all(made[d] for d in B.DEFECTS)


def test_label_model_recovers_noisy_votes():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.1
    flips = [0.05, 0.1, 0.2]
    v = np.stack([np.where(rng.random(len(truth)) < f, ~truth, truth) for f in flips], axis=1) * 2 - 1
    v[rng.random(v.shape) < 0.2] = 0
    patterns, at, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    post = B.fit_label_model(patterns, counts.astype(float))[at.ravel()]
    model = ((post > 0.5) == truth).mean()
    majority = ((v.sum(axis=1) > 0) == truth).mean()
    assert model > 0.95 and model >= majority
    cut = B.validated_cutoff(post, truth)
    assert ((post > cut) & truth).sum() / truth.sum() > 0.75
    assert B.validated_cutoff(np.array([0.1, 0.2]), np.array([False, False])) == B.CUTOFF
