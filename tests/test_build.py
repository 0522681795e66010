"""Evaluation, builds, ledgers and readers of the smaller inputs."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import build, compose, evaluation, ledger, parsing, split
from millrace.session import discard, written
from millrace.sources import files

INDEX = "project string, source string, heading string, content string"


def index(spark):
    rows = [(p, f"{p}{k}.md", "Setup", f"The module {p} reads key_{p}_{k} at start and keeps a copy of every record that it has seen so far.") for p in ("one", "two", "three") for k in range(6)]
    return spark.createDataFrame(rows, INDEX)


def seeds(spark):
    rows = [(f"{p}-{k}", p, f"Which key does the module {p} read at start, number {k}?", f"It reads `key_{p}_{k}` at start [{p}{k}.md — Setup].", "configuration", [f"{p}{k}.md#Setup"], [f"{p}5.md#Setup"] if k == 0 else []) for p in ("one", "two", "three") for k in range(3)]
    return spark.createDataFrame(rows, "id string, project string, question string, answer string, category string, sources array<string>, distractors array<string>").withColumns({"difficulty": F.lit("easy"), "answerable": F.lit(None).cast("string"), "tags": F.array(F.lit("t"))})


def test_seed_examples(spark):
    out = {r.id: r for r in compose.seed_examples(seeds(spark), index(spark)).collect()}
    assert out["one-1"].tags == ["t", "seed"] and out["one-1"].answerable == "full" and out["one-1"].relevant_sources == ["one1.md#Setup"]
    assert sorted((c.source, c.relevant) for c in out["one-0"].context) == [("one0.md", True), ("one5.md", False)] and out["one-0"].tags == ["t", "seed", "distractor"]
    broken = seeds(spark).withColumn("sources", F.array(F.lit("gone.md#X")))
    with pytest.raises(Exception, match="no section for gone.md#X"):
        compose.seed_examples(broken, index(spark)).collect()


def test_build_writes_what_it_kept_and_what_not(spark, tmp_path):
    bad = seeds(spark).where("id = 'one-1'").withColumns({"id": F.lit("one-bad"), "answer": F.lit("It reads `UnknownThing` somewhere, without saying where.")})
    cfg = build.BuildConfig(negatives_per_project=2)
    placed, rejected = build.build_dataset(seeds(spark).union(bad.select(seeds(spark).columns)), index(spark), cfg)
    build.write_build(placed, rejected, str(tmp_path), revision="abc", version=2)
    facts = json.loads((tmp_path / "manifest.json").read_text())
    assert facts["revision"] == "abc" and facts["rejected"] == rejected.count() >= 1 and sum(facts["splits"].values()) == placed.count()
    assert {p.name for p in (tmp_path / "splits").iterdir() if p.is_dir()} == {f"split={s}" for s in facts["splits"]}
    assert "one-bad" in {r.id for r in spark.read.json(str(tmp_path / "rejects")).collect()}
    card = json.loads((tmp_path / "dataset_card.json").read_text())
    assert {(r["split"], r["n"]) for r in card if r["facet"] == "all"} == set(facts["splits"].items())
    rows = placed.select(*build.EXAMPLE_COLUMNS).unionByName(rejected.select(*build.EXAMPLE_COLUMNS)).withColumn("ord", F.lit(0).cast("long"))
    judged = build.validate(rows, passing=str(tmp_path / "passing"))
    assert judged.where("not ok").count() == rejected.count() and spark.read.json(str(tmp_path / "passing")).count() == placed.count()


def test_benchmarks(spark):
    own = compose.seed_examples(seeds(spark), index(spark))
    noisy = build.noise_benchmark(own, index(spark), spark.createDataFrame([("two",)], "project string")).collect()
    assert len(noisy) == 6 and all(sum(not c.relevant for c in r.context) == 4 and r.id.startswith("noise-") for r in noisy)
    assert all(("heldout" in r.tags) == (r.project == "two") and "benchmark" in r.tags and "distractor" not in r.tags for r in noisy)
    made, short = build.unanswerable_benchmark(index(spark), 7)
    assert {r.wanted for r in short.collect()} == {8} and all("benchmark" in r.tags for r in made.collect())
    bugs = {r.id: r for r in build.bug_benchmark(seeds(spark).withColumn("heldout", F.col("project") == "one"), index(spark)).collect()}
    assert bugs["one-1"].answerable == "partial" and "heldout" in bugs["one-1"].tags and "heldout" not in bugs["two-1"].tags


def test_suites_are_scored_written_and_reused(spark, tmp_path):
    row = {"id": "a", "question": "Which key does it read?", "context": [{"source": "s.md", "heading": "H", "content": "It reads key_one."}], "answer": "It reads `key_one` [s.md — H].", "category": "api", "answerable": "full"}
    (tmp_path / "suite.jsonl").write_text("\n".join(json.dumps({**row, "id": i}) for i in "abc"))
    (tmp_path / "predictions.jsonl").write_text("\n".join(json.dumps({"suite": "suite.jsonl", "id": i, "prediction": p}) for i, p in (("a", "wrong"), ("a", row["answer"]), ("b", None), ("x", "y"))))
    rows = evaluation.load_suite(spark, "suite.jsonl", str(tmp_path))
    assert [r.id for r in evaluation.load_suite(spark, "suite.jsonl", str(tmp_path), limit=2).collect()] == ["a", "b"]
    scored = evaluation.evaluate(rows, evaluation.read_predictions(spark, str(tmp_path / "predictions.jsonl")))
    got = {r.id: r for r in scored.collect()}
    assert set(got) == {"a", "b"} and got["a"].answer_correctness == 1.0 and got["b"].empty
    (head,) = evaluation.headline(evaluation.suite_summaries(scored)).collect()
    assert head.suite == "suite.jsonl" and head.answer_correctness == 0.5
    assert evaluation.headline(evaluation.suite_summaries(scored).drop("conciseness")).first().conciseness is None
    evaluation.write_results(scored, str(tmp_path / "out"), revision="abc", platform=None)
    again = evaluation.reuse_results(spark, str(tmp_path / "out"), ["suite.jsonl"]).first()
    assert again.n == 2 and again.provenance.revision == "abc"
    with pytest.raises(Exception, match="no stored result for suite other"):
        evaluation.reuse_results(spark, str(tmp_path / "out"), ["other"]).collect()


def test_ledger(spark, tmp_path):
    say = lambda t: spark.createDataFrame([(t,)], "t string").select(ledger.quota_signal(F.col("t")).alias("q"), ledger.telling_lines(F.col("t")).alias("l")).first()
    assert not say("The gateway applies a rate limit per client; quota is in config.").q and not say(None).q
    assert say("text\nERROR: Rate limit exceeded\nERROR: Rate limit exceeded").l == "ERROR: Rate limit exceeded" and not say("quota exceeded" + "x" * 3000).q
    folder = str(tmp_path / "state")
    assert ledger.load_state(spark, folder).count() == 0
    save = lambda *rows: ledger.save_state(spark.createDataFrame(rows, "unit string, status string, accepted long, rejected long, from_cache boolean, at string").withColumn("updated_at", F.to_timestamp("at")), folder)
    save(("u1", "failed", 0, 0, False, "2025-01-01"), ("u2", "ok", 4, 1, True, "2025-01-01"), ("u3", "quota", 0, 0, False, "2025-01-01"))
    save(("u1", "ok", 5, 0, False, "2025-01-02"))
    state = ledger.load_state(spark, folder)
    assert {r.unit: r.status for r in state.collect()} == {"u1": "ok", "u2": "ok", "u3": "quota"} and ledger.load_state(spark, folder, resume=False).count() == 0
    r = ledger.run_counters(spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u4",)], "unit string"), state).first()
    assert (r.planned, r.done, r.calls, r.hits, r.accepted, r.rejected, r.failures, r.stopped, r.left) == (4, 2, 1, 1, 9, 1, 0, 1, 2)
    ledger.put_responses(spark.createDataFrame([("k", "[]", "ok", 1)], "cache_key string, response string, status string, request_id long").withColumn("received_at", F.current_timestamp()), str(tmp_path / "cache"))
    hit = ledger.look_up(spark.createDataFrame([("k",), ("m",)], "cache_key string"), spark.read.parquet(str(tmp_path / "cache")))
    assert {r.cache_key: r.hit for r in hit.collect()} == {"k": True, "m": False}


def test_chats_are_read_with_all_fields(spark, tmp_path):
    message = '<doc id="D1" source="a - b" date="2024-01-01">text</doc>\n\nQUESTION: why?'
    chat = {"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": message}, {"role": "assistant", "content": "old"}], "meta": {"id": "r", "domain": "net", "context_style": "xml", "traits": ["gap"]}}
    (tmp_path / "chats.jsonl").write_text(json.dumps(chat) + "\n")
    (tmp_path / "patch.json").write_text(json.dumps({"examples": [{"id": "r", "answer": "because [D1]"}, {"id": "z", "answer": "x"}]}))
    chats, patches = files.read_chats(spark, str(tmp_path / "chats.jsonl")), files.read_patches(spark, str(tmp_path / "patch.json"))
    r = parsing.import_chats(chats, patches).first()
    assert (r.project, r.difficulty, r.origin, r.tags, r.relevant_sources) == ("rag-net", "medium", "structured_response", ["structured-layout", "gap"], ["a / b#D1 · 2024-01-01"])
    assert [x.id for x in parsing.unused_patches(chats, patches).collect()] == ["z"]


def test_contexts_configs_and_staging(spark, tmp_path):
    chunk = {"source": "s", "heading": "h", "content": "c"}
    for name, data in {"a.jsonl": json.dumps({"context": [chunk]}) + "\n" + json.dumps({"context": []}), "b.json": json.dumps([chunk]), "c.json": json.dumps({"context": [chunk]})}.items():
        (tmp_path / name).write_text(data)
        assert [tuple(r) for r in files.read_context(spark, str(tmp_path / name)).collect()] == [("s", "h", "c")]
    docs = tmp_path / "service a" / "docs"
    docs.mkdir(parents=True)
    (docs / "x.md").write_text("# T\n" + "y" * 90 + "\n## U\n" + "z" * 90)
    (tmp_path / "small").mkdir()
    (tmp_path / "small" / "x.md").write_text("short")
    assert [r.heading for r in files.read_context(spark, str(docs)).collect()] == ["T", "U"] and files.read_context(spark, str(docs / "x.md")).count() == 2
    for spec, error in ((str(tmp_path / "none"), FileNotFoundError), (str(tmp_path / "x.csv"), (ValueError, FileNotFoundError))):
        with pytest.raises(error):
            files.read_context(spark, spec)
    staged = {r.project: r for r in files.stage_corpus(spark, [str(docs), str(tmp_path / "small")], 2, str(tmp_path / "out")).collect()}
    assert staged["service-a"].staged and not staged["small"].staged and (staged[None].n_files, staged[None].n_sections) == (1, 2)
    assert {r.project for r in spark.read.parquet(str(tmp_path / "out" / "files")).collect()} == {"service-a"}
    (tmp_path / "split.yaml").write_text("train: 0.7\ngroup_by: document\n")
    assert files.read_config(str(tmp_path / "split.yaml"), split.SplitConfig) == split.SplitConfig(train=0.7, group_by="document")
    for text in ("nope: 1", "seed: text"):
        (tmp_path / "bad.yaml").write_text(text)
        with pytest.raises(ValueError):
            files.read_config(str(tmp_path / "bad.yaml"), split.SplitConfig)


def test_lines_are_numbered_across_parts_of_a_file(spark, tmp_path):
    lines = [json.dumps({"id": f"r{k}", "answer": "x" * (k % 50)}) if k % 7 else "" for k in range(400)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl").write_text("\n".join(lines[:5] + ["{broken"]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = {(r.file.rsplit("/", 1)[-1], r.ord): r.line for r in files.read_lines(spark, str(tmp_path)).collect()}
        report = {r.file.rsplit("/", 1)[-1]: r for r in files.read_report(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {**{("a.jsonl", k + 1): x for k, x in enumerate(lines) if x}, **{("b.jsonl", k + 1): x for k, x in enumerate(lines[:5] + ["{broken"]) if x}}
    assert report["b.jsonl"].n_bad == 1 and report["b.jsonl"].n_invalid == 4


def test_written_tables_can_be_discarded(spark):
    df = written(spark.range(3), "gone")
    path = df._written_path
    assert spark.read.parquet(path).count() == 3
    discard(df)
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(path)
