"""Datasets from start to end: compose, gate, dedup, split, write; benchmarks, and validation of what was written."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import cards, compose, dedup, split
from millrace.operators.examples import derived
from millrace.operators.gate import GateConfig, gate_batch
from millrace.session import written

EXAMPLE_COLUMNS = ("id", "question", "context", "answer", "category", "difficulty", "answerable", "project", "relevant_sources", "must_include", "must_not_include", "facts", "tags", "origin")


@dataclass(frozen=True)
class BuildConfig:
    negatives_per_project: int = 15
    variants: bool = True
    gate: GateConfig = GateConfig()
    split: split.SplitConfig = split.SplitConfig()


def _aligned(rows: DataFrame) -> DataFrame:
    """The example columns, in one type; what a source doesn't have is null."""
    chunk = "array<struct<source:string,heading:string,content:string,relevant:boolean>>"
    lists = {"relevant_sources", "must_include", "must_not_include", "facts", "tags"}
    kind = lambda c: chunk if c == "context" else "array<string>" if c in lists else "string"
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind(c)).alias(c) for c in EXAMPLE_COLUMNS])


def composed(seeds: DataFrame, index: DataFrame, cfg: BuildConfig = BuildConfig()) -> DataFrame:
    """Seeds resolved against the index, their variants with distractors, and negatives, with `ord` by kind and id."""
    own = written(_aligned(compose.seed_examples(seeds, index)), "seed-examples")
    parts = [own]
    if cfg.variants:
        parts.append(_aligned(compose.variants(own, index)))
    parts.append(_aligned(compose.negatives(index, cfg.negatives_per_project)))
    out = None
    for k, part in enumerate(parts):
        ranked = part.withColumn("ord", F.lit(k).cast("long"))
        out = ranked if out is None else out.unionByName(ranked)
    return out


def gated(rows: DataFrame, cfg: BuildConfig = BuildConfig()) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) rows with issues and metrics, worked out once. Expects `ord`."""
    known = rows.columns
    shaped = derived(rows.withColumns({c: F.lit(None).cast(t) for c, t in (("source_count", "int"), ("contains_code", "boolean")) if c not in known}))
    judged = written(gate_batch(shaped, cfg.gate), "gated")
    return judged.where("ok"), judged.where("not ok")


def build_dataset(seeds: DataFrame, index: DataFrame, cfg: BuildConfig = BuildConfig()) -> tuple[DataFrame, DataFrame]:
    """(placed, rejected): the examples that pass the gate, split without leakage, and those that don't, with their issues."""
    kept, rejected = gated(composed(seeds, index, cfg), cfg)
    return split.split_examples(kept.drop("issues", "ok"), cfg.split), rejected


def write_json(table: DataFrame | dict, path: str) -> None:
    """A small table (a card, a manifest) as one JSON document."""
    data = table if isinstance(table, dict) else [r.asDict(recursive=True) for r in table.collect()]
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(data, ensure_ascii=False, indent=1, default=str), encoding="utf-8")


def write_build(placed: DataFrame, rejected: DataFrame, folder: str, decided: DataFrame | None = None, **manifest: str | int) -> None:
    """Writes folder/splits (JSON Lines, one part per split), rejects (id, issues), duplicates and their reasons where given, dataset_card.json and manifest.json.

    manifest: facts of the job, such as its time and revision, that go into the manifest beside the counts.
    """
    placed.write.mode("overwrite").option("ignoreNullFields", "true").partitionBy("split").json(f"{folder}/splits")
    rejected.select("id", "issues").write.mode("overwrite").json(f"{folder}/rejects")
    counts = {r["split"]: r["n"] for r in placed.groupBy("split").agg(F.count("*").alias("n")).collect()}
    facts = {**manifest, "splits": counts, "rejected": rejected.count()}
    if decided is not None:
        dropped = decided.where("reason is not null")
        dropped.write.mode("overwrite").json(f"{folder}/duplicates")
        facts["duplicates"] = {r["reason"]: r["n"] for r in dedup.drop_histogram(decided).collect()}
    write_json(cards.split_card(placed), f"{folder}/dataset_card.json")
    write_json(facts, f"{folder}/manifest.json")


def validate(rows: DataFrame, passing: str | None = None, cfg: GateConfig = GateConfig()) -> DataFrame:
    """Issue codes per row as in gate_batch; where `passing` names a folder, the rows without issues are written there as JSON Lines. Expects `ord`."""
    kept, rejected = gated(rows, BuildConfig(gate=cfg))
    if passing:
        kept.select(*[c for c in rows.columns if c != "ord"]).write.mode("overwrite").option("ignoreNullFields", "true").json(passing)
    return kept.unionByName(rejected)


def noise_benchmark(seeds: DataFrame, index: DataFrame, held_out: DataFrame, n: int = 4, seed: int = 101) -> DataFrame:
    """Answerable examples with exactly n sections of other projects mixed in, tagged by whether their project (held_out: project) is held out."""
    own = seeds.where(~F.array_contains(F.coalesce("tags", F.array().cast("array<string>")), "distractor"))
    noisy = compose.variants(own, index, seed=seed, least=n, most=n).withColumn("_seed", F.regexp_replace("id", "-noise1$", ""))
    tag = F.when(F.col("_held"), "heldout").otherwise("in_domain")
    marked = noisy.join(held_out.select("project").distinct().withColumn("_held", F.lit(True)), "project", "left")
    tags = F.array_sort(F.array_union(F.array_except("tags", F.array(F.lit("distractor"), F.lit("augmented"))), F.array(F.lit("benchmark"), F.lit("retrieval_noise"), tag)))
    return marked.withColumns({"id": F.concat(F.lit("noise-"), "_seed"), "tags": tags}).drop("_seed", "_held")


def unanswerable_benchmark(index: DataFrame, target: int, seed: int = 99) -> tuple[DataFrame, DataFrame]:
    """(examples, shortfall per project): the target shared evenly among the projects, and 5 more each, from the held-back templates."""
    n = index.agg(F.count_distinct("project")).first()[0]
    per = -(-target // max(1, n)) + 5
    made = compose.negatives(index, per, which="eval", seed=seed)
    made = made.withColumns({"id": F.regexp_replace("id", "^neg-", "halluc-"), "tags": F.array_sort(F.array_union("tags", F.array(F.lit("benchmark"))))})
    return made, compose.shortfall(made, index, per)


def bug_benchmark(seeds: DataFrame, index: DataFrame) -> DataFrame:
    """Seeds of the bug suite as examples: answerable is partial where not given, those marked `heldout` are tagged."""
    base = compose.seed_examples(seeds.withColumn("answerable", F.coalesce("answerable", F.lit("partial"))), index)
    held = seeds.where("heldout").select("id").distinct().withColumn("_held", F.lit(True))
    tags = F.array_sort(F.array_union(F.array_except("tags", F.array(F.lit("seed"))), F.concat(F.array(F.lit("benchmark"), F.lit("bug_investigation")), F.when(F.col("_held"), F.array(F.lit("heldout"))).otherwise(F.array().cast("array<string>")))))
    return base.join(held, "id", "left").withColumns({"tags": tags, "origin": F.lit("benchmark")}).drop("_held")
