"""Evaluation of suites: which rows, which predictions, what comes out, and what is reused."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.score import ScoreConfig, confusion_columns, join_predictions, score, summary_columns
from millrace.sources import files

# The named suites and their files, and the metrics of the headline table.
SUITES = {
    "test": "data/test/test.jsonl",
    "validation": "data/validation/validation.jsonl",
    "hallucination": "benchmarks/hallucination.jsonl",
    "retrieval_noise": "benchmarks/retrieval_noise.jsonl",
    "bug_investigation": "benchmarks/bug_investigation.jsonl",
}
HEADLINE = ("answer_correctness", "groundedness", "citation_f1", "refusal_correct_rate", "hallucinated_rate", "relevant_source_usage", "conciseness")
RESULTS, PREDICTIONS = "results", "predictions"


def load_suite(spark: SparkSession, name: str, root: str = ".", limit: int | None = None) -> DataFrame:
    """Rows of a named suite, or of a file, with `suite`; the first `limit` in the file's order where it is set."""
    rows = files.read_examples(spark, str(files.resolve_path(SUITES.get(name, name), root))).withColumn("suite", F.lit(name))
    return rows.orderBy("file", "ord").limit(limit) if limit else rows


def evaluate(examples: DataFrame, predictions: DataFrame, cfg: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Scored rows with `suite` of examples (with suite) and predictions (suite, id, prediction, ord); of several predictions of an id in a suite the last counts, unknown ids fall away."""
    key = F.concat_ws("\u0001", "suite", "id")
    rows = join_predictions(examples.withColumns({"_id": F.col("id"), "id": key}), predictions.select(key.alias("id"), "prediction", "ord"))
    return score(rows.withColumn("id", F.col("_id")), cfg, keep=("suite", "prediction", "question"))


def suite_summaries(scored: DataFrame) -> DataFrame:
    """One row of means, rates and confusion counts per suite."""
    return scored.groupBy("suite").agg(*summary_columns(), *confusion_columns())


def headline(summaries: DataFrame) -> DataFrame:
    """The headline metrics per suite; one that a summary lacks is null."""
    return summaries.select("suite", *[F.col(m) if m in summaries.columns else F.lit(None).cast("double").alias(m) for m in HEADLINE])


def provenance(rows: DataFrame, **facts: str | None) -> DataFrame:
    """rows with a struct of what the job says about itself: revision, platform, time, provider. The job passes the facts, so queries stay deterministic."""
    return rows.withColumn("provenance", F.struct(*[F.lit(v).cast("string").alias(k) for k, v in sorted(facts.items())]))


def write_results(scored: DataFrame, folder: str, **facts: str | None) -> None:
    """Summaries with provenance, and predictions with question and prediction, as JSON Lines under folder/results and folder/predictions."""
    provenance(suite_summaries(scored), **facts).write.mode("overwrite").json(f"{folder}/{RESULTS}")
    scored.select("suite", "id", "question", "prediction").write.mode("overwrite").partitionBy("suite").json(f"{folder}/{PREDICTIONS}")


def reuse_results(spark: SparkSession, folder: str, suites: list[str]) -> DataFrame:
    """Summaries of an earlier run for the suites named; a suite that it lacks is an error when the query runs."""
    wanted = spark.createDataFrame([(s,) for s in suites], "suite string")
    found = wanted.join(spark.read.json(f"{folder}/{RESULTS}").withColumn("_found", F.lit(True)), "suite", "left")
    lacks = F.raise_error(F.concat(F.lit("no stored result for suite "), "suite")).cast("string")
    return found.withColumn("suite", F.when(F.col("_found"), F.col("suite")).otherwise(lacks)).drop("_found")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """suite, id, prediction, ord of stored predictions; ord is the place in the file."""
    rows = files.read_jsonl(spark, path, "suite string, id string, prediction string")
    return rows.select("suite", "id", "prediction", "ord")


def write_comparison(compared: DataFrame, path: str) -> None:
    """The table of a comparison (score.compare) as one JSON document: slice, value, metric, base, tuned, delta. It has a row per metric and slice, whatever the data's size."""
    rows = [r.asDict() for r in compared.orderBy("slice", "value", "metric").collect()]
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(rows, ensure_ascii=False, indent=1), encoding="utf-8")
