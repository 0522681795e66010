"""The deterministic scorer of predictions against examples, and its aggregates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators.examples import keyed
from millrace.operators.gate import facts

MEANS = ("answer_correctness", "token_f1", "key_fact_recall", "groundedness", "lexical_groundedness", "citation_precision", "citation_recall", "citation_f1", "relevant_source_usage", "conciseness", "length_ratio")
RATES = ("refusal_correct", "false_refusal", "hallucinated", "empty")
# Metrics of which less is better.
LOWER_IS_BETTER = ("false_refusal_rate", "hallucinated_rate", "empty_rate", "length_ratio", "distractor_citations_per_answer")


@dataclass(frozen=True)
class ScoreConfig:
    identifier_budget_none: int = 3
    conciseness_ratio: float = 1.5
    useful_recall: float = 0.5
    useful_f1: float = 0.2
    #: Rows without answerability count as 'full' everywhere; True keeps them out of the slices and on the unanswerable side of the matrix, although refusals are judged as for 'full'.
    strict_parity: bool = False


def join_predictions(examples: DataFrame, predictions: DataFrame) -> DataFrame:
    """Examples with their prediction, by id; the latest prediction of an id (greatest `ord`) counts, those of unknown ids fall away."""
    last = predictions.where("id is not null").groupBy("id").agg(F.max_by("prediction", "ord").alias("prediction"))
    return examples.join(last, "id")


def unmatched_predictions(examples: DataFrame, predictions: DataFrame) -> DataFrame:
    return predictions.select("id").distinct().join(examples.select("id"), "id", "left_anti")


def score(rows: DataFrame, cfg: ScoreConfig = ScoreConfig(), keep: tuple[str, ...] = ()) -> DataFrame:
    """One row of metrics per example with a `prediction`, and the columns named in keep. No shuffle. Null predictions are empty."""
    empty = F.array().cast("array<string>")
    col = F.col
    gold = rows.withColumns({c: F.coalesce(c, empty) for c in ("tags", "must_not_include", "must_include", "facts")})
    gold = keyed(gold).withColumns({"gold_words": X.content_words("answer"), "gold_count": X.word_count("answer"), "label": F.coalesce("answerable", F.lit("full")), "key_facts": F.when(F.size("must_include") > 0, col("must_include")).otherwise(col("facts"))})
    df = facts(gold.withColumn("answer", X.stripped("prediction")))
    size, distinct = F.size, F.array_distinct
    df = df.withColumns(
        {
            "f1": X.token_f1(col("answer_words"), col("gold_words")),
            "recall": X.phrase_recall(col("answer_norm"), col("key_facts")),
            "refused": X.declines(col("answer_norm")),
            "opening": X.normalised(X.first_sentence("answer")),
            "fabricated": X.among(col("cite_keys"), col("context_sources"), wanted=False, part="source"),
            "misattributed": X.among(X.among(col("cite_keys"), col("context_sources"), part="source"), col("context_keys"), wanted=False),
            "resolved": F.array_intersect("cite_keys", "context_keys"),
            "cited": distinct("cite_keys"),
            "words": X.word_count("answer"),
            "forbidden": X.containing(col("must_not_include"), col("answer_norm")),
        }
    )
    refused, none, full = col("refused"), col("label") == "none", col("label") == "full"
    if_none_cited = F.when(refused, 1.0).otherwise(0.0)
    has_facts = size("key_facts") > 0
    gold_cited = size(F.array_intersect("resolved", "gold_keys"))
    df = df.withColumns(
        {
            "precision": F.when(size("cited") > 0, size("resolved") / size("cited")).otherwise(if_none_cited),
            "gold_recall": X.share(gold_cited, size("gold_keys"), 1.0),
            "usage": F.when(size("resolved") > 0, gold_cited / size("resolved")).otherwise(if_none_cited),
            "wholesale_refusal": refused & ~(has_facts & (col("recall") >= 0.5)) & (X.declines(col("opening")) | (size("resolved") == 0)),
            "ratio": col("words") / F.greatest("gold_count", F.lit(1)),
        }
    )
    answerable = F.when(F.lit(cfg.strict_parity) & col("answerable").isNull(), F.lit("unset")).otherwise(col("label"))
    budget = F.when(none, cfg.identifier_budget_none).otherwise(0)
    as_text = lambda c: F.concat(c["source"], F.lit(" — "), c["heading"])
    r4 = lambda c: F.round(c, 4)
    out = df.select(
        *keep,
        "id",
        "project",
        "category",
        answerable.alias("answerable"),
        "tags",
        (col("answer") == "").alias("empty"),
        r4(F.when(has_facts, 0.5 * col("f1") + 0.5 * col("recall")).otherwise(col("f1"))).alias("answer_correctness"),
        r4(col("f1")).alias("token_f1"),
        r4(col("recall")).alias("key_fact_recall"),
        has_facts.alias("has_key_facts"),
        r4(col("technical_share")).alias("groundedness"),
        r4(col("lexical_share")).alias("lexical_groundedness"),
        col("unsupported").alias("unsupported_identifiers"),
        r4(col("precision")).alias("citation_precision"),
        r4(col("gold_recall")).alias("citation_recall"),
        r4(X.share(2 * col("precision") * col("gold_recall"), col("precision") + col("gold_recall"), 0.0)).alias("citation_f1"),
        F.transform("fabricated", as_text).alias("fabricated_citations"),
        F.transform("misattributed", as_text).alias("misattributed_citations"),
        "refused",
        "wholesale_refusal",
        F.when(full, ~col("wholesale_refusal")).otherwise(refused).alias("refusal_correct"),
        (full & col("wholesale_refusal")).alias("false_refusal"),
        ((size("fabricated") > 0) | (size("misattributed") > 0) | (size("forbidden") > 0) | (size("unsupported") > budget) | (none & ~refused)).alias("hallucinated"),
        col("forbidden").alias("forbidden_facts"),
        r4(col("usage")).alias("relevant_source_usage"),
        size(F.array_intersect("cited", "distractor_keys")).alias("distractor_citations"),
        r4(F.when(col("ratio") <= cfg.conciseness_ratio, 1.0).otherwise(cfg.conciseness_ratio / col("ratio"))).alias("conciseness"),
        F.round("ratio", 3).alias("length_ratio"),
        "words",
    )
    on_target = (col("token_f1") >= cfg.useful_f1) | (col("has_key_facts") & (col("key_fact_recall") >= cfg.useful_recall))
    useful = col("answerable").isin("full", "partial") & ~col("wholesale_refusal") & ~col("hallucinated") & ~col("empty") & (col("citation_precision") > 0) & on_target
    return out.withColumn("useful", useful)


def _mean(c: str) -> Column:
    """Mean of a metric of four decimals, to four decimals. Summed as whole ten-thousandths, so the result doesn't depend on the order of rows."""
    return F.round(F.try_divide(F.sum(F.round(F.col(c) * 10000).cast("bigint")), F.count(c))) / 10000


def _rate(flag: Column, among: Column | None = None) -> Column:
    number = flag.cast("double")
    return F.round(F.avg(F.when(among, number) if among is not None else number), 4)


def summary_columns() -> list[Column]:
    """Aggregates over score() rows: means of the rounded metrics, rates, and the rates on the slices, null where a slice is empty."""
    col = F.col
    none, full = col("answerable") == "none", col("answerable") == "full"
    return [
        F.count("*").alias("n"),
        *[_mean(m).alias(m) for m in MEANS],
        *[_rate(col(r)).alias(f"{r}_rate") for r in RATES],
        F.round(F.avg("distractor_citations"), 4).alias("distractor_citations_per_answer"),
        _rate(col("hallucinated"), none).alias("hallucination_rate_unanswerable"),
        _rate(col("refusal_correct"), none).alias("refusal_rate_unanswerable"),
        _rate(col("false_refusal"), full).alias("false_refusal_rate_answerable"),
        F.round(F.try_divide(F.count_if(col("useful")), F.count_if(col("answerable").isin("full", "partial"))), 4).alias("useful_answer_rate"),
    ]


def summarise(scored: DataFrame) -> DataFrame:
    """One row; counts 0 and nulls over no rows."""
    return scored.agg(*summary_columns())


def summarise_by_slice(scored: DataFrame) -> DataFrame:
    """Overall, by category and by answerability in one pass: slice, value (null values show as 'None'), metrics."""
    named = scored.withColumns({c: F.coalesce(c, F.lit("None")) for c in ("category", "answerable")}).withColumns({"by_category": F.col("category"), "by_answerable": F.col("answerable")})
    sets = named.groupingSets([[], ["by_category"], ["by_answerable"]], "by_category", "by_answerable").agg(F.grouping("by_category").alias("gc"), F.grouping("by_answerable").alias("ga"), *summary_columns())
    slice_ = F.when(F.col("gc") == 0, "category").when(F.col("ga") == 0, "answerable").otherwise("all")
    return sets.withColumns({"slice": slice_, "value": F.coalesce("by_category", "by_answerable", F.lit(""))}).drop("by_category", "by_answerable", "gc", "ga")


def confusion_columns() -> list[Column]:
    """Matrix of answerable against refused, for rows with answerable and wholesale_refusal."""
    able, refused = F.coalesce(F.col("answerable").isin("full", "partial"), F.lit(False)), F.coalesce("wholesale_refusal", F.lit(False))
    return [
        F.count_if(able & ~refused).alias("true_positive"),
        F.count_if(able & refused).alias("false_negative"),
        F.count_if(~able & ~refused).alias("false_positive"),
        F.count_if(~able & refused).alias("true_negative"),
    ]


def confusion(scored: DataFrame) -> DataFrame:
    """One row: the four counts and the ratios derived from them, null where a denominator is 0."""
    tp, fn, fp, tn = (F.col(c) for c in ("true_positive", "false_negative", "false_positive", "true_negative"))
    ratio = lambda a, b: F.round(F.try_divide(a, b), 4)
    return scored.agg(*confusion_columns()).withColumns(
        {
            "n_answerable": tp + fn,
            "n_unanswerable": fp + tn,
            "answer_precision": ratio(tp, tp + fp),
            "answer_recall": ratio(tp, tp + fn),
            "refusal_precision": ratio(tn, tn + fn),
            "refusal_recall": ratio(tn, tn + fp),
            "hallucination_rate": ratio(fp, fp + tn),
            "incorrect_refusal_rate": ratio(fn, tp + fn),
            "correct_refusal_rate": ratio(tn, fp + tn),
        }
    )


def compare(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Metric by metric: slice, value, metric, base, tuned, delta, improved. Both are outputs of summarise_by_slice."""
    metrics = [*MEANS, *[f"{r}_rate" for r in RATES], "distractor_citations_per_answer"]
    long = lambda df, name: df.unpivot(["slice", "value"], metrics, "metric", name)
    delta = F.round(F.col("tuned") - F.col("base"), 4)
    better = F.when(F.col("metric").isin(*LOWER_IS_BETTER), delta < 0).otherwise(delta > 0)
    return long(base, "base").join(long(tuned, "tuned"), ["slice", "value", "metric"]).select("slice", "value", "metric", "base", "tuned", delta.alias("delta"), better.alias("improved"))
