"""Exact, near and same-subject duplicates among questions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.session import written

#: Rounds of the question dedup; a round decides the next row of every set of sources, so this many means that something is wrong.
MAX_ROUNDS = 200
REASONS = ("empty_question", "duplicate_question", "near_duplicate", "same_subject", "context_limit")


@dataclass(frozen=True)
class DedupConfig:
    similarity: float = 0.82
    per_context: int = 6


def signature(context: str = "context") -> Column:
    """The example's sources as one string: sorted distinct `source#heading`."""
    key = lambda c: F.concat(X.stripped(c["source"]), F.lit("#"), X.stripped(c["heading"]))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(context, key))), "\n")


def exact_dedup(examples: DataFrame, *order: str) -> DataFrame:
    """Keeps the first row, in `order` (`ord` where none is given), of every (question, answer, sources), case and outer white space aside."""
    same = [F.lower(X.stripped("question")), F.lower(X.stripped("answer")), signature()]
    return examples.withColumn("_n", F.row_number().over(Window.partitionBy(F.sha2(F.concat_ws("\u0001", *same), 256)).orderBy(*(order or ("ord",))))).where("_n = 1").drop("_n")


def keep_first(rows: DataFrame, key: list[Column | str], order: list[Column | str]) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def _questions(examples: DataFrame) -> DataFrame:
    """What the decision needs of every row: at (its place in the order), tokens, and fingerprints q of the question, s of its sources, t of subject, sources and label (null without a subject)."""
    words = X.question_words("question")
    subject = F.array_sort(F.array_distinct(F.transform(X.technical_words("question"), F.lower)))
    rows = examples.select("id", "ord", words.alias("tokens"), F.array_join(words, " ").alias("norm"), signature().alias("signature"), subject.alias("subject"), F.coalesce("category", F.lit("")).alias("category"), F.coalesce("answerable", F.lit("")).alias("answerable"))
    about = F.when(F.size("subject") > 0, F.xxhash64("signature", F.array_join("subject", "\n"), "category", "answerable"))
    keyed = rows.select("id", "ord", F.struct("ord", "id").alias("at"), "tokens", F.xxhash64(F.lit("q"), "norm").alias("q"), F.xxhash64(F.lit("s"), "signature").alias("s"), about.alias("t"))
    return keyed.dropDuplicates(["id", "ord"])


def _kept(rows: DataFrame, cfg: DedupConfig) -> DataFrame:
    """The rows that the first-come decision keeps.

    A row can be kept at once if no undecided row comes before it, neither with its sources nor with its question.
    All such rows are kept in one round; then the undecided rows that they rule out are dropped: those with their
    question anywhere, and with their sources those that are alike, have the subject, or find the context full. The
    first undecided row of all always qualifies, so every round gets on; a set of sources takes part in few of them,
    because it keeps few rows. Every step is a grouped minimum or a join, no group is collected.
    """
    left = rows.withColumn("n", F.lit(0))
    kept = []
    for _ in range(MAX_ROUNDS):
        first = {c: left.groupBy(c).agg(F.min("at").alias(f"first_{c}")) for c in ("s", "q")}
        new = left.join(first["s"], "s").join(first["q"], "q").where((F.col("at") == F.col("first_s")) & (F.col("at") == F.col("first_q"))).select("id", "ord", "at", "tokens", "q", "s", "t")
        kept.append(written(new, "questions-kept"))
        by_source = kept[-1].select("s", F.col("at").alias("k_at"), F.col("tokens").alias("k_tokens"), F.col("t").alias("k_t"))
        free = F.col("k_at").isNull() | ((X.jaccard(F.col("tokens"), F.col("k_tokens")) < cfg.similarity) & ~F.coalesce(F.col("t") == F.col("k_t"), F.lit(False)) & ((F.col("n") + 1 < cfg.per_context) if cfg.per_context else F.lit(True)))
        rest = left.join(kept[-1].select("q"), "q", "left_anti").join(by_source, "s", "left").where(free)
        left = written(rest.select("id", "ord", "at", "tokens", "q", "s", "t", (F.col("n") + F.col("k_at").isNotNull().cast("int")).alias("n")), "questions-left")
        if left.isEmpty():
            break
    else:
        raise RuntimeError(f"questions were not decided in {MAX_ROUNDS} rounds")
    out = kept[0]
    for more in kept[1:]:
        out = out.union(more)
    return out


def question_dedup(examples: DataFrame, cfg: DedupConfig = DedupConfig()) -> DataFrame:
    """id, ord, reason (null for kept rows), duplicate_of, similarity: the first-come decision over rows in order of (ord, id).

    A row is dropped for a question without content, a question kept before anywhere, a question like one kept
    before over the same sources, a subject kept before over the same sources, category and answerability, or a
    full context; the first of these that holds is the reason. Rows of the same id and ord count once.
    """
    rows = written(_questions(examples), "question-rows")
    asked = rows.where(F.size("tokens") > 0)
    kept = written(_kept(asked, cfg), "questions-decided")
    dropped = asked.join(kept.select("id", "ord"), ["id", "ord"], "left_anti")
    same = kept.select("q", F.col("at").alias("e_at"))
    near = kept.select("s", F.col("at").alias("k_at"), F.col("tokens").alias("k_tokens"), F.col("t").alias("k_t"))
    like = F.when(F.col("k_at") < F.col("at"), X.jaccard(F.col("tokens"), F.col("k_tokens")))
    met = dropped.join(same, "q", "left").join(near, "s", "left").withColumn("like", like)
    told = met.groupBy("id", "ord").agg(
        F.first(F.when(F.col("e_at") < F.col("at"), F.col("e_at.id"))).alias("exact"),
        F.min(F.when(F.col("like") >= cfg.similarity, F.col("k_at"))).alias("alike"),
        F.max("like").alias("most"),
        F.min(F.when((F.col("t") == F.col("k_t")) & F.col("like").isNotNull(), F.col("k_at"))).alias("subject"),
    )
    is_exact, is_like, is_subject = (F.col(c).isNotNull() for c in ("exact", "alike", "subject"))
    none = F.lit(None).cast("string")
    reason = F.when(is_exact, REASONS[1]).when(is_like, REASONS[2]).when(is_subject, REASONS[3]).otherwise(REASONS[4])
    of = F.when(is_exact, F.col("exact")).when(is_like, F.col("alike.id")).when(is_subject, F.col("subject.id"))
    out = told.select("id", "ord", reason.alias("reason"), of.alias("duplicate_of"), F.when(~is_exact & is_like, F.round("most", 3)).alias("similarity"))
    blank = rows.where(F.size("tokens") == 0).select("id", "ord", F.lit(REASONS[0]).alias("reason"), none.alias("duplicate_of"), F.lit(None).cast("double").alias("similarity"))
    return kept.select("id", "ord", none.alias("reason"), none.alias("duplicate_of"), F.lit(None).cast("double").alias("similarity")).union(out).union(blank)


def drop_histogram(decided: DataFrame) -> DataFrame:
    return decided.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
