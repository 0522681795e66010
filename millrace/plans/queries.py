"""The query catalogue of the engine's own operators over the test tables, with whole tables and production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions.hashing import hash_order, uniform
from millrace.operators import build, cards, chunking, compose, dedup, evaluation, ledger, parsing, prompting, score, similarity, split
from millrace.operators.examples import keyed, project_name, shaped, value
from millrace.operators.gate import facts, gate, gate_batch, issue_histogram, listed_issues
from millrace.operators.gate import verdict as gate_verdict_of
from millrace.sources.files import project_label
from millrace.streaming.resume import status_by_window

_all: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _all[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_all)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _examples(spark: SparkSession, d: str) -> DataFrame:
    return shaped(_t(spark, d, "examples"))


def _ordered(spark: SparkSession, d: str) -> DataFrame:
    """Rows as sent, repeats included, with a stable order: time, id, and a number that keeps equal rows apart."""
    rows = _t(spark, d, "examples").withColumn("ord", F.unix_micros(F.coalesce(F.col("created_at"), F.lit("1970-01-01")).cast("timestamp")))
    return rows


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    """One row per chunk_id, the latest, with spelling-free project."""
    rows = _t(spark, d, "chunks").where("chunk_id is not null")
    one = dedup.keep_first(rows, ["chunk_id"], [F.col("loaded_at").desc_nulls_last()])
    return one.withColumns({"project": project_name("project"), "source": F.coalesce("source", F.lit("")), "heading": F.coalesce("heading", F.lit(""))})


def _index(spark: SparkSession, d: str) -> DataFrame:
    return chunking.section_index(_chunks(spark, d))


def _responses(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "response_cache").dropDuplicates(["request_id"]).withColumn("project", project_name("project"))


def _flat(c, sep: str = "|"):
    return F.array_join(F.array_sort(c), sep)


# text functions


@_query
def word_counts(spark, d):
    return _examples(spark, d).select("id", F.size(X.words("answer")).alias("n_words"), F.size(X.content_words("answer")).alias("n_content"), X.word_count("answer").alias("n_blank_words"), F.array_join(F.array_sort(F.array_distinct(X.content_words("question"))), " ").alias("question_words"))


@_query
def normalised_questions(spark, d):
    return _examples(spark, d).select("id", F.array_join(X.question_words("question"), " ").alias("norm"), F.md5(X.normalised("question")).alias("normal_md5"))


@_query
def identifiers(spark, d):
    return _examples(spark, d).select("id", _flat(X.identifiers("answer")).alias("identifiers"), _flat(X.technical_words("answer")).alias("technical"))


@_query
def citations(spark, d):
    return _examples(spark, d).select("id", F.posexplode(X.citations("answer")).alias("pos", "c")).select("id", "pos", "c.source", "c.heading")


@_query
def refusal_flags(spark, d):
    norm = X.normalised("answer")
    return _examples(spark, d).select("id", X.declines(norm).alias("declines"), X.names_conflict(norm).alias("names_conflict"))


@_query
def opening_sentences(spark, d):
    first = X.first_sentence("answer")
    return _examples(spark, d).select("id", first.alias("opening"), X.declines(X.normalised(first)).alias("opens_with_refusal"))


@_query
def grounding(spark, d):
    df = facts(keyed(_examples(spark, d)))
    return df.select("id", F.round("lexical_share", 4).alias("lexical_share"), F.round("technical_share", 4).alias("technical_share"), F.array_join("unsupported", "|").alias("unsupported"))


@_query
def pair_scores(spark, d):
    q, a = X.content_words("question"), X.content_words("answer")
    df = _examples(spark, d).select("id", q.alias("q"), a.alias("a"), X.normalised("answer").alias("n"), "must_include")
    return df.select("id", F.round(X.jaccard(F.col("q"), F.col("a")), 4).alias("jaccard"), F.round(X.token_f1(F.col("q"), F.col("a")), 4).alias("token_f1"), F.round(X.phrase_recall(F.col("n"), F.col("must_include")), 4).alias("recall"))


@_query
def stable_ids(spark, d):
    return _examples(spark, d).select("id", X.stable_id(F.concat(F.lit("gen-"), "project"), "question", "answer").alias("stable_id"), X.content_hash("answer").alias("answer_hash"), split.family().alias("family"), "source_count", "contains_code")


# shape, joins inside a row, prompts


@_query
def shaped_examples(spark, d):
    return _examples(spark, d).select("id", "category", "answerable", "difficulty", "project", "source_count", "contains_code", F.length("question").alias("question_chars"), F.length("answer").alias("answer_chars"))


@_query
def context_keys(spark, d):
    flat = lambda c: F.array_join(F.array_sort(F.transform(c, lambda k: F.concat(k["source"], F.lit("#"), k["heading"]))), "|")
    return keyed(_examples(spark, d)).select("id", flat("context_keys").alias("context_keys"), flat("gold_keys").alias("gold_keys"), flat("distractor_keys").alias("distractor_keys"), F.md5("context_text").alias("context_md5"))


@_query
def citation_roundtrip(spark, d):
    """Every citation resolved against its row's context: found, heading unknown, or source unknown."""
    df = facts(keyed(_examples(spark, d))).select("id", "context_keys", "context_sources", F.posexplode("cite_keys").alias("pos", "c"))
    state = F.when(F.array_contains("context_keys", F.col("c")), "found").when(F.array_contains("context_sources", F.col("c.source")), "heading").otherwise("source")
    return df.select("id", "pos", state.alias("state"))


@_query
def rendered_prompts(spark, d):
    return _examples(spark, d).select("id", F.md5(prompting.user_message(F.col("question"), F.col("context"))).alias("prompt_md5"), F.size(prompting.messages(F.col("question"), F.col("context"), F.col("answer"))).alias("n_messages"))


# gate


@_query
def gate_issues(spark, d):
    return listed_issues(gate(_examples(spark, d))).groupBy("id", "code").agg(F.count("*").alias("n"))


@_query
def gate_metrics(spark, d):
    return gate(_examples(spark, d)).select("id", "ok", "answer_context_ratio", "citation_count", "unsupported_identifiers", "groundedness", "technical_groundedness")


@_query
def gate_histogram(spark, d):
    return issue_histogram(gate(_examples(spark, d)), top=6)


@_query
def gate_verdict(spark, d):
    return gate_verdict_of(gate(_examples(spark, d)))


@_query
def gate_batch_rejects(spark, d):
    """The batch gate over rows as sent: repeats of an id are issues too."""
    rows = _ordered(spark, d).where("id is not null").withColumns({"question": X.stripped("question"), "answer": X.stripped("answer"), "answerable": value("answerable"), "project": project_name("project")})
    return gate_batch(rows).groupBy("id").agg(F.count("*").alias("n_rows"), F.count_if(F.exists("issues", lambda i: i["code"] == "duplicate_id")).alias("n_repeats"))


# scorer


def _predicted(spark, d, which: str) -> DataFrame:
    """Two stand-ins for stored predictions: the answer without its citations, and its first half by words."""
    bare = F.regexp_replace("answer", r"\s*\[[^\[\]\n]*\]", "")
    half = F.array_join(F.slice(F.split("answer", " "), F.lit(1), F.ceil(F.size(F.split("answer", " ")) / 2).cast("int")), " ")
    return _examples(spark, d).withColumn("prediction", {"bare": bare, "half": half, "gold": F.col("answer")}[which])


@_query
def scored_rows(spark, d):
    cols = ["id", "answer_correctness", "token_f1", "key_fact_recall", "groundedness", "lexical_groundedness", "citation_precision", "citation_recall", "citation_f1", "refused", "relevant_source_usage", "distractor_citations", "conciseness", "length_ratio", "words", "empty"]
    return score.score(_predicted(spark, d, "half")).select(*cols)


@_query
def score_flags(spark, d):
    return score.score(_predicted(spark, d, "half")).select("id", "wholesale_refusal", "refusal_correct", "false_refusal", "hallucinated", "useful", F.array_join("unsupported_identifiers", "|").alias("unsupported"), F.array_join("fabricated_citations", "|").alias("fabricated"))


@_query
def metric_by_slice(spark, d):
    return score.summarise_by_slice(score.score(_predicted(spark, d, "half")))


@_query
def metric_summary(spark, d):
    return score.summarise(score.score(_predicted(spark, d, "gold")))


@_query
def confusion_matrix(spark, d):
    return score.confusion(score.score(_predicted(spark, d, "half")))


@_query
def base_against_tuned(spark, d):
    return score.compare(score.summarise_by_slice(score.score(_predicted(spark, d, "half"))), score.summarise_by_slice(score.score(_predicted(spark, d, "bare"))))


@_query
def prediction_join(spark, d):
    """Stored predictions matched with examples: the response's listed ids, the last response of an id counts."""
    items = parsing.parse_responses(_responses(spark, d).where("response is not null")).select("request_id", F.explode_outer("items").alias("i")).where("i is not null").select(F.get_json_object(F.concat(F.lit("["), "i", F.lit("]")), "$[0]").alias("id"), F.col("request_id").cast("string").alias("prediction"), F.col("request_id").alias("ord"))
    return score.join_predictions(_examples(spark, d), items).select("id", "prediction")


@_query
def suite_headline(spark, d):
    """The headline metrics of three suites, the splits of the examples."""
    members = _t(spark, d, "split_members").groupBy("id").agg(F.min(value("split")).alias("suite"))
    rows = _predicted(spark, d, "half").join(members, "id")
    return evaluation.headline(evaluation.suite_summaries(evaluation.evaluate(rows.drop("prediction"), rows.select("suite", "id", "prediction", F.lit(1).alias("ord")))))


@_query
def unmatched_predictions(spark, d):
    known = _t(spark, d, "split_members").select("id", F.col("split").alias("prediction"))
    return score.unmatched_predictions(_examples(spark, d), known)


# dedup and splits


@_query
def exact_duplicates(spark, d):
    return dedup.exact_dedup(_ordered(spark, d).where("id is not null"), "created_at", "id").select("id")


@_query
def question_duplicates(spark, d):
    rows = _examples(spark, d).withColumn("ord", F.unix_micros(F.coalesce("created_at", F.lit("1970-01-01").cast("timestamp"))).cast("long"))
    return dedup.question_dedup(rows).select("id", "reason", "duplicate_of", "similarity")


@_query
def duplicate_reasons(spark, d):
    return dedup.drop_histogram(question_duplicates(spark, d))


@_query
def near_duplicate_drop(spark, d):
    """Held-out questions that a train question repeats, nearly."""
    members = _t(spark, d, "split_members").select("id", value("split").alias("split")).distinct()
    placed = _examples(spark, d).select("id", "question").join(members, "id")
    kept = similarity.drop_near_duplicates(placed.where("split <> 'train'"), placed.where("split = 'train'"))
    return kept.select("id")


@_query
def group_holdout(spark, d):
    rows = _examples(spark, d)
    sizes = rows.groupBy(split.group_key("project").alias("name")).agg(F.count("*").alias("n"))
    return split.hold_out_groups(sizes, 0.1 * rows.count())


@_query
def family_split(spark, d):
    rows = _examples(spark, d)
    families = rows.groupBy(split.family().alias("family")).agg(F.count("*").alias("n"))
    return split.cut_families(families, 0.1 * rows.count(), 42)


@_query
def split_dataset(spark, d):
    rows = _examples(spark, d).withColumn("ord", F.unix_micros(F.coalesce("created_at", F.lit("1970-01-01").cast("timestamp"))).cast("long"))
    return split.split_examples(rows).select("id", "split", "position")


@_query
def split_shares(spark, d):
    placed = _t(spark, d, "split_members").select("id", value("split").alias("split")).distinct()
    return split.split_shares(placed)


@_query
def leaked_projects(spark, d):
    placed = _examples(spark, d).select("id", "project").join(_t(spark, d, "split_members").select("id", value("split").alias("split")).distinct(), "id")
    return split.leaked_groups(placed)


@_query
def held_out_rows(spark, d):
    held = _t(spark, d, "split_members").where(value("split") == "test").select("id").distinct()
    return _examples(spark, d).join(held, "id", "left_anti").select("id", "project")


@_query
def append_new_rows(spark, d):
    members = _t(spark, d, "split_members").select("id").distinct()
    return ledger.append_new(members, _examples(spark, d).select("id"))


@_query
def repeated_ids(spark, d):
    return _t(spark, d, "examples").where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


# corpus


@_query
def section_index(spark, d):
    return _index(spark, d).select("project", "source", "heading", "chunk_id", X.content_hash("content").alias("hash"))


@_query
def corpus_summary(spark, d):
    return chunking.corpus_summary(_chunks(spark, d)).withColumn("project", F.coalesce("project", F.lit("(all)")))


@_query
def staged_projects(spark, d):
    return chunking.staged(_chunks(spark, d), 20)


@_query
def chunked_documents(spark, d):
    """Documents cut into heading-scoped sections."""
    docs = _t(spark, d, "documents").select(project_name("source").alias("project"), F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("relative_path"), "text")
    return chunking.chunk_files(docs).select("project", "source", "heading", "pos", "content_hash", F.array_join(F.coalesce("heading_path", F.array().cast("array<string>")), " > ").alias("path"))


@_query
def resolved_seeds(spark, d):
    """Seeds' references resolved to sections; what has none is listed."""
    seeds = _examples(spark, d).where("array_contains(tags, 'seed')").select("id", "project", F.col("relevant_sources").alias("sources"))
    return compose.resolve(seeds, _index(spark, d), strict=False).select("id", F.size("context").alias("n_found"), F.array_join("missing", "|").alias("missing"))


@_query
def distractor_sample(spark, d):
    return compose.distractors(_examples(spark, d), _index(spark, d)).select("id", "pos", "project", "source", "heading")


@_query
def noise_variants(spark, d):
    return compose.variants(_examples(spark, d), _index(spark, d)).select("id", "source_count", F.array_join("tags", "|").alias("tags"), F.array_join(F.transform("context", lambda c: compose.chunk_key(c["source"], c["heading"])), "|").alias("keys"))


@_query
def negative_examples(spark, d):
    return compose.negatives(_index(spark, d), 5).select("id", "project", "question", "answer", F.size("context").alias("n_sections"))


@_query
def negative_shortfall(spark, d):
    """Projects whose sections speak of too much for the unanswerable questions wanted."""
    index = _index(spark, d)
    return compose.shortfall(compose.negatives(index, 5), index, 5)


@_query
def noise_benchmark(spark, d):
    """Seeds with exactly four sections of other projects; projects with a test row are held out."""
    test = _t(spark, d, "split_members").where(value("split") == "test").select("id").distinct()
    held = _examples(spark, d).join(test, "id").select("project").distinct()
    seeds = _examples(spark, d).where("array_contains(tags, 'seed')")
    made = build.noise_benchmark(seeds, _index(spark, d), held)
    return made.select("id", "project", F.size(F.filter("context", lambda c: ~c["relevant"])).alias("n_irrelevant"), F.array_join("tags", "|").alias("tags"))


@_query
def unanswerable_benchmark(spark, d):
    return build.unanswerable_benchmark(_index(spark, d), 120)[0].select("id", "project", "question", F.size("context").alias("n_sections"))


@_query
def seed_examples(spark, d):
    seeds = _examples(spark, d).where("array_contains(tags, 'seed')").drop("tags").withColumn("sources", F.col("relevant_sources"))
    made = compose.seed_examples(seeds, _index(spark, d), strict=False)
    return made.select("id", "answerable", F.array_join("relevant_sources", "|").alias("gold"), F.array_join(F.transform("context", lambda c: compose.chunk_key(c["source"], c["heading"])), "|").alias("keys"), F.array_join("tags", "|").alias("tags"))


@_query
def single_plans(spark, d):
    keys = F.array_join(F.transform("context", lambda c: compose.chunk_key(c["source"], c["heading"])), "|")
    return compose.single_plans(_index(spark, d)).select("plan_id", "project", "n_relevant", "n_distractors", "ask_unanswerable", keys.alias("keys"))


@_query
def built_dataset(spark, d):
    """The stored seeds with variants and negatives, gated and split."""
    seeds = _examples(spark, d).where("array_contains(tags, 'seed')").drop("tags").withColumn("sources", F.col("relevant_sources"))
    index = _index(spark, d)
    known = compose.resolve(seeds, index, strict=False).where(F.size("missing") == 0).select("id")
    placed, _ = build.build_dataset(seeds.join(known, "id", "left_semi"), index)
    return placed.groupBy("split", "origin").agg(F.count("*").alias("n"))


@_query
def planned_bundles(spark, d):
    return compose.plan_bundles(_index(spark, d)).select("plan_id", "project", "size", "conflict", F.array_join(F.transform("slots", lambda s: F.concat(s["answerable"], F.lit(":"), s["category"])), "|").alias("slots"), F.md5(prompting.batch_instruction(F.col("slots"), F.lit(False), F.col("conflict"))).alias("instruction_md5"))


@_query
def drawn_bundles(spark, d):
    keys = F.array_join(F.transform("context", lambda c: compose.chunk_key(c["source"], c["heading"])), "|")
    return compose.draw_bundles(_index(spark, d)).select("plan_id", "project", "n_relevant", "n_distractors", "conflict", keys.alias("keys"), F.md5("prompt").alias("prompt_md5"))


@_query
def planned_mix(spark, d):
    mix = compose.plan_bundles(_index(spark, d)).select(F.explode("slots").alias("s")).groupBy("s.answerable").agg(F.count("*").alias("n"))
    return mix


@_query
def stratified_sample(spark, d):
    return compose.stratified(_examples(spark, d), {"full": 50, "partial": 25, "none": 15, "noisy": 10}, compose.bucket()).select("id", "bucket")


@_query
def shuffled_positions(spark, d):
    return _examples(spark, d).select("id", hash_order(42, "id").alias("position"), F.round(uniform(42, "id"), 9).alias("u"))


# responses


@_query
def parsed_responses(spark, d):
    df = parsing.parse_responses(_responses(spark, d))
    return df.select("request_id", "parsed", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items"), "head")


@_query
def fenced_items(spark, d):
    """Items of answers wrapped as responses in three ways, mapped to examples."""
    ex = _examples(spark, d).where("answer is not null and answer <> '' and question <> ''")
    body = F.to_json(F.struct(F.array(F.struct("question", "answer", F.upper("answerable").alias("answerability"), "category", F.col("relevant_sources").alias("required_sources"))).alias("examples")))
    u = uniform(5, "id")
    raw = F.when(u < 0.33, F.concat(F.lit("Here it is:\n```json\n"), body, F.lit("\n```\nDone."))).when(u < 0.66, F.concat(F.lit("Sure. "), F.get_json_object(body, "$.examples"), F.lit(" That is all."))).otherwise(body)
    parsed = parsing.parse_responses(ex.select("id", "project", raw.alias("response"))).select(F.col("id").alias("origin_id"), "project", F.lit("mock").alias("teacher"), F.explode_outer("items").alias("item")).where("item is not null")
    return parsing.items_to_examples(parsed).select("origin_id", "id", "answerable", "category", "rejected", F.size("relevant_sources").alias("n_sources"))


@_query
def quota_signals(spark, d):
    df = _responses(spark, d)
    return df.select("request_id", ledger.quota_signal(F.col("response")).alias("quota"))


@_query
def run_counters(spark, d):
    """Counters of a run whose units are the bundles and whose ledger is the response cache."""
    rows = _responses(spark, d).where("bundle is not null")
    last = rows.groupBy(F.col("bundle").alias("unit")).agg(F.max_by(F.struct("status", "n_items"), F.struct("received_at", "request_id")).alias("v"))
    state = last.select("unit", "v.status", F.col("v.n_items").cast("long").alias("accepted"), F.lit(0).cast("long").alias("rejected"), F.lit(False).alias("from_cache"))
    return ledger.run_counters(rows.select(F.col("bundle").alias("unit")), state)


@_query
def audit_structs(spark, d):
    df = _responses(spark, d)
    a = ledger.audit(F.lit("stored"), F.col("teacher"), F.col("prompt_version"), F.col("created_at"), F.col("cache_key"), F.col("status") == "ok")
    return df.select("request_id", a.alias("a")).select("request_id", "a.teacher_provider", "a.teacher_model", "a.prompt_version", "a.teacher_request_hash", "a.from_cache")


@_query
def cache_lookup(spark, d):
    requests = _t(spark, d, "response_cache").select("cache_key").distinct()
    return ledger.look_up(requests, _t(spark, d, "response_cache")).groupBy("hit").agg(F.count("*").alias("n"))


@_query
def pending_units(spark, d):
    units = _t(spark, d, "response_cache").select("bundle").where("bundle is not null").distinct()
    done = _t(spark, d, "response_cache").where("status = 'ok'")
    return ledger.pending(units, done, "bundle")


@_query
def run_report(spark, d):
    return ledger.run_report(_responses(spark, d), ["project", "teacher"])


@_query
def latency_medians(spark, d):
    return ledger.latency(_t(spark, d, "response_cache"), ["teacher"])


@_query
def status_by_day(spark, d):
    return status_by_window(_responses(spark, d)).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "status", "n")


@_query
def request_keys(spark, d):
    return _responses(spark, d).select("request_id", ledger.request_hash(project=F.col("project"), bundle=F.col("bundle"), version=F.col("prompt_version").cast("string")).alias("key"))


@_query
def mock_responses(spark, d):
    return _examples(spark, d).select("id", F.md5(parsing.mock_response(F.col("context"))).alias("response_md5"))


# cards


@_query
def dataset_card(spark, d):
    members = _t(spark, d, "split_members").groupBy("id").agg(F.min(value("split")).alias("split"))
    return cards.dataset_card(_examples(spark, d).join(members, "id", "left"))


@_query
def split_card(spark, d):
    members = _t(spark, d, "split_members").groupBy("id").agg(F.min(value("split")).alias("split"))
    rows = _examples(spark, d).join(members, "id").withColumn("teacher", F.col("teacher_metadata.teacher_model"))
    return cards.split_card(rows)


@_query
def project_labels(spark, d):
    folder = F.regexp_extract(F.coalesce("relative_path", F.lit("")), "^(.*)/[^/]*$", 1)
    return _t(spark, d, "documents").select("doc_id", project_label(folder).alias("label"))


@_query
def dataset_means(spark, d):
    return cards.dataset_means(_examples(spark, d))


@_query
def answer_token_stats(spark, d):
    return cards.token_stats(_examples(spark, d).select(X.word_count("answer").alias("n_tokens")))


@_query
def review_status(spark, d):
    decisions = _t(spark, d, "split_members").select("id", (value("split") == "train").alias("approved"))
    return cards.review_status(decisions, _examples(spark, d))
