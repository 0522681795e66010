"""SQL that gives the results of the query catalogue, for DuckDB over the same tables.

Compatibility normalisation has no SQL counterpart; the test texts are in that form already, so it is left out here
and tested on its own. Look-behind doesn't exist in this dialect; patterns carry the character in front instead.
"""

from __future__ import annotations

from millrace.functions import vocabulary as V
from millrace.operators.compose import ANSWERABLE_CATEGORIES, LEAST_POOL
from millrace.operators.ledger import QUOTA, TAIL


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _value(c: str) -> str:
    return f"regexp_replace(regexp_replace(lower({c}), '^[\\s_-]+|[\\s_-]+$', '', 'g'), '[\\s_-]+', '_', 'g')"


def _project(c: str) -> str:
    return f"coalesce(replace({_value(c)}, '_', '-'), '')"


def _strip(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '^\\s+|\\s+$', '', 'g')"


def _any(c: str, phrases) -> str:
    return f"list_bool_or(list_transform({_list(phrases)}, lambda p: contains({c}, p)))"


STOP, GENERIC = _list(V.STOPWORDS), _list(V.GENERIC)
WORD = "[A-Za-z0-9_][A-Za-z0-9_./-]*"


def _words(c: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({c}, ''), '{WORD}'), lambda t: lower(t))"


def _content(c: str) -> str:
    return f"list_filter({_words(c)}, lambda t: length(t) > 1 AND NOT list_contains({STOP}, t))"


def _norm(c: str) -> str:
    return f"lower(translate(coalesce({c}, ''), '—–', '--'))"


def _kept(found: str) -> str:
    strip = "trim(t, ' .,:;()[]{}\"''`')"
    return f"list_filter(list_transform({found}, lambda t: rtrim({strip}, '/')), lambda t: length(t) >= 2 AND NOT list_contains({GENERIC}, lower(t)) AND NOT list_contains({STOP}, lower(t)))"


def _identifiers(c: str) -> str:
    plain = [p.replace("'", "''") for p in V.IDENTIFIERS if "(?<!" not in p]
    parts = [f"regexp_extract_all({c}, '{p}')" for p in plain]
    parts.append(f"regexp_extract_all({c}, '(?:^|[^\\w/])(/[A-Za-z][A-Za-z0-9_\\-{{}}:/]*)', 1)")
    spans = f"list_filter(list_transform(regexp_extract_all({c}, '`([^`\\n]{{1,80}})`', 1), lambda t: trim(t)), lambda t: t <> '' AND len(string_split_regex(t, '\\s+')) <= 3)"
    return f"list_distinct({_kept(f'flatten([{", ".join(parts)}, {spans}])')})"


def _technical(c: str) -> str:
    plain = f"list_filter(list_transform(regexp_extract_all({c}, '{WORD}'), lambda t: trim(t, './-')), lambda t: length(t) >= 2 AND NOT list_contains({GENERIC}, lower(t)) AND NOT list_contains({STOP}, lower(t)) AND (regexp_matches(t, '[0-9_./]') OR regexp_matches(substr(t, 2), '[A-Z]')))"
    return f"list_distinct(list_concat({_identifiers(c)}, {plain}))"


def _flat(c: str) -> str:
    return f"coalesce(array_to_string(list_sort({c}), '|'), '')"


def _half(c: str) -> str:
    return f"array_to_string(list_slice(string_split({c}, ' '), 1, cast(ceil(len(string_split({c}, ' ')) / 2) AS INT)), ' ')"


# One row per id, in the one spelling.
EX = f"""ex AS (
SELECT id, {_strip('question')} AS question, {_strip('answer')} AS answer, {_value('category')} AS category, {_value('answerable')} AS answerable, {_value('difficulty')} AS difficulty,
 {_project('project')} AS project, coalesce(context, []) AS context, coalesce(source_count, len(coalesce(context, []))) AS source_count, coalesce(contains_code, contains(coalesce(answer, ''), '`')) AS contains_code,
 coalesce(must_include, []) AS must_include, coalesce(must_not_include, []) AS must_not_include, coalesce(facts, []) AS facts, coalesce(relevant_sources, []) AS relevant_sources, coalesce(tags, []) AS tags, origin, created_at
FROM examples WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_at DESC NULLS LAST) = 1)"""
_KEY = "lower(trim(c.source)) || '#' || lower(trim(c.heading))"
KEYED = f"""keyed AS (SELECT *,
 array_to_string(list_transform(context, lambda c: '[' || c.source || ' — ' || c.heading || ']' || chr(10) || c.heading || chr(10) || c.content), chr(10) || chr(10)) AS context_text,
 list_distinct(list_transform(context, lambda c: {_KEY})) AS context_keys, list_distinct(list_transform(context, lambda c: lower(trim(c.source)))) AS context_sources,
 CASE WHEN len(relevant_sources) > 0 THEN list_distinct(list_transform(relevant_sources, lambda s: lower(trim(split_part(s, '#', 1))) || '#' || lower(trim(CASE WHEN contains(s, '#') THEN substr(s, instr(s, '#') + 1) ELSE '' END))))
  ELSE list_distinct(list_transform(list_filter(context, lambda c: c.relevant IS DISTINCT FROM false), lambda c: {_KEY})) END AS gold_keys,
 list_distinct(list_transform(list_filter(context, lambda c: c.relevant IS NOT DISTINCT FROM false), lambda c: {_KEY})) AS distractor_keys FROM ex)"""
_CITE = "\\[([^\\[\\]\\n]+?)\\s+[—–-]\\s+([^\\[\\]\\n]+?)\\]"


def _facts(answer: str = "answer") -> str:
    """CTEs a (the answer judged), f (its lexical facts)."""
    return f"""a AS (SELECT * REPLACE ({answer} AS answer), answer AS gold_answer FROM keyed),
f AS (SELECT *, {_norm('answer')} AS answer_norm, {_norm('context_text')} AS hay, {_content('answer')} AS answer_words, {_content('context_text')} AS context_words,
 {_technical('answer')} AS technical, {_identifiers('answer')} AS idents,
 list_transform(list_zip(regexp_extract_all(answer, '{_CITE}', 1), regexp_extract_all(answer, '{_CITE}', 2)), lambda z: lower(trim(z[1])) || '#' || lower(trim(z[2]))) AS cite_keys,
 list_transform(regexp_extract_all(answer, '{_CITE}', 1), lambda s: lower(trim(s))) AS cite_sources FROM a),
g AS (SELECT *, list_sort(list_filter(idents, lambda t: NOT contains(hay || ' ' || {_norm('question')}, {_norm('t')}) AND NOT (rtrim({_norm('t')}, 's') <> '' AND contains(hay || ' ' || {_norm('question')}, rtrim({_norm('t')}, 's'))))) AS unsupported,
 coalesce(len(list_filter(technical, lambda t: contains(hay, {_norm('t')}) OR contains(hay, rtrim({_norm('t')}, 's')))) / nullif(len(technical), 0)::DOUBLE, 1.0) AS technical_share,
 coalesce(len(list_filter(answer_words, lambda t: list_contains(context_words, t))) / nullif(len(answer_words), 0)::DOUBLE, 0.0) AS lexical_share,
 list_filter(cite_keys, lambda c: NOT list_contains(context_keys, c)) AS unresolved,
 {_any('answer_norm', V.REFUSALS)} AS refuses, {_any('answer_norm', V.CONFLICTS)} AS conflict FROM f)"""


def _f1(a: str, b: str) -> str:
    both = f"list_sum(list_transform(list_intersect({a}, {b}), lambda t: least(len(list_filter({a}, lambda x: x = t)), len(list_filter({b}, lambda x: x = t)))))"
    return f"coalesce(2.0 * coalesce({both}, 0) / nullif(len({a}) + len({b}), 0), 0.0)"


def _recall(norm: str, phrases: str) -> str:
    return f"coalesce(len(list_filter({phrases}, lambda p: contains({norm}, {_norm('p')}))) / nullif(len({phrases}), 0)::DOUBLE, 1.0)"


def _gate() -> str:
    n = lambda cond: f"CASE WHEN {cond} THEN 1 ELSE 0 END"
    label = "coalesce(answerable, 'full')"
    tagged = "list_contains(tags, 'contradiction')"
    codes = {
        "question_short": n("length(question) < 10"),
        "question_long": n("length(question) > 500"),
        "answer_short": n("length(answer) < 20"),
        "answer_long": n("length(answer) > 4000"),
        "empty_context": n("trim(context_text) = ''"),
        "rambling": n("NOT list_contains(tags, 'structured-layout') AND length(answer) > 1200 AND length(answer) / greatest(length(context_text), 1)::DOUBLE > 1.5"),
        "citation_heading": "len(list_filter(unresolved, lambda c: list_contains(context_sources, split_part(c, '#', 1))))",
        "citation_source": "len(list_filter(unresolved, lambda c: NOT list_contains(context_sources, split_part(c, '#', 1))))",
        "no_citation": n(f"{label} <> 'none' AND len(cite_keys) = 0"),
        "unsupported_identifiers": n(f"len(unsupported) > CASE WHEN {label} = 'none' THEN 3 ELSE 0 END"),
        "technical_floor": n(f"{label} <> 'none' AND technical_share < 0.75"),
        "refusal_missing": n(f"{label} = 'none' AND NOT refuses"),
        "gap_not_flagged": n(f"{label} = 'partial' AND NOT {tagged} AND NOT refuses"),
        "conflict_not_named": n(f"{tagged} AND NOT conflict"),
        "conflict_sources": n(f"{tagged} AND len(list_distinct(cite_sources)) < 2 AND len(cite_keys) < 2"),
        "forbidden_fact": f"len(list_filter(must_not_include, lambda t: contains(answer_norm, {_norm('t')})))",
        "gold_outside_context": "len(list_filter(gold_keys, lambda k: NOT list_contains(context_keys, k)))",
    }
    rows = " UNION ALL ".join(f"SELECT id, '{code}' AS code, {count} AS n FROM g" for code, count in codes.items())
    return f"WITH {EX}, {KEYED}, {_facts()}, issue AS (SELECT * FROM ({rows}) WHERE n > 0)"


_FIRST = "CASE WHEN regexp_extract(answer, '(?s)^(.{59,}?[.!?])\\s', 1) <> '' AND (regexp_extract(answer, '(?s)^(.{60,}?)\\n', 1) = '' OR length(regexp_extract(answer, '(?s)^(.{59,}?[.!?])\\s', 1)) <= length(regexp_extract(answer, '(?s)^(.{60,}?)\\n', 1))) THEN regexp_extract(answer, '(?s)^(.{59,}?[.!?])\\s', 1) WHEN regexp_extract(answer, '(?s)^(.{60,}?)\\n', 1) <> '' THEN regexp_extract(answer, '(?s)^(.{60,}?)\\n', 1) ELSE answer END"


def _scored(prediction: str) -> str:
    """CTE s: the scorer's rows for a prediction."""
    none_cited = "CASE WHEN refuses THEN 1.0 ELSE 0.0 END"
    return f"""WITH {EX}, {KEYED}, {_facts(_strip(prediction))},
h AS (SELECT *, coalesce(answerable, 'full') AS label, CASE WHEN len(must_include) > 0 THEN must_include ELSE facts END AS key_facts, {_content('gold_answer')} AS gold_words,
 list_distinct(list_filter(cite_keys, lambda c: list_contains(context_keys, c))) AS resolved, list_distinct(cite_keys) AS cited,
 list_filter(cite_keys, lambda c: NOT list_contains(context_sources, split_part(c, '#', 1))) AS fabricated,
 list_filter(unresolved, lambda c: list_contains(context_sources, split_part(c, '#', 1))) AS misattributed,
 list_filter(must_not_include, lambda t: contains(answer_norm, {_norm('t')})) AS forbidden,
 len(list_filter(string_split_regex(answer, '\\s+'), lambda t: t <> '')) AS words, greatest(len(list_filter(string_split_regex(gold_answer, '\\s+'), lambda t: t <> '')), 1) AS ref_words,
 substr({_FIRST}, 1, 400) AS opening FROM g),
i AS (SELECT *, {_f1('answer_words', 'gold_words')} AS f1, {_recall('answer_norm', 'key_facts')} AS recall, len(key_facts) > 0 AS has_facts, len(list_intersect(resolved, gold_keys)) AS gold_cited,
 CASE WHEN len(cited) > 0 THEN len(resolved) / len(cited)::DOUBLE ELSE {none_cited} END AS prec, words / ref_words::DOUBLE AS ratio FROM h),
j AS (SELECT *, coalesce(gold_cited / nullif(len(gold_keys), 0)::DOUBLE, 1.0) AS grec, refuses AND NOT (has_facts AND recall >= 0.5) AND ({_any(_norm('opening'), V.REFUSALS)} OR len(resolved) = 0) AS wholesale FROM i),
s0 AS (SELECT id, project, category, label AS answerable, answer = '' AS empty, round(CASE WHEN has_facts THEN 0.5 * f1 + 0.5 * recall ELSE f1 END, 4) AS answer_correctness, round(f1, 4) AS token_f1, round(recall, 4) AS key_fact_recall, has_facts,
 round(technical_share, 4) AS groundedness, round(lexical_share, 4) AS lexical_groundedness, array_to_string(unsupported, '|') AS unsupported, round(prec, 4) AS citation_precision, round(grec, 4) AS citation_recall,
 round(coalesce(2 * prec * grec / nullif(prec + grec, 0), 0.0), 4) AS citation_f1, array_to_string(list_transform(fabricated, lambda c: split_part(c, '#', 1) || ' — ' || substr(c, instr(c, '#') + 1)), '|') AS fabricated,
 refuses AS refused, wholesale AS wholesale_refusal, CASE WHEN label = 'full' THEN NOT wholesale ELSE refuses END AS refusal_correct, label = 'full' AND wholesale AS false_refusal,
 len(fabricated) > 0 OR len(misattributed) > 0 OR len(forbidden) > 0 OR len(unsupported) > CASE WHEN label = 'none' THEN 3 ELSE 0 END OR (label = 'none' AND NOT refuses) AS hallucinated,
 round(CASE WHEN len(resolved) > 0 THEN gold_cited / len(resolved)::DOUBLE ELSE {none_cited} END, 4) AS relevant_source_usage, len(list_intersect(cited, distractor_keys)) AS distractor_citations,
 round(CASE WHEN ratio <= 1.5 THEN 1.0 ELSE 1.5 / ratio END, 4) AS conciseness, round(ratio, 3) AS length_ratio, words FROM j),
s AS (SELECT *, answerable IN ('full', 'partial') AND NOT wholesale_refusal AND NOT hallucinated AND NOT empty AND citation_precision > 0 AND (token_f1 >= 0.2 OR (has_facts AND key_fact_recall >= 0.5)) AS useful FROM s0)"""


_MEANS = ("answer_correctness", "token_f1", "key_fact_recall", "groundedness", "lexical_groundedness", "citation_precision", "citation_recall", "citation_f1", "relevant_source_usage", "conciseness", "length_ratio")
_RATES = ("refusal_correct", "false_refusal", "hallucinated", "empty")
_LOWER = "'false_refusal_rate', 'hallucinated_rate', 'empty_rate', 'length_ratio', 'distractor_citations_per_answer'"
_SUMMARY = ", ".join(
    ["count(*) AS n", *[f"round(sum(round({m} * 10000)::BIGINT) / nullif(count({m}), 0)::DOUBLE) / 10000 AS {m}" for m in _MEANS], *[f"round(avg({r}::INT), 4) AS {r}_rate" for r in _RATES], "round(avg(distractor_citations), 4) AS distractor_citations_per_answer"]
    + [f"round(avg({c}::INT) FILTER (answerable = '{a}'), 4) AS {n}" for c, a, n in (("hallucinated", "none", "hallucination_rate_unanswerable"), ("refusal_correct", "none", "refusal_rate_unanswerable"), ("false_refusal", "full", "false_refusal_rate_answerable"))]
    + ["round(count(*) FILTER (useful) / nullif(count(*) FILTER (answerable IN ('full', 'partial')), 0)::DOUBLE, 4) AS useful_answer_rate"]
)


def _slices(prediction: str) -> str:
    return f"""{_scored(prediction)}, t AS (SELECT * REPLACE (coalesce(category, 'None') AS category) FROM s)
SELECT 'all' AS slice, '' AS value, {_SUMMARY} FROM t UNION ALL SELECT 'category', category, {_SUMMARY} FROM t GROUP BY category UNION ALL SELECT 'answerable', answerable, {_SUMMARY} FROM t GROUP BY answerable"""


def _compare() -> str:
    metrics = [*_MEANS, *[f"{r}_rate" for r in _RATES], "distractor_citations_per_answer"]
    long = lambda p, name: f"SELECT slice, value, metric, {name} FROM (UNPIVOT ({_slices(p)}) ON {', '.join(metrics)} INTO NAME metric VALUE {name})"
    return f"SELECT slice, value, metric, base, tuned, round(tuned - base, 4) AS delta, CASE WHEN metric IN ({_LOWER}) THEN round(tuned - base, 4) < 0 ELSE round(tuned - base, 4) > 0 END AS improved FROM ({long(_HALF, 'base')}) JOIN ({long(_BARE, 'tuned')}) USING (slice, value, metric)"


_HALF, _BARE = _half("answer"), "regexp_replace(answer, '\\s*\\[[^\\[\\]\\n]*\\]', '', 'g')"
_GROUP = "coalesce(nullif(project, ''), context[1].source, 'unknown')"
_FAMILY = "regexp_replace(id, '-(noise|var|aug)[0-9]+$', '')"
_U = lambda key: f"(('0x' || substr(md5({key}), 1, 8))::UBIGINT / 4294967296.0)"
MEMBERS = f"members AS (SELECT DISTINCT id, {_value('split')} AS split FROM split_members)"
CHUNKS = f"ch AS (SELECT * REPLACE ({_project('project')} AS project, coalesce(source, '') AS source, coalesce(heading, '') AS heading) FROM chunks WHERE chunk_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY loaded_at DESC NULLS LAST) = 1)"
INDEX = f"{CHUNKS}, ix AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY project, source, heading ORDER BY ord DESC, chunk_id DESC) = 1)"
RESPONSES = f"rc AS (SELECT DISTINCT ON (request_id) * REPLACE ({_project('project')} AS project) FROM response_cache)"


def _bundles() -> str:
    key = "project || '|' || source || '|' || heading"
    u = lambda *tag: _U("'7|' || " + key + "".join(f" || '|{t}'" for t in tag))
    n = len(ANSWERABLE_CATEGORIES)
    slot = lambda k: f"CASE WHEN {u('slot', k)} < 0.2 THEN 'none:unanswerable' WHEN {u('slot', k)} < 0.35 THEN 'partial:partially_answerable' WHEN {u('slot', k)} < 0.45 THEN 'full:contradictory_context' ELSE 'full:' || {_list(ANSWERABLE_CATEGORIES)}[cast(floor({u(f'category{k}')} * {n}) AS INT) + 1] END"
    return f"""WITH {INDEX}, b AS (SELECT project, source, heading, [2, 3, 4, 5][cast(floor({u('size')} * 4) AS INT) + 1] AS size, {u('conflict')} < 0.08 AS conflict,
 [{', '.join(slot(k) for k in range(5))}] AS slots, md5('7|' || {key} || '|plan') AS h, 'b-' || project || '-' || substr(sha1(source || '||' || heading), 1, 10) AS plan_id FROM ix),
p AS (SELECT * REPLACE (CASE WHEN conflict THEN list_concat(['partial:contradictory_context'], slots[2:]) ELSE slots END AS slots) FROM b)"""


def _drawn(seed: str, least: int, most: int) -> str:
    """CTE drawn: the distractors of every example, by going through its whole order of foreign sections."""
    return f"""WITH {EX}, {INDEX}, sz AS (SELECT project, count(*) AS n FROM ix GROUP BY project), offs AS (SELECT project, n, coalesce(sum(n) OVER (ORDER BY project ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o FROM sz),
rk AS (SELECT ix.project, source, heading, o + row_number() OVER (PARTITION BY ix.project ORDER BY md5('{seed}|' || ix.project || '|' || source || '|' || heading), source, heading) - 1 AS rank FROM ix JOIN offs ON offs.project = ix.project),
prime AS (SELECT min(p) AS p, (SELECT count(*) FROM ix) AS total FROM range((SELECT greatest(2, count(*)) FROM ix), (SELECT greatest(2, count(*)) + 2000 FROM ix)) t(p) WHERE len(list_filter(range(2, cast(floor(sqrt(p)) AS BIGINT) + 1), lambda d: p % d = 0)) = 0),
w AS (SELECT id, coalesce(o, 0) AS o, coalesce(n, 0) AS n, list_transform(context, lambda x: trim(x.source) || '#' || trim(x.heading)) AS own_keys, cast(floor({_U(f"'{seed}|start|' || id")} * p) AS BIGINT) AS start, cast(floor({_U(f"'{seed}|stride|' || id")} * (p - 1)) AS BIGINT) + 1 AS stride,
 cast(floor({_U(f"'{seed}|k|' || id")} * {most - least + 1}) AS INT) + {least} AS k, p, total FROM ex CROSS JOIN prime LEFT JOIN offs USING (project) WHERE coalesce(answerable, 'full') <> 'none'),
dr AS (SELECT w.*, draw, (start + draw * stride) % p AS number FROM w, range((SELECT p FROM prime)) r(draw)),
hit AS (SELECT dr.id, dr.k, rk.project, rk.source, rk.heading, row_number() OVER (PARTITION BY dr.id ORDER BY draw) AS pos FROM dr JOIN rk ON rk.rank = CASE WHEN number < o THEN number ELSE number + n END WHERE number < total - n AND NOT list_contains(own_keys, trim(source) || '#' || trim(heading))),
drawn AS (SELECT * FROM hit WHERE pos <= k AND id IN (SELECT id FROM hit WHERE pos = {LEAST_POOL}))"""


def oracle_sql() -> dict[str, str]:
    ex, keyed = f"WITH {EX}", f"WITH {EX}, {KEYED}"
    members = f"WITH {EX}, {MEMBERS}"
    half = _scored(_HALF)
    tp, fn, fp, tn = (f"count(*) FILTER ({'' if a else 'NOT '}(answerable IN ('full', 'partial')) AND {'' if r else 'NOT '}wholesale_refusal)" for a, r in ((1, 0), (1, 1), (0, 0), (0, 1)))
    return {
        "word_counts": f"{ex} SELECT id, len({_words('answer')}) AS n_words, len({_content('answer')}) AS n_content, len(list_filter(string_split_regex(answer, '\\s+'), lambda t: t <> '')) AS n_blank_words, array_to_string(list_sort(list_distinct({_content('question')})), ' ') AS question_words FROM ex",
        "normalised_questions": f"{ex} SELECT id, array_to_string(list_sort(list_distinct(list_filter({_words("regexp_replace(lower(question), '[^\\p{L}\\p{N}\\p{M}_\\s/.:-]+', ' ', 'g')")}, lambda t: NOT list_contains({STOP}, t)))), ' ') AS norm, md5({_norm('question')}) AS normal_md5 FROM ex",
        "identifiers": f"{ex} SELECT id, {_flat(_identifiers('answer'))} AS identifiers, {_flat(_technical('answer'))} AS technical FROM ex",
        "citations": f"{ex} SELECT id, unnest(range(len(s)))::INT AS pos, unnest(s) AS source, unnest(h) AS heading FROM (SELECT id, list_transform(regexp_extract_all(answer, '{_CITE}', 1), lambda x: trim(x)) AS s, list_transform(regexp_extract_all(answer, '{_CITE}', 2), lambda x: trim(x)) AS h FROM ex)",
        "refusal_flags": f"{ex} SELECT id, {_any(_norm('answer'), V.REFUSALS)} AS declines, {_any(_norm('answer'), V.CONFLICTS)} AS names_conflict FROM ex",
        "opening_sentences": f"{ex}, o AS (SELECT id, substr({_FIRST}, 1, 400) AS opening FROM ex) SELECT id, opening, {_any(_norm('opening'), V.REFUSALS)} AS opens_with_refusal FROM o",
        "suite_headline": f"{half}, {MEMBERS}, m AS (SELECT id, min(split) AS suite FROM members GROUP BY id) SELECT suite, {', '.join(f'round(sum(round({c} * 10000)::BIGINT) / nullif(count({c}), 0)::DOUBLE) / 10000 AS {c}' for c in ('answer_correctness', 'groundedness', 'citation_f1', 'relevant_source_usage', 'conciseness'))}, round(avg(refusal_correct::INT), 4) AS refusal_correct_rate, round(avg(hallucinated::INT), 4) AS hallucinated_rate FROM s JOIN m USING (id) GROUP BY suite",
        "grounding": f"{keyed}, {_facts()} SELECT id, round(lexical_share, 4) AS lexical_share, round(technical_share, 4) AS technical_share, array_to_string(unsupported, '|') AS unsupported FROM g",
        "pair_scores": f"{ex}, w AS (SELECT *, {_content('question')} AS qw, {_content('answer')} AS aw FROM ex) SELECT id, round(CASE WHEN len(qw) > 0 AND len(aw) > 0 THEN len(list_intersect(qw, aw)) / len(list_distinct(list_concat(qw, aw)))::DOUBLE ELSE 0.0 END, 4) AS jaccard, round({_f1('qw', 'aw')}, 4) AS token_f1, round({_recall(_norm('answer'), 'must_include')}, 4) AS recall FROM w",
        "stable_ids": f"{ex} SELECT id, 'gen-' || project || '-' || substr(sha1(question || '||' || answer), 1, 10) AS stable_id, substr(sha256(answer), 1, 16) AS answer_hash, {_FAMILY} AS family, source_count, contains_code FROM ex",
        "shaped_examples": f"{ex} SELECT id, category, answerable, difficulty, project, source_count, contains_code, length(question) AS question_chars, length(answer) AS answer_chars FROM ex",
        "context_keys": f"{keyed} SELECT id, {_flat('context_keys')} AS context_keys, {_flat('gold_keys')} AS gold_keys, {_flat('distractor_keys')} AS distractor_keys, md5(context_text) AS context_md5 FROM keyed",
        "citation_roundtrip": f"{keyed}, {_facts()} SELECT id, pos::INT AS pos, CASE WHEN list_contains(context_keys, c) THEN 'found' WHEN list_contains(context_sources, split_part(c, '#', 1)) THEN 'heading' ELSE 'source' END AS state FROM (SELECT id, context_keys, context_sources, unnest(range(len(cite_keys))) AS pos, unnest(cite_keys) AS c FROM f)",
        "rendered_prompts": f"{ex} SELECT id, md5('## Project documentation' || chr(10) || chr(10) || array_to_string(list_transform(context, lambda c: '[' || c.source || ' — ' || c.heading || ']' || chr(10) || {_strip('c.content')}), chr(10) || chr(10)) || chr(10) || chr(10) || '## Question' || chr(10) || chr(10) || question) AS prompt_md5, 3 AS n_messages FROM ex",
        "gate_issues": f"{_gate()} SELECT id, code, n FROM issue",
        "gate_metrics": f"{_gate()} SELECT id, id NOT IN (SELECT id FROM issue) AS ok, round(length(answer) / greatest(length(context_text), 1)::DOUBLE, 3) AS answer_context_ratio, len(cite_keys) AS citation_count, len(unsupported) AS unsupported_identifiers, round(lexical_share, 3) AS groundedness, round(technical_share, 3) AS technical_groundedness FROM g",
        "gate_histogram": f"{_gate()} SELECT code, sum(n)::BIGINT AS n FROM issue GROUP BY code ORDER BY n DESC, code LIMIT 6",
        "gate_verdict": f"{_gate()}, v AS (SELECT (SELECT count(*) FROM g) AS n, (SELECT count(DISTINCT id) FROM issue) AS failures) SELECT n, failures, failures = 0 AS passed FROM v",
        "gate_batch_rejects": "SELECT id, count(*) AS n_rows, count(*) - 1 AS n_repeats FROM examples WHERE id IS NOT NULL GROUP BY id",
        "scored_rows": f"{half} SELECT id, answer_correctness, token_f1, key_fact_recall, groundedness, lexical_groundedness, citation_precision, citation_recall, citation_f1, refused, relevant_source_usage, distractor_citations, conciseness, length_ratio, words, empty FROM s",
        "score_flags": f"{half} SELECT id, wholesale_refusal, refusal_correct, false_refusal, hallucinated, useful, unsupported, fabricated FROM s",
        "metric_by_slice": _slices(_HALF),
        "metric_summary": f"{_scored('answer')} SELECT {_SUMMARY} FROM s",
        "confusion_matrix": f"""{half}, m AS (SELECT {tp} AS true_positive, {fn} AS false_negative, {fp} AS false_positive, {tn} AS true_negative FROM s)
SELECT *, true_positive + false_negative AS n_answerable, false_positive + true_negative AS n_unanswerable, round(true_positive / nullif(true_positive + false_positive, 0)::DOUBLE, 4) AS answer_precision, round(true_positive / nullif(true_positive + false_negative, 0)::DOUBLE, 4) AS answer_recall,
 round(true_negative / nullif(true_negative + false_negative, 0)::DOUBLE, 4) AS refusal_precision, round(true_negative / nullif(true_negative + false_positive, 0)::DOUBLE, 4) AS refusal_recall, round(false_positive / nullif(false_positive + true_negative, 0)::DOUBLE, 4) AS hallucination_rate,
 round(false_negative / nullif(true_positive + false_negative, 0)::DOUBLE, 4) AS incorrect_refusal_rate, round(true_negative / nullif(false_positive + true_negative, 0)::DOUBLE, 4) AS correct_refusal_rate FROM m""",
        "base_against_tuned": _compare(),
        "prediction_join": f"WITH {EX}, {RESPONSES}, p AS (SELECT request_id, unnest(TRY_CAST(json_extract(TRY_CAST(regexp_extract(response, '(?s)(\\{{.*\\}})', 1) AS JSON), '$.examples') AS VARCHAR[])) AS id FROM rc WHERE response IS NOT NULL) SELECT ex.id, max(request_id)::VARCHAR AS prediction FROM p JOIN ex USING (id) GROUP BY ex.id",
        "unmatched_predictions": "SELECT DISTINCT id FROM split_members WHERE id NOT IN (SELECT id FROM examples WHERE id IS NOT NULL)",
        "exact_duplicates": f"SELECT id FROM examples WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lower({_strip('question')}), lower({_strip('answer')}), list_sort(list_distinct(list_transform(coalesce(context, []), lambda c: trim(c.source) || '#' || trim(c.heading)))) ORDER BY created_at NULLS FIRST, id) = 1",
        "near_duplicate_drop": f"""{members}, p AS (SELECT id, list_distinct({_content('question')}) AS w, split FROM ex JOIN members USING (id)), e AS (SELECT id, len(w) AS n, unnest(w) AS t FROM p WHERE split <> 'train'), r AS (SELECT id, len(w) AS n, unnest(w) AS t FROM p WHERE split = 'train'),
hit AS (SELECT DISTINCT e.id FROM e JOIN r USING (t) GROUP BY e.id, r.id, e.n, r.n HAVING count(*) >= 0.9 * (e.n + r.n - count(*)) - 1e-9) SELECT id FROM p WHERE split <> 'train' AND id NOT IN (SELECT id FROM hit)""",
        "group_holdout": f"{ex}, z AS (SELECT {_GROUP} AS name, count(*) AS n FROM ex GROUP BY 1), c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY n, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM z), k AS (SELECT name FROM c WHERE before < 0.1 * (SELECT count(*) FROM ex)) SELECT name FROM k WHERE (SELECT count(*) FROM k) < (SELECT count(*) FROM z)",
        "family_split": f"{ex}, z AS (SELECT {_FAMILY} AS family, count(*) AS n FROM ex GROUP BY 1), c AS (SELECT family, coalesce(sum(n) OVER (ORDER BY md5('42|' || family), family ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM z) SELECT family FROM c WHERE before < 0.1 * (SELECT count(*) FROM ex)",
        "split_shares": f"WITH {MEMBERS} SELECT split, count(*) AS n, round(count(*) / (SELECT count(*) FROM members)::DOUBLE, 4) AS share FROM members GROUP BY split",
        "leaked_projects": f"{members}, p AS (SELECT project, split FROM ex JOIN members USING (id) WHERE project <> '') SELECT project FROM p WHERE split = 'train' INTERSECT SELECT project FROM p WHERE split = 'test'",
        "held_out_rows": f"{members} SELECT id, project FROM ex WHERE id NOT IN (SELECT id FROM members WHERE split = 'test')",
        "append_new_rows": "SELECT id FROM split_members UNION SELECT id FROM examples WHERE id IS NOT NULL",
        "repeated_ids": "SELECT id, count(*) AS n FROM examples WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1",
        "section_index": f"WITH {INDEX} SELECT project, source, heading, chunk_id, substr(sha256(coalesce(content, '')), 1, 16) AS hash FROM ix",
        "corpus_summary": f"WITH {CHUNKS} SELECT coalesce(project, '(all)') AS project, count(*) AS n_sections, count(DISTINCT p) AS n_projects FROM (SELECT project, project AS p FROM ch) GROUP BY ROLLUP (project)",
        "staged_projects": f"WITH {CHUNKS} SELECT project, count(*) AS n_sections, count(*) >= 20 AS staged FROM ch GROUP BY project",
        "resolved_seeds": f"""WITH {EX}, {INDEX}, r AS (SELECT id, project, unnest(relevant_sources) AS t FROM ex WHERE list_contains(tags, 'seed')),
k AS (SELECT id, t, CASE WHEN contains(split_part(t, '#', 1), ':') THEN trim(split_part(t, ':', 1)) ELSE project END AS project, trim(CASE WHEN contains(split_part(t, '#', 1), ':') THEN substr(split_part(t, '#', 1), instr(t, ':') + 1) ELSE split_part(t, '#', 1) END) AS source, trim(substr(t, instr(t, '#') + 1)) AS heading FROM r)
SELECT k.id, count(ix.chunk_id)::INT AS n_found, coalesce(string_agg(CASE WHEN ix.chunk_id IS NULL THEN t END, '|' ORDER BY t), '') AS missing FROM k LEFT JOIN ix ON k.project = ix.project AND k.source = trim(ix.source) AND k.heading = trim(ix.heading) GROUP BY k.id""",
        "distractor_sample": f"{_drawn('43', 3, 4)} SELECT id, pos::INT AS pos, project, source, heading FROM drawn",
        "noise_variants": f"""{_drawn('43', 3, 4)}, k AS (SELECT id, unnest(list_transform(context, lambda c: trim(c.source) || '#' || trim(c.heading))) AS key FROM ex UNION ALL SELECT id, trim(source) || '#' || trim(heading) FROM drawn)
SELECT ex.id || '-noise1' AS id, count(*)::INT AS source_count, any_value(array_to_string(list_sort(list_distinct(list_concat(tags, ['distractor', 'augmented']))), '|')) AS tags, string_agg(key, '|' ORDER BY md5('43|' || ex.id || '|' || key)) AS keys
FROM ex JOIN k USING (id) WHERE ex.id IN (SELECT id FROM drawn) AND NOT list_contains(tags, 'distractor') GROUP BY ex.id""",
        "noise_benchmark": f"""{_drawn('101', 4, 4)}, {MEMBERS}, held AS (SELECT DISTINCT project FROM ex JOIN members USING (id) WHERE split = 'test')
SELECT 'noise-' || id AS id, project, (4 + len(list_filter(context, lambda c: c.relevant IS NOT DISTINCT FROM false)))::INT AS n_irrelevant, array_to_string(list_sort(list_distinct(list_concat(list_filter(tags, lambda t: t NOT IN ('distractor', 'augmented')), ['benchmark', 'retrieval_noise', CASE WHEN project IN (SELECT project FROM held) THEN 'heldout' ELSE 'in_domain' END]))), '|') AS tags
FROM ex WHERE list_contains(tags, 'seed') AND NOT list_contains(tags, 'distractor') AND id IN (SELECT id FROM drawn)""",
        "planned_bundles": f"{_bundles()} SELECT plan_id, project, size, conflict, array_to_string(slots, '|') AS slots, md5('Write 5 question and answer pairs from the blocks below, in this mix:' || chr(10) || array_to_string(list_transform(slots, lambda s, i: i || '. answerable=' || split_part(s, ':', 1) || ', category=' || split_part(s, ':', 2)), chr(10)) || CASE WHEN conflict THEN chr(10) || 'Two blocks disagree: one pair must name the conflict and cite both.' ELSE '' END) AS instruction_md5 FROM p",
        "planned_mix": f"{_bundles()} SELECT split_part(s, ':', 1) AS answerable, count(*) AS n FROM (SELECT unnest(slots) AS s FROM p) GROUP BY 1",
        "stratified_sample": f"{ex}, b AS (SELECT id, CASE WHEN coalesce(answerable, 'full') = 'none' THEN 'none' WHEN answerable = 'partial' THEN 'partial' WHEN list_has_any(tags, ['distractor', 'contradiction']) THEN 'noisy' ELSE 'full' END AS bucket FROM ex) SELECT id, bucket FROM b QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY md5('42|' || id), id) <= CASE bucket WHEN 'full' THEN 50 WHEN 'partial' THEN 25 WHEN 'none' THEN 15 ELSE 10 END",
        "shuffled_positions": f"{ex} SELECT id, md5('42|' || id) AS position, round({_U("'42|' || id")}, 9) AS u FROM ex",
        "quota_signals": f"WITH {RESPONSES} SELECT request_id, {_any(f'right(lower(coalesce(response, {chr(39) * 2})), {TAIL})', QUOTA)} AS quota FROM rc",
        "run_counters": f"""WITH {RESPONSES}, l AS (SELECT bundle, arg_max({{'s': status, 'n': n_items}}, (received_at, request_id)) AS v FROM rc WHERE bundle IS NOT NULL GROUP BY bundle), u AS (SELECT v.s AS s, v.n AS n FROM l)
SELECT count(*) AS planned, count(*) FILTER (s = 'ok') AS done, count(*) FILTER (s = 'ok') AS calls, 0::BIGINT AS hits, coalesce(sum(n), 0)::BIGINT AS accepted, 0::BIGINT AS rejected, count(*) FILTER (s IS NOT NULL AND s <> 'ok' AND s <> 'quota') AS failures, count(*) FILTER (s = 'quota') AS stopped, count(*) FILTER (s IS NULL OR s <> 'ok') AS left FROM u""",
        "audit_structs": f"WITH {RESPONSES} SELECT request_id, 'stored' AS teacher_provider, teacher AS teacher_model, prompt_version::VARCHAR AS prompt_version, cache_key AS teacher_request_hash, status = 'ok' AS from_cache FROM rc",
        "cache_lookup": "WITH u AS (SELECT DISTINCT cache_key FROM response_cache), h AS (SELECT DISTINCT cache_key FROM response_cache WHERE response IS NOT NULL AND status = 'ok' AND json_valid(response)) SELECT cache_key IN (SELECT cache_key FROM h) AS hit, count(*) AS n FROM u GROUP BY 1",
        "pending_units": "SELECT DISTINCT bundle FROM response_cache WHERE bundle IS NOT NULL AND bundle NOT IN (SELECT bundle FROM response_cache WHERE status = 'ok' AND bundle IS NOT NULL)",
        "run_report": f"WITH {RESPONSES} SELECT project, teacher, count(*) AS requests, count(*) FILTER (status = 'ok') AS succeeded, count(*) FILTER (status = 'parse_failed') AS parse_failed, count(*) FILTER (status = 'timeout') AS timed_out, count(*) FILTER (status IS NULL) AS unknown, sum(CASE WHEN status = 'ok' THEN n_items ELSE 0 END)::BIGINT AS items, round(coalesce(avg(n_items) FILTER (status = 'ok'), 0), 4) AS items_per_success, round(count(*) FILTER (status = 'ok') / count(*)::DOUBLE, 4) AS hit_rate FROM rc GROUP BY project, teacher",
        "latency_medians": "WITH r AS (SELECT DISTINCT ON (request_id) * FROM response_cache) SELECT teacher, count(*) AS n, round(median(total_ms), 3) AS median_ms, round(avg(total_ms), 3) AS mean_ms, max(total_ms) AS max_ms FROM r WHERE total_ms IS NOT NULL GROUP BY teacher",
        "status_by_day": f"WITH {RESPONSES} SELECT strftime(created_at, '%Y-%m-%d') AS day, coalesce(status, 'unknown') AS status, count(*) AS n FROM rc WHERE created_at IS NOT NULL GROUP BY 1, 2",
        "request_keys": f"WITH {RESPONSES} SELECT request_id, sha256('{{\"bundle\":' || coalesce('\"' || bundle || '\"', 'null') || ',\"project\":\"' || project || '\",\"version\":' || coalesce('\"' || prompt_version || '\"', 'null') || '}}') AS key FROM rc",
        "dataset_card": f"""{members}, d AS (SELECT coalesce(category, 'None') AS category, coalesce(answerable, 'None') AS answerable, project, coalesce(origin, 'unknown') AS origin, coalesce(m.split, 'None') AS split FROM ex LEFT JOIN (SELECT id, min(split) AS split FROM members GROUP BY id) m USING (id))
SELECT 'all' AS facet, '' AS value, count(*) AS n FROM d """ + " ".join(f"UNION ALL SELECT '{c}', {c}, count(*) FROM d GROUP BY {c}" for c in ("category", "answerable", "project", "origin", "split")),
        "split_card": f"""{members}, d AS (SELECT m.split, coalesce(category, 'None') AS category, coalesce(answerable, 'None') AS answerable, project, coalesce(origin, 'unknown') AS origin, coalesce(t.teacher, 'unknown') AS teacher FROM ex JOIN (SELECT id, min(split) AS split FROM members GROUP BY id) m USING (id) JOIN (SELECT id, teacher_metadata.teacher_model AS teacher FROM examples WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_at DESC NULLS LAST) = 1) t USING (id))
SELECT split, 'all' AS facet, '' AS value, count(*) AS n FROM d GROUP BY split """ + " ".join(f"UNION ALL SELECT split, '{c}', {c}, count(*) FROM d GROUP BY split, {c}" for c in ("category", "answerable", "project", "origin", "teacher")),
        "project_labels": """WITH f AS (SELECT doc_id, list_filter(string_split(regexp_extract(coalesce(relative_path, ''), '^(.*)/[^/]*$', 1), '/'), lambda p: p <> '') AS parts FROM documents)
SELECT doc_id, replace(coalesce(CASE WHEN lower(parts[-1]) IN ('docs', 'doc', 'documentation', 'wiki') AND len(parts) > 1 THEN parts[-2] ELSE parts[-1] END, ''), ' ', '-') AS label FROM f""",
        "seed_examples": f"""WITH {EX}, {INDEX}, r AS (SELECT id, project, unnest(range(len(relevant_sources))) AS pos, unnest(relevant_sources) AS t FROM ex WHERE list_contains(tags, 'seed')),
k AS (SELECT id, pos, CASE WHEN contains(split_part(t, '#', 1), ':') THEN trim(split_part(t, ':', 1)) ELSE project END AS project, trim(CASE WHEN contains(split_part(t, '#', 1), ':') THEN substr(split_part(t, '#', 1), instr(t, ':') + 1) ELSE split_part(t, '#', 1) END) AS source, trim(substr(t, instr(t, '#') + 1)) AS heading FROM r),
f AS (SELECT k.id, pos, ix.source || '#' || ix.heading AS key FROM k JOIN ix ON k.project = ix.project AND k.source = trim(ix.source) AND k.heading = trim(ix.heading))
SELECT k.id, any_value(coalesce(ex.answerable, 'full')) AS answerable, coalesce(any_value(g.gold), '') AS gold, coalesce(any_value(g.keys), '') AS keys, 'seed' AS tags FROM k JOIN ex USING (id) LEFT JOIN (SELECT id, string_agg(key, '|' ORDER BY pos) AS gold, string_agg(key, '|' ORDER BY md5('42|' || id || '|' || key)) AS keys FROM f GROUP BY id) g USING (id) GROUP BY k.id""",
        "dataset_means": f"{ex} SELECT count(*) AS n, round(avg(source_count), 2) AS mean_sources, round(avg(length(answer)), 2) AS mean_answer_chars, count(*) FILTER (len(list_filter(context, lambda c: c.relevant IS NOT DISTINCT FROM false)) > 0) AS with_distractors, count(*) FILTER (contains_code) AS with_code FROM ex",
        "answer_token_stats": f"{ex}, t AS (SELECT len(list_filter(string_split_regex(answer, '\\s+'), lambda t: t <> '')) AS n FROM ex) SELECT max(n)::INT AS longest, round(avg(n), 1) AS mean, sum(n)::BIGINT AS total FROM t",
        "review_status": f"{members}, d AS (SELECT ex.id, bool_or(split = 'train') AS approved FROM ex LEFT JOIN members USING (id) GROUP BY ex.id) SELECT count(*) FILTER (approved) AS approved, count(*) FILTER (NOT approved) AS rejected, count(*) FILTER (approved IS NULL) AS open FROM d",
    }
