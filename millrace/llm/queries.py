"""The training-data queries over the test tables, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.broken_pairs import broken_pairs, pair_defects
from millrace.llm.canonical import canonicalise, lookalike_members, lookalike_pairs
from millrace.llm.grouped_split import assign_splits, label_report, parted_groups, split_report
from millrace.llm.leakage import leaked_items, leaked_report
from millrace.llm.near_duplicates import near_duplicate_groups, near_duplicate_links, near_duplicate_pairs
from millrace.llm.packing import fill_report, pack, token_counts
from millrace.llm.proportional_sample import proportional_sample, sample_report, unfillable_cells
from millrace.llm.split_overlap import split_overlap_pairs, split_overlap_records, split_overlap_report
from millrace.llm.splitting import split_oversized
from millrace.session import written


def _t(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return unfillable_cells(_t(spark, d, "examples"), _t(spark, d, "sample_targets"))


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return proportional_sample(_t(spark, d, "examples"), _t(spark, d, "sample_targets"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return sample_report(_t(spark, d, "examples"), _t(spark, d, "sample_targets"))


def p1_joint_sample(spark: SparkSession, d: str) -> DataFrame:
    """One sample raked to the margins of all plans together."""
    return proportional_sample(_t(spark, d, "examples"), _t(spark, d, "sample_targets"), joint=True)


def p1_joint_report(spark: SparkSession, d: str) -> DataFrame:
    return sample_report(_t(spark, d, "examples"), _t(spark, d, "sample_targets"), joint=True)


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_oversized(_t(spark, d, "chunks"), _t(spark, d, "chunk_limits"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_pieces(spark, d).where("piece = 0").select("profile", "chunk_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return broken_pairs(_t(spark, d, "examples"))


def p3_defects(spark: SparkSession, d: str) -> DataFrame:
    return pair_defects(_t(spark, d, "examples"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return parted_groups(_t(spark, d, "examples"), _t(spark, d, "split_members"), _t(spark, d, "split_targets")).select("group_id", "id")


def p4_assign(spark: SparkSession, d: str) -> DataFrame:
    return assign_splits(_t(spark, d, "examples"), _t(spark, d, "split_targets"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return split_report(written(p4_assign(spark, d), "p4-report"), _t(spark, d, "split_targets"))


def p4_labels(spark: SparkSession, d: str) -> DataFrame:
    return label_report(written(p4_assign(spark, d), "p4-labels"), _t(spark, d, "examples"), _t(spark, d, "split_targets"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_pairs(_t(spark, d, "examples"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_groups(_t(spark, d, "examples"))


def p5_links(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_links(_t(spark, d, "examples"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return split_overlap_pairs(_t(spark, d, "examples"), _t(spark, d, "split_members"))


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    return split_overlap_records(_t(spark, d, "examples"), _t(spark, d, "split_members"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return split_overlap_report(_t(spark, d, "examples"), _t(spark, d, "split_members"))


def p7_placement(spark: SparkSession, d: str) -> DataFrame:
    return pack(token_counts(_t(spark, d, "documents")), _t(spark, d, "containers"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return pack(token_counts(_t(spark, d, "documents")), _t(spark, d, "containers").where("kind = 'long'")).where("piece = 1").select("doc_id")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return fill_report(p7_placement(spark, d), _t(spark, d, "containers"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(_t(spark, d, "documents"), _t(spark, d, "eval_items")).select("doc_id", "item_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return leaked_report(_t(spark, d, "documents"), _t(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike_pairs(_t(spark, d, "documents"))


def p9_members(spark: SparkSession, d: str) -> DataFrame:
    return lookalike_members(_t(spark, d, "documents"))


def p9_forms(spark: SparkSession, d: str) -> DataFrame:
    return canonicalise(_t(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [p1_found, p1_sample, p1_report, p1_joint_sample, p1_joint_report, p2_found, p2_pieces, p3_found, p3_defects, p4_found, p4_assign, p4_report, p4_labels, p5_found, p5_groups, p5_links]
    own += [p6_found, p6_report, p6_records, p7_found, p7_placement, p7_fill, p8_found, p8_report, p9_found, p9_members, p9_forms]
    return {f.__name__: f for f in own}


# A value's spelling-free form, and the words of a text.
_KEY = "regexp_replace(lower(coalesce({0}, '')), '[\\s_-]+', '', 'g')"
_WORDS = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+'))"


def _likeness_sql(sets: str, keep: str) -> str:
    return f"""
WITH s AS ({sets}), w AS (SELECT id, len(words) AS n, unnest(words) AS word FROM s),
common AS (SELECT a.id AS id_a, b.id AS id_b, a.n AS na, b.n AS nb, count(*) AS c FROM w a JOIN w b ON a.word = b.word AND a.id < b.id GROUP BY ALL)
SELECT DISTINCT id_a, id_b FROM common WHERE c >= 0.8 * (na + nb - c) - 1e-9 {keep}"""


def oracle_sql() -> dict[str, str]:
    cat, ans, split, project = (_KEY.format(c) for c in ("category", "answerable", "split", "project"))
    words5, words6 = (_WORDS.format(c) for c in ("coalesce(question, '') || ' ' || coalesce(answer, '')", "coalesce(question, '')"))
    # words, classes (one word set, named by its smallest id), links between classes, and what can be reached over links
    classes = f"""s AS (SELECT id, list_sort(min({words5})) AS words FROM examples WHERE id IS NOT NULL GROUP BY id), k AS (SELECT words, min(id) AS rep, count(*) AS m FROM s GROUP BY words),
w AS (SELECT rep, len(words) AS n, unnest(words) AS word FROM k), c AS (SELECT a.rep AS x, b.rep AS y, a.n AS na, b.n AS nb, count(*) AS c FROM w a JOIN w b ON a.word = b.word AND a.rep < b.rep GROUP BY ALL),
l AS (SELECT x, y, c / (na + nb - c)::DOUBLE AS likeness FROM c WHERE c >= 0.8 * (na + nb - c) - 1e-9)"""
    sides = f"""m AS (SELECT DISTINCT id, {split} AS split FROM split_members WHERE id IS NOT NULL), s AS (SELECT id, min({words6}) AS words, min(array_to_string(regexp_extract_all(lower(coalesce(question, '')), '[\\p{{L}}\\p{{N}}]+'), ' ')) AS record, min({project}) AS project FROM examples WHERE id IS NOT NULL GROUP BY id),
t AS (SELECT s.* FROM s WHERE id IN (SELECT id FROM m WHERE split = 'train')), v AS (SELECT s.*, split FROM s JOIN m USING (id) WHERE split IN ('validation', 'test')),
tw AS (SELECT id, len(words) AS n, unnest(words) AS word FROM t), vw AS (SELECT id, split, len(words) AS n, unnest(words) AS word FROM v),
alike AS (SELECT v_id, split, t_id FROM (SELECT vw.id AS v_id, vw.split AS split, tw.id AS t_id, vw.n AS na, tw.n AS nb, count(*) AS c FROM vw JOIN tw USING (word) GROUP BY ALL) WHERE c >= 0.8 * (na + nb - c) - 1e-9)"""
    root = "regexp_replace(id, '([-_](noise|var|aug)[0-9]+)+$', '', 'i')"
    return {
        "p1_found": f"""
WITH e AS (SELECT id, min({cat}) AS c, min({ans}) AS a FROM examples WHERE id IS NOT NULL GROUP BY id),
t AS (SELECT *, {cat} AS tc, {ans} AS ta FROM sample_targets)
SELECT t.plan, t.category, t.answerable FROM t LEFT JOIN e ON (t.tc = 'any' OR t.tc = e.c) AND (t.ta = 'any' OR t.ta = e.a)
GROUP BY t.plan, t.category, t.answerable, t.min_rows, t.sample_share, t.target_share
HAVING count(e.id) < greatest(t.min_rows, t.sample_share * t.target_share * (SELECT count(*) FROM e))""",
        "p2_found": """
WITH last AS (SELECT chunk_id, arg_max(content, loaded_at) AS content FROM chunks GROUP BY chunk_id)
SELECT profile, chunk_id FROM last, chunk_limits WHERE length(content) > max_chars""",
        "p4_found": f"""
WITH RECURSIVE e AS (SELECT DISTINCT id, {root} AS root, {project} AS project FROM examples WHERE id IS NOT NULL),
edge AS (SELECT DISTINCT root, project FROM e WHERE project <> ''),
reach AS (SELECT root, root AS top FROM (SELECT DISTINCT root FROM e) UNION SELECT y.root, r.top FROM reach r JOIN edge x ON x.root = r.root JOIN edge y ON y.project = x.project WHERE r.top = (SELECT min(z.root) FROM edge z WHERE z.project = x.project) OR r.root = r.top),
grp AS (SELECT root, min(top) AS g FROM reach GROUP BY root),
m AS (SELECT DISTINCT e.id, grp.g FROM e JOIN grp USING (root)),
s AS (SELECT DISTINCT id, {split} AS split FROM split_members WHERE {split} <> ''),
parted AS (SELECT g FROM m JOIN s USING (id) GROUP BY g HAVING count(DISTINCT split) > 1),
lead AS (SELECT g, min(id) AS group_id FROM m GROUP BY g)
SELECT lead.group_id, m.id FROM m JOIN lead USING (g) JOIN parted USING (g)""",
        "p5_found": _likeness_sql(f"SELECT id, min({_WORDS.format("coalesce(question, '') || ' ' || coalesce(answer, '')")}) AS words FROM examples WHERE id IS NOT NULL GROUP BY id", ""),
        "p5_links": f"WITH {classes} SELECT x AS id_a, y AS id_b, round(likeness, 6) AS likeness FROM l",
        "p5_groups": f"""WITH RECURSIVE {classes}, e AS (SELECT x, y FROM l UNION SELECT y, x FROM l), r AS (SELECT rep AS x, rep AS y FROM k UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y), g AS (SELECT x, min(y) AS group_id FROM r GROUP BY x), n AS (SELECT x, count(*) AS n_links FROM e GROUP BY x)
SELECT s.id, CASE WHEN len(s.words) = 0 THEN s.id ELSE k.rep END AS class_id, CASE WHEN len(s.words) = 0 THEN s.id ELSE g.group_id END AS group_id, CASE WHEN len(s.words) = 0 THEN 1 ELSE k.m END AS class_rows, coalesce(n.n_links, 0) AS n_links FROM s JOIN k USING (words) JOIN g ON g.x = k.rep LEFT JOIN n ON n.x = k.rep""",
        "p6_records": f"WITH {sides} SELECT v_id AS id, alike.split, min(t_id) AS train_id, (SELECT count(*) FROM t WHERE t.record <> '' AND t.record = any_value(v.record)) AS n_equal, count(*) AS n_alike FROM alike JOIN v ON v.id = v_id AND v.split = alike.split GROUP BY v_id, alike.split",
        "p6_report": f"""WITH {sides} SELECT split, project, count(*) AS n, count(*) FILTER (record <> '' AND record IN (SELECT record FROM t)) AS n_equal, count(*) FILTER ((record <> '' AND record IN (SELECT record FROM t)) OR (id, split) IN (SELECT (v_id, split) FROM alike)) AS n_overlap FROM v GROUP BY split, project""",
        "p6_found": _likeness_sql(
            f"SELECT id, min({_WORDS.format("coalesce(question, '')")}) AS words FROM examples WHERE id IN (SELECT id FROM split_members) GROUP BY id",
            f"AND EXISTS (SELECT 1 FROM split_members x, split_members y WHERE x.id = id_a AND y.id = id_b AND (({_KEY.format('x.split')} = 'train' AND {_KEY.format('y.split')} IN ('validation', 'test')) OR ({_KEY.format('y.split')} = 'train' AND {_KEY.format('x.split')} IN ('validation', 'test'))))",
        ),
    }
