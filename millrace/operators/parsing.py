"""Tolerant reading of generated responses and of context in three encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions import vocabulary as V

# Patterns of the encodings.
FENCED = r"(?s)```(?:json)?\s*(.*?)```"
QUESTION = r"(?m)^(?:DOMANDA|QUESTION):\s*"
MD_HEAD = r"(?m)^---\s*\[(D\d+)\]\s*(.+?)\s*·\s*([\d-]+)\s*·.*?---\s*$"
XML_DOC = r"""(?s)<doc\s+id="([^"]+)"\s+source="([^"]+)"\s+date="([^"]+)"[^>]*>(.*?)</doc>"""
DOC_REF = r"\[(D\d+)\]"
CHUNKS = "array<struct<id:string,source:string,date:string,content:string>>"


def payload(raw: Column | str) -> Column:
    """The first part of a response that parses as JSON, as a variant: fenced blocks in turn, then from the first '[' to the last ']', then all of it. Null without any."""
    c = F.coalesce(F.col(raw) if isinstance(raw, str) else raw, F.lit(""))
    start, end = F.instr(c, "["), F.length(c) - F.instr(F.reverse(c), "]") + 1
    outer = F.when((start > 0) & (F.instr(F.reverse(c), "]") > 0) & (end > start), F.substring(c, start, end - start + 1))
    options = F.concat(F.regexp_extract_all(c, F.lit(FENCED), 1), F.array(outer, c))
    good = F.filter(options, lambda x: x.isNotNull() & (X.stripped(x) != "") & F.try_parse_json(x).isNotNull())
    return F.try_parse_json(F.try_element_at(good, F.lit(1)))


def listed(parsed: Column) -> Column:
    """Elements of a payload as JSON strings: of `examples`, else of `items`, else of the array itself, else the object alone."""
    as_array = lambda path: F.try_variant_get(parsed, path, "array<variant>")
    filled = lambda a: F.when(F.size(a) > 0, a)
    kind = F.schema_of_variant(parsed)
    single = F.when(kind.startswith("OBJECT"), F.array(parsed))
    found = F.coalesce(filled(as_array("$.examples")), filled(as_array("$.items")), as_array("$"), single)
    return F.transform(found, lambda x: F.to_json(x))


def parse_responses(responses: DataFrame, raw: str = "response") -> DataFrame:
    """Adds parsed (whether any JSON was found), items (JSON of each element) and head (first 800 characters where nothing parsed)."""
    df = responses.withColumn("_p", payload(raw))
    return df.withColumns({"parsed": F.col("_p").isNotNull(), "items": F.coalesce(F.when(F.col("_p").isNotNull(), listed(F.col("_p"))), F.array().cast("array<string>")), "head": F.when(F.col("_p").isNull(), F.substring(F.coalesce(raw, F.lit("")), 1, 800))}).drop("_p")


ITEM = "question string, answer string, category string, difficulty string, answerable string, answerability string, required_sources array<string>, relevant_sources array<string>, must_include array<string>, facts array<string>, unsupported_claims array<string>"


def items_to_examples(items: DataFrame, item: str = "item", project: str = "project", teacher: str = "teacher") -> DataFrame:
    """Example columns of every item object that has a question and an answer: aliases resolved, values lower-cased, unknown answerability full; `rejected` tells an unknown category or difficulty."""
    j = F.from_json(item, ITEM)
    df = items.withColumn("_j", j).withColumns({"question": X.stripped(F.col("_j.question")), "answer": X.stripped(F.col("_j.answer"))}).where("question <> '' and answer <> ''")
    label = F.lower(F.coalesce(F.nullif(F.col("_j.answerable"), F.lit("")), F.nullif(F.col("_j.answerability"), F.lit("")), F.lit("full")))
    listed_ = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), X.stripped), lambda s: s != "")
    sources = F.when(F.size(listed_(F.col("_j.required_sources"))) > 0, listed_(F.col("_j.required_sources"))).otherwise(listed_(F.col("_j.relevant_sources")))
    out = df.withColumns(
        {
            "id": X.stable_id(F.concat(F.lit("gen-"), F.coalesce(project, F.lit(""))), "question", "answer"),
            "answerable": F.when(label.isin(*V.ANSWERABLE), label).otherwise("full"),
            "category": F.lower(F.coalesce(F.nullif(F.col("_j.category"), F.lit("")), F.lit("how_it_works"))),
            "difficulty": F.lower(F.coalesce(F.nullif(F.col("_j.difficulty"), F.lit("")), F.lit("medium"))),
            "relevant_sources": sources,
            "must_include": listed_(F.col("_j.must_include")),
            "facts": listed_(F.col("_j.facts")),
            "unsupported_claims": listed_(F.col("_j.unsupported_claims")),
            "origin": F.concat(F.lit("teacher:"), F.coalesce(teacher, F.lit("unknown"))),
        }
    ).drop("_j")
    return out.withColumn("rejected", ~(F.col("category").isin(V.CATEGORIES) & F.col("difficulty").isin(*V.DIFFICULTIES)))


def clean_source(c: Column) -> Column:
    """A source name without dashes, which separate the parts of a citation."""
    return X.stripped(F.regexp_replace(c, r"(?U)\s*[-–—]\s*", " / "))


def split_question(message: Column) -> Column:
    """(context, question) of a user message, parted at the first line that starts with a question marker; null without one."""
    at = F.regexp_instr(message, F.lit(QUESTION))
    mark = F.regexp_extract(message, QUESTION, 0)
    return F.when(at > 0, F.struct(X.stripped(F.substring(message, F.lit(1), at - 1)).alias("context"), X.stripped(F.substring(message, at + F.length(mark), F.lit(1 << 30))).alias("question")))


def parse_context(context: Column, style: Column) -> Column:
    """Chunks (id, source, date, content) of context text in style json, xml or md; null for other styles."""
    zipped = lambda ids, sources, dates, contents: F.transform(F.arrays_zip(ids.alias("i"), sources.alias("s"), dates.alias("d"), contents.alias("c")), lambda z: F.struct(z["i"].alias("id"), clean_source(z["s"]).alias("source"), z["d"].alias("date"), X.stripped(z["c"]).alias("content")))
    group = lambda p, k: F.regexp_extract_all(context, F.lit(p), k)
    xml = zipped(*[group(XML_DOC, k) for k in (1, 2, 3, 4)])
    bodies = F.split(context, MD_HEAD)
    md = zipped(*[group(MD_HEAD, k) for k in (1, 2, 3)], F.slice(bodies, F.lit(2), F.greatest(F.size(bodies) - 1, F.lit(0))))
    raw = F.from_json(F.substring(context, F.greatest(F.instr(context, "["), F.lit(1)), F.lit(1 << 30)), "array<struct<doc_id:string,source:string,date:string,content:string>>")
    js = F.transform(raw, lambda d: F.struct(d["doc_id"].alias("id"), clean_source(d["source"]).alias("source"), d["date"].alias("date"), d["content"].alias("content")))
    return F.when(style == "json", js.cast(CHUNKS)).when(style == "xml", xml.cast(CHUNKS)).when(style == "md", md.cast(CHUNKS))


def import_chats(records: DataFrame, patches: DataFrame) -> DataFrame:
    """Chat records (id, message, answer, style, domain, traits) as examples, with `error` where one can't be converted.

    patches: id, answer; a patch replaces the answer. References [Dn] in answers become citations of the chunk;
    unknown ones are an error.
    """
    patch = patches.where("id is not null").groupBy("id").agg(F.max("answer").alias("patched"))
    df = records.join(patch, "id", "left").withColumns({"_q": split_question(F.col("message")), "answer": F.coalesce(F.nullif("patched", F.lit("")), "answer")})
    df = df.withColumns({"question": F.col("_q.question"), "chunks": parse_context(F.col("_q.context"), F.col("style"))})
    heading = lambda c: F.concat(c["id"], F.lit(" · "), c["date"])
    unknown = F.array_except(F.regexp_extract_all("answer", F.lit(DOC_REF), 1), F.transform("chunks", lambda c: c["id"]))
    error = (
        F.when(F.col("_q").isNull(), "no question marker")
        .when(F.col("chunks").isNull(), "unknown context style")
        .when(F.size("chunks") == 0, "no chunks parsed")
        .when(F.size(unknown) > 0, F.concat(F.lit("answer cites "), F.array_join(F.array_sort(unknown), ", "), F.lit(", not in context")))
    )
    cited = F.aggregate("chunks", F.col("answer"), lambda acc, c: F.replace(acc, F.concat(F.lit("["), c["id"], F.lit("]")), F.concat(F.lit("["), c["source"], F.lit(" — "), heading(c), F.lit("]"))))
    traits = F.coalesce("traits", F.array().cast("array<string>"))
    category = F.when(F.array_contains(traits, "conflict"), "contradictory_context").when(F.array_contains(traits, "gap"), "partially_answerable").when(F.size("chunks") > 2, "multi_source").otherwise("how_it_works")
    gap = F.array_contains(traits, "gap") & ~F.array_contains(traits, "conflict")
    return df.select(
        "id",
        "question",
        F.transform("chunks", lambda c: F.struct(c["source"].alias("source"), heading(c).alias("heading"), c["content"].alias("content"))).alias("context"),
        F.when(error.isNull(), cited).alias("answer"),
        category.alias("category"),
        F.when(gap, "partial").otherwise("full").alias("answerable"),
        F.lit("medium").alias("difficulty"),
        (F.concat(F.lit("rag-"), F.coalesce("domain", F.lit(""))) if "domain" in records.columns else F.lit(None).cast("string")).alias("project"),
        F.array_sort(F.transform(F.filter("chunks", lambda c: F.contains(cited, F.concat(F.lit("["), c["source"], F.lit(" — "), heading(c), F.lit("]")))), lambda c: F.concat(c["source"], F.lit("#"), heading(c)))).alias("relevant_sources"),
        F.concat(F.array(F.lit("structured-layout")), traits).alias("tags"),
        F.lit("structured_response").alias("origin"),
        error.alias("error"),
    )


def unused_patches(records: DataFrame, patches: DataFrame) -> DataFrame:
    return patches.select("id").distinct().join(records.select("id"), "id", "left_anti")


def mock_response(context: Column) -> Column:
    """What the offline provider answers: one grounded item on the first chunk and one unanswerable item, as JSON."""
    first = F.try_element_at(context, F.lit(1))
    cite = F.concat(F.lit("["), first["source"], F.lit(" — "), first["heading"], F.lit("]"))
    made = lambda q, a, label, category, refs: F.struct(q.alias("question"), a.alias("answer"), F.lit(label).alias("answerable"), F.lit(category).alias("category"), refs.alias("required_sources"))
    grounded = made(F.concat(F.lit("What does the section "), first["heading"], F.lit(" say?")), F.concat(X.first_sentence(first["content"]), F.lit(" "), cite), "full", "how_it_works", F.array(F.concat(first["source"], F.lit("#"), first["heading"])))
    absent = made(F.concat(F.lit("What is the response time guaranteed by "), first["heading"], F.lit("?")), F.concat(F.lit("The provided sections do not specify it: "), cite, F.lit(" covers other matters.")), "none", "unanswerable", F.array().cast("array<string>"))
    return F.to_json(F.struct(F.array(grounded, absent).alias("examples")))
