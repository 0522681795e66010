"""Readers and writers of the engine's files. Every reader assigns a stable order."""

from __future__ import annotations

import dataclasses
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import vocabulary as V
from millrace.session import written

_S, _A = T.StringType(), T.ArrayType(T.StringType())
CHUNK = T.StructType([T.StructField("source", _S), T.StructField("heading", _S), T.StructField("content", _S), T.StructField("relevant", T.BooleanType()), T.StructField("relative_path", _S), T.StructField("heading_path", _A), T.StructField("content_hash", _S)])
AUDIT = T.StructType([T.StructField(n, T.BooleanType() if n == "from_cache" else _S) for n in ("teacher_provider", "teacher_model", "prompt_version", "generation_timestamp", "teacher_request_hash", "from_cache")])
EXAMPLE = T.StructType(
    [
        *[T.StructField(n, _S) for n in ("id", "question")],
        T.StructField("context", T.ArrayType(CHUNK)),
        *[T.StructField(n, _S) for n in ("answer", "category", "difficulty")],
        T.StructField("contains_code", T.BooleanType()),
        T.StructField("answerable", _S),
        T.StructField("source_count", T.IntegerType()),
        T.StructField("project", _S),
        *[T.StructField(n, _A) for n in ("relevant_sources", "must_include", "must_not_include", "facts", "unsupported_claims")],
        T.StructField("teacher_metadata", AUDIT),
        T.StructField("tags", _A),
        T.StructField("origin", _S),
    ]
)
SUFFIXES = (".md", ".mdx", ".txt")
# Directories that never hold documentation.
IGNORED = """
.git .hg .svn node_modules dist build .next out coverage venv .venv env __pycache__ .pytest_cache target .idea .vscode .cache .turbo
vendor site-packages .mypy_cache .ruff_cache .tox bower_components .gradle
""".split()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines with file name and line number. Files are split among tasks: lines are numbered within a task's part of a file, and the parts' counts, a row each, are summed up."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("i"), F.col("value").alias("line"))
    parts = raw.groupBy("file", "part").agg(F.min("i").alias("low"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.withColumn("before", before).drop("n")
    return raw.join(F.broadcast(offsets), ["file", "part"]).select("file", (F.col("before") + F.col("i") - F.col("low") + 1).alias("ord"), "line").where(F.trim("line") != "")


def _parsed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return read_lines(spark, path).withColumn("r", F.from_json("line", schema)).withColumn("bad", F.try_parse_json("line").isNull() | ~F.ltrim("line").startswith("{"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str = EXAMPLE, strict: bool = True) -> DataFrame:
    """Rows of JSON Lines with `file` and `ord`. A line that isn't an object is an error that names its place, or, not strict, is left out; read_report counts those."""
    lines = _parsed(spark, path, schema)
    if strict:
        place = F.concat(F.lit("bad JSON at "), "file", F.lit(":"), F.col("ord").cast("string"))
        checked = F.when(F.col("bad"), F.raise_error(place).cast(lines.schema["r"].dataType)).otherwise(F.col("r"))
        return lines.select("file", "ord", checked.alias("r")).select("file", "ord", "r.*")
    return lines.where(~F.col("bad")).select("file", "ord", "r.*")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Per file: lines, lines that aren't objects, and objects that aren't valid examples."""
    rows = _parsed(spark, path, EXAMPLE).select("file", "bad", "r.*").withColumn("invalid", ~F.col("bad") & ~valid_example())
    return rows.groupBy("file").agg(F.count("*").alias("n_lines"), F.count_if("bad").alias("n_bad"), F.count_if("invalid").alias("n_invalid"))


def valid_example():
    """Predicate of a row that is a usable example: texts not empty, at least one chunk with source, heading and content, known values."""
    full = lambda c: F.coalesce(F.length(F.trim(c)), F.lit(0)) > 0
    known = lambda c, values: F.col(c).isNull() | F.col(c).isin(*values)
    chunks = (F.coalesce(F.size("context"), F.lit(0)) > 0) & F.coalesce(F.forall("context", lambda x: full(x["source"]) & full(x["heading"]) & full(x["content"])), F.lit(False))
    return full(F.col("id")) & full(F.col("question")) & full(F.col("answer")) & chunks & known("category", V.CATEGORIES) & known("difficulty", V.DIFFICULTIES) & known("answerable", V.ANSWERABLE)


def read_examples(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Examples of JSON Lines; an invalid one is an error, or, not strict, left out (count them with valid_example)."""
    rows = read_jsonl(spark, path, EXAMPLE, strict)
    if strict:
        return rows.withColumn("id", F.when(~valid_example(), F.raise_error(F.concat(F.lit("invalid example at "), "file", F.lit(":"), F.col("ord").cast("string"))).cast("string")).otherwise(F.col("id")))
    return rows.where(valid_example())


def write_jsonl(rows: DataFrame, path: str) -> None:
    """JSON Lines without null fields."""
    rows.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def read_docs(spark: SparkSession, root: str, project: str | None = None) -> DataFrame:
    """project, relative_path, text of the documentation files under a folder; null text where a file isn't UTF-8.

    Ignored and hidden folders are left out. The first folder is the project; files at the root belong to `project`
    or the root's name.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = root.rstrip("/").rsplit("/", 1)[-1]
    # the path as listed, with the folder in front cut away
    rel = F.regexp_replace(F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))), "^.*?/" + "\\Q" + root.strip("/") + "\\E/", "")
    parts = F.split("relative_path", "/")
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    bad = F.exists(folders, lambda p: p.isin(*IGNORED) | p.startswith("."))
    rows = files.withColumn("relative_path", rel).where(F.lower("relative_path").rlike(r"\.(md|mdx|txt)$")).where(~bad)
    return rows.select(F.when(F.size(parts) > 1, parts[0]).otherwise(project or name).alias("project"), "relative_path", F.when(F.is_valid_utf8("content"), F.col("content").cast("string")).alias("text"))


def read_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Seed files (YAML with project and examples): a few hand-written files, read by the driver; project fills down, file and ord tell the place."""
    import yaml

    rows = []
    for path in sorted(Path(folder).glob("*.yaml")):
        spec = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
        for k, item in enumerate(spec.get("examples") or []):
            rows.append((item.get("id"), item.get("project") or spec.get("project"), item.get("question"), item.get("answer"), item.get("category"), item.get("difficulty"), item.get("answerable") or "full", list(item.get("sources") or []), list(item.get("distractors") or []), list(item.get("tags") or []), list(item.get("must_include") or []), bool(item.get("heldout")), path.name, k))
    return spark.createDataFrame(rows, "id string, project string, question string, answer string, category string, difficulty string, answerable string, sources array<string>, distractors array<string>, tags array<string>, must_include array<string>, heldout boolean, file string, ord long")


def read_config(path: str, kind: type):
    """A settings dataclass from a YAML file; values that aren't given keep their defaults, unknown names and wrong kinds are errors."""
    import yaml

    given = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    known = {f.name: f for f in dataclasses.fields(kind)}
    if extra := sorted(given.keys() - known.keys()):
        raise ValueError(f"unknown settings in {path}: {', '.join(extra)}")
    values = {}
    for name, value in given.items():
        default = getattr(kind(), name)
        if isinstance(default, tuple):
            value = tuple(value)
        if default is not None and not isinstance(value, type(default)) and not (isinstance(default, float) and isinstance(value, int)):
            raise ValueError(f"{name} in {path} must be {type(default).__name__}")
        values[name] = value
    return kind(**values)


def resolve_path(path: str, root: str = ".") -> Path:
    """A path as it stands where it is absolute, else under the root."""
    return Path(path) if Path(path).is_absolute() else Path(root) / path


def project_label(folder: Column) -> Column:
    """A project's name from its folder: the last part, or the one above where the last only says that it holds documentation; blanks become dashes."""
    parts = F.filter(F.split(F.coalesce(folder, F.lit("")), "/"), lambda p: p != "")
    last, above = F.try_element_at(parts, F.lit(-1)), F.try_element_at(parts, F.lit(-2))
    generic = F.lower(last).isin("docs", "doc", "documentation", "wiki")
    return F.replace(F.coalesce(F.when(generic & above.isNotNull(), above).otherwise(last), F.lit("")), F.lit(" "), F.lit("-"))


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """id, message, answer, style, domain, traits of chat records (JSON Lines with messages and meta), as import_chats takes them."""
    rows = read_jsonl(spark, path, "messages array<struct<role:string,content:string>>, meta struct<id:string,lang:string,domain:string,context_style:string,n_chunks:int,traits:array<string>>")
    turn = lambda k: F.try_element_at("messages", F.lit(k))["content"]
    return rows.select("meta.id", turn(2).alias("message"), turn(3).alias("answer"), F.col("meta.context_style").alias("style"), "meta.domain", "meta.traits")


def read_patches(spark: SparkSession, path: str) -> DataFrame:
    """id, answer of a patch file (JSON with examples)."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "examples array<struct<id:string,answer:string>>").alias("r"))
    return raw.select(F.inline("r.examples"))


def read_context(spark: SparkSession, spec: str) -> DataFrame:
    """Chunks (source, heading, content) that a context specification names: a folder of Markdown files, one Markdown file, the first row of JSON Lines, or JSON with a list of chunks or an object with `context`."""
    from millrace.operators.chunking import chunk_files

    path = Path(spec)
    chunk = "array<struct<source:string,heading:string,content:string>>"
    if not path.exists():
        raise FileNotFoundError(f"context not found: {spec}")
    if path.is_dir() or path.suffix == ".md":
        found = read_docs(spark, str(path if path.is_dir() else path.parent)).where(F.lower("relative_path").endswith(".md"))
        found = found if path.is_dir() else found.where(F.element_at(F.split("relative_path", "/"), -1) == path.name).where(~F.contains("relative_path", F.lit("/")))
        return chunk_files(found).select("source", "heading", "content")
    if path.suffix == ".jsonl":
        first = read_jsonl(spark, spec, f"context {chunk}").orderBy("file", "ord").limit(1)
        return first.select(F.inline("context"))
    if path.suffix == ".json":
        raw = spark.read.text(spec, wholetext=True).select(F.ltrim("value").alias("v"))
        listed = F.when(F.col("v").startswith("["), F.from_json("v", chunk)).otherwise(F.from_json("v", f"context {chunk}")["context"])
        return raw.select(F.inline(listed))
    raise ValueError(f"unsupported context file: {path.suffix}")


def stage_corpus(spark: SparkSession, roots: list[str], least: int, folder: str) -> DataFrame:
    """Copies the documentation of every root with at least `least` sections to folder/files (project, relative_path, text) and returns, and writes to folder/manifest, a row per project: files, sections, whether it was staged, and in the last row (null project) the totals of the staged ones."""
    from millrace.operators.chunking import chunk_files

    docs = union_sources(*[read_docs(spark, r).withColumn("project", project_label(F.lit(str(Path(r).resolve())))) for r in roots]).drop("source_rank")
    docs = written(docs.where("text is not null"), "corpus")
    per = docs.groupBy("project").agg(F.count("*").alias("n_files")).join(chunk_files(docs).groupBy("project").agg(F.count("*").alias("n_sections")), "project", "left")
    per = written(per.select("project", "n_files", F.coalesce("n_sections", F.lit(0)).cast("long").alias("n_sections")).withColumn("staged", F.col("n_sections") >= least), "corpus-projects")
    docs.join(per.where("staged").select("project"), "project", "left_semi").write.mode("overwrite").partitionBy("project").parquet(f"{folder}/files")
    totals = per.where("staged").agg(F.lit(None).cast("string").alias("project"), F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_files"), F.coalesce(F.sum("n_sections"), F.lit(0)).alias("n_sections"), F.lit(True).alias("staged"))
    out = per.unionByName(totals)
    out.write.mode("overwrite").json(f"{folder}/manifest")
    return out


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids, one per line; no file, no ids."""
    if "://" not in path and not Path(path).exists():
        return spark.createDataFrame([], "id string")
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''").distinct()


def write_ids(old: DataFrame, new: DataFrame, path: str) -> None:
    old.select("id").union(new.select("id")).distinct().orderBy("id").select(F.col("id").alias("value")).write.mode("overwrite").text(path)


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """id, approved, reason from a JSON map of id to decision."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string, struct<approved: boolean, reason: string>>").alias("m"))
    return raw.select(F.explode("m").alias("id", "d")).select("id", "d.approved", "d.reason")


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of several sources with a rank of the source, so that an order over all of them exists."""
    out = None
    for k, df in enumerate(frames):
        ranked = df.withColumn("source_rank", F.lit(k))
        out = ranked if out is None else out.unionByName(ranked, allowMissingColumns=True)
    return out


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds `ord`, dense within the order given. Ranges of the first column are numbered in parallel: no task holds all rows."""
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    parts = written(parts, "numbered")
    base = parts.groupBy("_p").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "base")
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return parts.join(F.broadcast(base), "_p").withColumn("ord", F.col("base") + inside).drop("_p", "base")
