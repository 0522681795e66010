"""Composition of examples: resolved seeds, distractor variants, probe-checked negatives, planned bundles.

Every draw is a hash of a seed and a stable key (functions.hashing), so results don't depend on partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions.hashing import hash_order, pick, uniform
from millrace.operators import prompting
from millrace.session import written

# Headings that say nothing about their section, and categories of answerable questions by weight.
GENERIC_HEADINGS = ("purpose", "overview", "scope", "runtime", "components", "layers")
CATEGORY_WEIGHTS = {
    "how_it_works": 1, "api": 2, "service": 1, "dependency": 1, "architecture": 1, "database": 1, "data_flow": 1, "configuration": 1,
    "integration": 1, "error_handling": 1, "bug_investigation": 3, "multi_source": 1, "extension_guidance": 3,
}
ANSWERABLE_CATEGORIES = [c for c, weight in CATEGORY_WEIGHTS.items() for _ in range(weight)]

#: Draws per example in the first round of a draw; examples still short draw four times as many in the next one.
FIRST_DRAWS = 8
#: Foreign sections that there must be for an example to get distractors at all.
LEAST_POOL = 4

# Questions that documentation rarely answers: key, question, topic, what would be needed (Italian, English), and probes whose presence means that it might.
NEGATIVES = {
    "train": [
        ("p99", "Qual è il tempo di risposta p99 di {subject}?", "What is the p99 response time of {subject}?", "il tempo di risposta p99", "the p99 response time", "i dati di monitoraggio", "monitoring data", ["p99", "p95", "latency", "latenza", "percentile"]),
        ("oncall", "Chi è reperibile per {subject}?", "Who is on call for {subject}?", "il turno di reperibilità", "the on-call rota", "il calendario dei turni", "the rota calendar", ["on call", "on-call", "reperibil", "pager"]),
        ("memory", "Quanta memoria usa {subject} a regime?", "How much memory does {subject} use at steady state?", "il consumo di memoria", "the memory footprint", "un profilo di esecuzione", "a runtime profile", ["memory", "memoria", "heap", "rss"]),
        ("backup", "Ogni quanto si fa il backup di {subject}?", "How often is {subject} backed up?", "la frequenza dei backup", "the backup schedule", "il piano di backup", "the backup plan", ["backup", "snapshot", "restore"]),
        ("license", "Con quale licenza è distribuito {subject}?", "Under which licence is {subject} distributed?", "la licenza", "the licence", "il file di licenza", "the licence file", ["license", "licence", "licenza", "copyright"]),
        ("coverage", "Qual è la copertura dei test di {subject}?", "What is the test coverage of {subject}?", "la copertura dei test", "the test coverage", "il rapporto di copertura", "the coverage report", ["coverage", "copertura", "unit test"]),
        ("region", "In quali regioni gira {subject}?", "In which regions does {subject} run?", "le regioni di esecuzione", "the deployment regions", "la mappa dei rilasci", "the deployment map", ["eu-west", "us-east", "datacenter", "availability zone"]),
        ("audit", "Quando è stata l'ultima revisione di sicurezza di {subject}?", "When was the last security review of {subject}?", "la revisione di sicurezza", "the security review", "il verbale della revisione", "the review minutes", ["security review", "pentest", "vulnerab", "revisione di sicurezza"]),
        ("roadmap", "Che cosa è previsto per la prossima versione di {subject}?", "What is planned for the next version of {subject}?", "i piani futuri", "the plans for it", "la tabella di marcia", "the roadmap", ["roadmap", "planned", "milestone", "prossima versione"]),
        ("root_cause", "Quale modifica ha causato l'ultimo guasto di {subject}?", "Which change caused the last outage of {subject}?", "la causa del guasto", "the cause of the outage", "i log e la cronologia", "logs and history", ["outage", "incident", "post-mortem", "guasto"]),
    ],
    "eval": [
        ("throughput", "Quante richieste al secondo regge {subject}?", "How many requests per second does {subject} sustain?", "la portata massima", "the peak throughput", "una prova di carico", "a load test", ["requests per second", "rps", "throughput", "richieste al secondo"]),
        ("encryption", "Con quale algoritmo cifra i dati {subject}?", "Which cipher does {subject} encrypt data with?", "l'algoritmo di cifratura", "the cipher", "la specifica di sicurezza", "the security specification", ["aes", "cipher", "encrypt", "cifra"]),
        ("retention", "Per quanto tempo {subject} conserva i log?", "How long does {subject} keep its logs?", "la conservazione dei log", "the log retention", "la politica di conservazione", "the retention policy", ["log retention", "conservazione dei log", "retained for"]),
        ("browser", "Quali browser supporta {subject}?", "Which browsers does {subject} support?", "i browser supportati", "the supported browsers", "la matrice di compatibilità", "the compatibility matrix", ["browser", "chrome", "firefox", "safari"]),
        ("startup", "Quanto impiega {subject} ad avviarsi?", "How long does {subject} take to start?", "il tempo di avvio", "the start-up time", "una misura dell'avvio", "a start-up measurement", ["startup time", "boot time", "tempo di avvio"]),
        ("accessibility", "{subject} rispetta le linee guida di accessibilità?", "Does {subject} follow accessibility guidelines?", "l'accessibilità", "accessibility", "una verifica di accessibilità", "an accessibility audit", ["wcag", "accessib", "screen reader"]),
        ("training", "Esiste un corso su {subject}?", "Is there a course on {subject}?", "la formazione", "training material", "il catalogo dei corsi", "the course catalogue", ["tutorial", "workshop", "corso", "course"]),
        ("hardware", "Su quale hardware è provato {subject}?", "On which hardware is {subject} tested?", "l'hardware di prova", "the test hardware", "l'elenco delle macchine", "the machine list", ["arm64", "x86", "hardware", "raspberry"]),
        ("author", "Chi ha scritto la prima versione di {subject}?", "Who wrote the first version of {subject}?", "l'autore originale", "the original author", "la storia del repository", "the repository history", ["author", "autore", "written by"]),
        ("language", "In quale versione del linguaggio è scritto {subject}?", "Which language version is {subject} written in?", "la versione del linguaggio", "the language version", "i file di build", "the build files", ["python 3", "java 1", "golang", "typescript"]),
    ],
}
REFUSALS_IT = ["Le sezioni fornite trattano {headings}, ma non riportano {topic}. Servirebbe consultare {need}.", "Il contesto non specifica {topic} per {subject}: copre soltanto {headings}. Servirebbero {need}."]
REFUSALS_EN = ["The provided sections cover {headings} but do not specify {topic}. You would need {need}.", "This is not documented: the blocks describe {headings} and say nothing about {topic} of {subject}. Look at {need}."]


def chunk_key(source: Column | str = "source", heading: Column | str = "heading") -> Column:
    return F.concat(X.stripped(source), F.lit("#"), X.stripped(heading))


def reference(c: Column, project: Column) -> Column:
    """`[project:]source#heading` as a struct. A colon marks a project only in front of the first '#', so headings may have colons."""
    before = F.substring_index(c, "#", 1)
    named = F.contains(before, F.lit(":"))
    after = F.when(F.contains(c, F.lit("#")), F.substring(c, F.instr(c, "#") + 1, F.lit(1 << 30))).otherwise(F.lit(""))
    return F.struct(
        F.when(named, X.stripped(F.substring_index(before, ":", 1))).otherwise(project).alias("project"),
        X.stripped(F.when(named, F.substring(before, F.instr(before, ":") + 1, F.lit(1 << 30))).otherwise(before)).alias("source"),
        X.stripped(after).alias("heading"),
    )


def _resolved(seeds: DataFrame, index: DataFrame, strict: bool) -> DataFrame:
    """Per id: chunks (array of pos, chunk, by position in `sources`) and missing references."""
    refs = seeds.select("id", "project", F.posexplode("sources").alias("pos", "text")).select("id", "pos", "text", reference(F.col("text"), F.col("project")).alias("r")).select("id", "pos", "text", "r.*")
    chunks = index.select("project", X.stripped("source").alias("source"), X.stripped("heading").alias("heading"), F.struct("source", "heading", "content").alias("chunk"))
    found = refs.join(chunks, ["project", "source", "heading"], "left")
    if strict:
        found = found.withColumn("chunk", F.coalesce("chunk", F.raise_error(F.concat(F.lit("no section for "), "text")).cast(found.schema["chunk"].dataType)))
    return found.groupBy("id").agg(F.array_sort(F.collect_list(F.when(F.col("chunk").isNotNull(), F.struct("pos", "chunk")))).alias("chunks"), F.array_sort(F.collect_list(F.when(F.col("chunk").isNull(), F.col("text")))).alias("missing"))


def resolve(seeds: DataFrame, index: DataFrame, strict: bool = True) -> DataFrame:
    """Seeds (id, project, sources) with their chunks as `context`, in the order of the references.

    index: one row per (project, source, heading). A reference without a chunk is an error when the query runs, or,
    not strict, listed in `missing`.
    """
    return seeds.join(_resolved(seeds, index, strict).select("id", F.transform("chunks", lambda x: x["chunk"]).alias("context"), "missing"), "id")


def _next_prime(n: int) -> int:
    n = max(2, n)
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def ring(index: DataFrame, seed: int) -> tuple[DataFrame, DataFrame, int]:
    """Sections with their `rank` from 0 in an order by project, sections of a project in hash order; the projects' first rank and number of sections; and the number of all sections.

    Ranks are counted per project and the projects' sizes summed up, so no task holds all sections.
    """
    sizes = index.groupBy("project").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("project").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = written(sizes.withColumn("offset", before), "project-offsets")
    inside = F.row_number().over(Window.partitionBy("project").orderBy(hash_order(seed, "project", "source", "heading"), "source", "heading")) - 1
    ranked = index.withColumn("_inside", inside).join(offsets, "project").withColumn("rank", F.col("offset") + F.col("_inside")).drop("_inside", "n", "offset")
    total = offsets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return written(ranked, "section-ranks"), offsets, total


def drawn_from_others(wanted: DataFrame, sections: DataFrame, offsets: DataFrame, total: int, seed: int) -> DataFrame:
    """For every row of wanted (id, own, own_keys, k): id, pos and section of k sections of other projects without a key of own_keys, or of all there are if they are fewer.

    An example goes through the foreign sections in an order of its own, (start + draw * stride) modulo a prime, which
    comes to each of them once; numbers beyond the last foreign section are passed over. A draw is an equi-join on
    the section's rank. Examples that still lack sections go on with four times as many draws, to the end of their
    order if need be, so nothing is missed, and no example meets more sections than it needs about.
    """
    prime = _next_prime(total)
    place = lambda tag, n: F.floor(uniform(seed, F.lit(tag), "id") * n).cast("long")
    left = written(
        wanted.join(offsets.withColumnRenamed("project", "own"), "own", "left").select("id", "own", "own_keys", "k", F.coalesce("offset", F.lit(0)).alias("offset"), F.coalesce("n", F.lit(0)).alias("n"), place("start", prime).alias("start"), (place("stride", prime - 1) + 1).alias("stride"), F.lit(0).alias("have")),
        "draws-open",
    )
    found, done, step = [], 0, FIRST_DRAWS
    while done < prime and not left.isEmpty():
        until = min(prime, done + step)
        each = left.withColumn("draw", F.explode(F.sequence(F.lit(done), F.lit(until - 1)).cast("array<long>")))
        number = F.pmod(F.col("start") + F.col("draw") * F.col("stride"), F.lit(prime))
        each = each.withColumn("number", number).where(F.col("number") < F.lit(total) - F.col("n")).withColumn("rank", F.when(F.col("number") < F.col("offset"), F.col("number")).otherwise(F.col("number") + F.col("n")))
        met = each.join(sections.select("rank", "project", "source", "heading", "content"), "rank").where(~F.array_contains("own_keys", chunk_key()))
        order = Window.partitionBy("id").orderBy("draw")
        new = met.withColumn("pos", F.row_number().over(order) + F.col("have")).where(F.col("pos") <= F.col("k")).select("id", "pos", "project", "source", "heading", "content")
        found.append(written(new, "draws"))
        more = found[-1].groupBy("id").agg(F.count("*").alias("m"))
        left = written(left.join(more, "id", "left").withColumn("have", F.col("have") + F.coalesce("m", F.lit(0)).cast("int")).drop("m").where("have < k"), "draws-open")
        done, step = until, step * 4
    out = found[0] if found else sections.where("false").select(F.lit("").alias("id"), F.lit(0).alias("pos"), "project", "source", "heading", "content")
    for more in found[1:]:
        out = out.union(more)
    return out


def distractors(examples: DataFrame, index: DataFrame, least: int = 3, most: int = 4, seed: int = 43) -> DataFrame:
    """id, pos, and the chunks (project, source, heading, content) drawn as distractors: between least and most per example, from other projects, none with an own chunk's key.

    Eligible are answerable examples with at least LEAST_POOL such sections. How many an example gets is drawn by
    hash; it gets fewer only where LEAST_POOL is below `most` and no more exist.
    """
    sections, offsets, total = ring(index.select("project", "source", "heading", "content"), seed)
    wanted = examples.where("coalesce(answerable, 'full') <> 'none'").select(
        "id",
        F.coalesce("project", F.lit("")).alias("own"),
        F.coalesce(F.transform("context", lambda c: chunk_key(c["source"], c["heading"])), F.array().cast("array<string>")).alias("own_keys"),
        F.lit(max(most, LEAST_POOL)).alias("k"),
    )
    drawn = written(drawn_from_others(wanted, sections, offsets, total, seed), "distractors")
    eligible = drawn.where(F.col("pos") == LEAST_POOL).select("id")
    k = F.floor(uniform(seed, F.lit("k"), "id") * (most - least + 1)).cast("int") + least
    return drawn.where(F.col("pos") <= k).join(eligible, "id", "left_semi")


def seed_examples(seeds: DataFrame, index: DataFrame, seed: int = 42, strict: bool = True) -> DataFrame:
    """Examples of seeds (id, project, question, answer, category, difficulty, answerable, sources, distractors, must_include, tags).

    Both lists of references are resolved as in resolve(), chunks of sources marked relevant and the others not, in
    hash order; answerable is full where not given; tags get 'seed', and 'distractor' where there are any.
    """
    none = F.array().cast("array<string>")
    filled = seeds.withColumns({c: F.coalesce(c, none) if c in seeds.columns else none for c in ("sources", "distractors", "must_include", "must_not_include", "tags")})
    both = filled.withColumns({"n_sources": F.size("sources"), "sources": F.concat("sources", "distractors")})
    found = both.join(_resolved(both, index, strict), "id")
    marked = F.transform("chunks", lambda c: F.struct(c["chunk"]["source"].alias("source"), c["chunk"]["heading"].alias("heading"), c["chunk"]["content"].alias("content"), (c["pos"] < F.col("n_sources")).alias("relevant")))
    gold = F.transform(F.filter("chunks", lambda c: c["pos"] < F.col("n_sources")), lambda c: F.concat(c["chunk"]["source"], F.lit("#"), c["chunk"]["heading"]))
    return found.select(
        "id", "project", "question", "answer", "category", "difficulty", "must_include", "must_not_include", "missing",
        F.coalesce("answerable", F.lit("full")).alias("answerable"),
        shuffled(marked, seed, F.col("id")).alias("context"),
        gold.alias("relevant_sources"),
        F.concat("tags", F.array(F.lit("seed")), F.when(F.size("distractors") > 0, F.array(F.lit("distractor"))).otherwise(none)).alias("tags"),
        F.lit("seed").alias("origin"),
    )


def single_plans(index: DataFrame, least: int = 1, most: int = 4, sizes: tuple[int, ...] = (2, 3, 4, 5), noise: float = 0.35, unanswerable: float = 0.25, seed: int = 7) -> DataFrame:
    """One call per section for one question each: as draw_bundles, with least to most distractors and a flag whether to ask an unanswerable question."""
    drawn = draw_bundles(index, PlanConfig(sizes=sizes, distractors=noise, least=least, most=most, conflict=0.0, seed=seed, batch=1))
    return drawn.select("plan_id", "project", "context", "n_relevant", "n_distractors", (uniform(seed, "plan_id", F.lit("unanswerable")) < unanswerable).alias("ask_unanswerable"))


def variants(examples: DataFrame, index: DataFrame, seed: int = 43, suffix: str = "-noise1", least: int = 3, most: int = 4) -> DataFrame:
    """Examples with distractors mixed in: new id, context in hash order with own chunks relevant and others not, tags 'distractor' and 'augmented', source_count."""
    drawn = distractors(examples, index, least, most, seed).groupBy("id").agg(F.collect_list(F.struct("source", "heading", "content", F.lit(False).alias("relevant"))).alias("noise"))
    own = F.transform("context", lambda c: F.struct(c["source"].alias("source"), c["heading"].alias("heading"), c["content"].alias("content"), F.coalesce(c["relevant"], F.lit(True)).alias("relevant")))
    eligible = examples.where("coalesce(answerable, 'full') <> 'none'").where(~F.array_contains(F.coalesce("tags", F.array().cast("array<string>")), "distractor"))
    mixed = eligible.join(drawn, "id").withColumn("context", shuffled(F.concat(own, "noise"), seed, F.col("id")))
    return mixed.withColumns({"id": F.concat("id", F.lit(suffix)), "source_count": F.size("context"), "tags": F.array_sort(F.array_union(F.coalesce("tags", F.array().cast("array<string>")), F.array(F.lit("distractor"), F.lit("augmented"))))}).drop("noise")


def shuffled(context: Column, seed: int, key: Column) -> Column:
    """Chunks in an order that depends on seed, key and chunk only."""
    keyed = F.transform(context, lambda c: F.struct(hash_order(seed, key, chunk_key(c["source"], c["heading"])).alias("h"), c.alias("c")))
    return F.transform(F.array_sort(keyed, lambda a, b: F.when(a["h"] < b["h"], -1).when(a["h"] > b["h"], 1).otherwise(0)), lambda x: x["c"])


def headings_phrase(headings: Column, joiner: str, left: str, right: str) -> Column:
    """First three headings, quoted: "a", "b" and "c"."""
    names = F.transform(F.slice(headings, 1, 3), lambda h: F.concat(F.lit(left), h, F.lit(right)))
    return F.when(F.size(names) <= 1, F.array_join(names, "")).otherwise(F.concat(F.array_join(F.slice(names, F.lit(1), F.greatest(F.size(names) - 1, F.lit(1))), ", "), F.lit(joiner), F.element_at(names, F.greatest(F.size(names), F.lit(1)))))


def fill(template: Column, **parts: Column) -> Column:
    for name, part in parts.items():
        template = F.replace(template, F.lit("{" + name + "}"), part)
    return template


def negatives(index: DataFrame, per_project: int, which: str = "train", seed: int = 44, attempts: int = 40) -> DataFrame:
    """Unanswerable examples: per project up to per_project, each over 2 to 4 random sections that are silent on the question.

    Every attempt draws neighbours in the project's hash order; attempts whose sections mention a probe are rejected;
    the first per_project survivors of per_project * attempts count. Attempts are made in rounds, later ones only for
    projects that are still short. Two thirds are Italian. shortfall() tells which projects stay short.
    """
    spark = index.sparkSession
    templates = spark.createDataFrame([(i, *t) for i, t in enumerate(NEGATIVES[which])], "t int, key string, q_it string, q_en string, topic_it string, topic_en string, need_it string, need_en string, probes array<string>")
    n = len(NEGATIVES[which])
    sections, offsets, _ = ring(index.select("project", "source", "heading", "content"), seed)
    short = offsets.withColumn("have", F.lit(0))
    found, done = [], 0
    while done < attempts and not short.isEmpty():
        until = min(attempts, max(4, done * 3))
        tries = short.withColumn("attempt", F.explode(F.sequence(F.lit(done * per_project), F.lit(until * per_project - 1))))
        drawn = tries.withColumns({"start": F.floor(uniform(seed, "project", "attempt", F.lit("start")) * F.col("n")).cast("long"), "size": F.floor(uniform(seed, "project", "attempt", F.lit("size")) * 3).cast("long") + 2, "t": F.floor(uniform(seed, "project", "attempt", F.lit("t")) * n).cast("int")})
        drawn = drawn.withColumn("pos", F.explode(F.sequence(F.lit(1).cast("long"), F.least("size", "n")))).withColumn("rank", F.col("offset") + F.pmod(F.col("start") + F.col("pos"), F.col("n")))
        met = drawn.join(sections.select("rank", "source", "heading", "content"), "rank")
        texts = met.groupBy("project", "have", "attempt", "t").agg(F.array_sort(F.collect_list(F.struct("pos", "source", "heading", "content"))).alias("c"))
        asked = texts.join(F.broadcast(templates), "t").withColumn("hay", X.normalised(F.array_join(F.transform("c", lambda x: F.concat_ws(" ", x["source"], x["heading"], x["content"])), " ")))
        silent = asked.where(~F.exists("probes", lambda p: F.contains(F.col("hay"), p))).drop("hay", "probes")
        made = silent.withColumn("made", F.row_number().over(Window.partitionBy("project").orderBy("attempt")) + F.col("have")).where(F.col("made") <= per_project)
        found.append(written(made.drop("have"), "negatives"))
        more = found[-1].groupBy("project").agg(F.count("*").alias("m"))
        short = written(short.join(more, "project", "left").withColumn("have", F.col("have") + F.coalesce("m", F.lit(0)).cast("int")).drop("m").where(F.col("have") < per_project), "projects-short")
        done = until
    made = found[0]
    for more in found[1:]:
        made = made.union(more)
    first = F.col("c")[0]["heading"]
    subject = F.when(F.lower(first).isin(*GENERIC_HEADINGS), F.col("project")).otherwise(first)
    headings = F.transform("c", lambda x: x["heading"])
    italian = F.pmod(F.col("made") + F.col("attempt"), F.lit(3)) != 2
    choose = lambda options: F.element_at(F.array(*map(F.lit, options)), (F.pmod(F.col("made"), F.lit(len(options))) + 1).cast("int"))
    answer = F.when(italian, fill(choose(REFUSALS_IT), headings=headings_phrase(headings, " e ", "«", "»"), topic=F.col("topic_it"), need=F.col("need_it"), subject=subject)).otherwise(fill(choose(REFUSALS_EN), headings=headings_phrase(headings, " and ", '"', '"'), topic=F.col("topic_en"), need=F.col("need_en"), subject=subject))
    return made.select(
        F.concat_ws("-", F.lit("neg"), "project", "key", F.lpad(F.col("made").cast("string"), 3, "0")).alias("id"),
        fill(F.when(italian, F.col("q_it")).otherwise(F.col("q_en")), subject=subject).alias("question"),
        F.transform("c", lambda x: F.struct(x["source"].alias("source"), x["heading"].alias("heading"), x["content"].alias("content"), F.lit(False).alias("relevant"))).alias("context"),
        answer.alias("answer"),
        F.when(F.col("key") == "root_cause", "bug_investigation").otherwise("how_it_works").alias("category"),
        F.lit("medium").alias("difficulty"),
        F.lit("none").alias("answerable"),
        "project",
        F.array_sort(F.array(F.lit("unanswerable"), F.concat(F.lit("probe:"), "key"))).alias("tags"),
        F.lit("synthetic").alias("origin"),
    )


def shortfall(made: DataFrame, index: DataFrame, per_project: int) -> DataFrame:
    """project, wanted, made, short of every project of the index, for examples made per project."""
    per = made.groupBy("project").agg(F.count("*").alias("made"))
    every = index.select("project").distinct().join(per, "project", "left").select("project", F.lit(per_project).cast("long").alias("wanted"), F.coalesce("made", F.lit(0)).cast("long").alias("made"))
    return every.withColumn("short", F.col("wanted") - F.col("made"))


@dataclass(frozen=True)
class PlanConfig:
    full: float = 0.55
    partial: float = 0.15
    none: float = 0.20
    noisy: float = 0.10
    batch: int = 5
    sizes: tuple[int, ...] = (2, 3, 4, 5)
    conflict: float = 0.08
    #: Calls at most, the first in hash order; None plans one for every section.
    limit: int | None = None
    seed: int = 7
    distractors: float = 0.35
    least: int = 2
    most: int = 4


def slot(u: Column, category: Column, cfg: PlanConfig) -> Column:
    """Answerability and category of one planned example, by weight."""
    total = cfg.full + cfg.partial + cfg.none + cfg.noisy
    marks = [cfg.none / total, (cfg.none + cfg.partial) / total, (cfg.none + cfg.partial + cfg.noisy) / total]
    made = lambda a, c: F.struct(F.lit(a).alias("answerable"), c.alias("category"))
    return F.when(u < marks[0], made("none", F.lit("unanswerable"))).when(u < marks[1], made("partial", F.lit("partially_answerable"))).when(u < marks[2], made("full", F.lit("contradictory_context"))).otherwise(made("full", category))


def plan_bundles(index: DataFrame, cfg: PlanConfig = PlanConfig()) -> DataFrame:
    """One planned generation call per section: anchor, size (sections wanted), slots, conflict, plan_id; where `limit` is set, the first in hash order. draw_bundles draws the sections."""
    key = ["project", "source", "heading"]
    u = lambda *tag: uniform(cfg.seed, *key, *map(F.lit, tag))
    slots = F.array(*[slot(u("slot", str(i)), pick(cfg.seed, ANSWERABLE_CATEGORIES, *key, F.lit(f"category{i}")), cfg) for i in range(cfg.batch)])
    size = F.element_at(F.array(*map(F.lit, cfg.sizes)), F.floor(u("size") * len(cfg.sizes)).cast("int") + 1)
    conflict = (u("conflict") < cfg.conflict) & (size >= 2)
    first = F.array(F.struct(F.lit("partial").alias("answerable"), F.lit("contradictory_context").alias("category")))
    planned = index.select(*key, size.alias("size"), conflict.alias("conflict"), slots.alias("slots"), hash_order(cfg.seed, *key, F.lit("plan")).alias("h"))
    planned = planned.withColumn("slots", F.when(F.col("conflict"), F.concat(first, F.slice("slots", 2, cfg.batch))).otherwise(F.col("slots")))
    planned = planned.withColumn("plan_id", X.stable_id(F.concat(F.lit("b-"), "project"), "source", "heading"))
    return planned if cfg.limit is None else planned.orderBy("h").limit(cfg.limit)


def draw_bundles(index: DataFrame, cfg: PlanConfig = PlanConfig()) -> DataFrame:
    """The planned calls with their sections: plan_id, project, context (in hash order, with `relevant`), n_relevant, n_distractors, conflict, slots, prompt.

    Relevant are the anchor and size - 1 other sections of the project, neighbours in its hash order, or all there
    are. A share cfg.distractors of the calls also gets cfg.least to cfg.most sections of other projects, none with
    a key of their relevant sections. A call has a conflict only where two relevant sections were drawn.
    """
    key, seed = ["project", "source", "heading"], cfg.seed
    plans = written(plan_bundles(index, cfg).drop("h"), "bundle-plans")
    sections = index.select(*key, "content")

    ranked, offsets, total = ring(sections, seed)
    start = F.floor(uniform(seed, *key, F.lit("start")) * F.col("n")).cast("long")
    steps = plans.join(offsets, "project").select("plan_id", "project", F.col("source").alias("s"), F.col("heading").alias("h"), "size", "n", "offset", start.alias("start"), F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("size").cast("long"), F.col("n")) - 1)).alias("step"))
    others = steps.withColumn("rank", F.col("offset") + F.pmod(F.col("start") + F.col("step"), F.col("n"))).join(ranked.drop("project"), "rank").where(~(F.col("source").eqNullSafe(F.col("s")) & F.col("heading").eqNullSafe(F.col("h"))))
    others = others.withColumn("pos", F.row_number().over(Window.partitionBy("plan_id").orderBy("step"))).where("pos < size").select("plan_id", "source", "heading", "content")
    relevant = written(plans.select("plan_id", *key).join(sections, key).select("plan_id", "source", "heading", "content").union(others).withColumn("relevant", F.lit(True)), "bundle-relevant")

    noisy = plans.where(uniform(seed, *key, F.lit("noise")) < cfg.distractors).select("plan_id", "project", (F.floor(uniform(seed, *key, F.lit("k")) * (cfg.most - cfg.least + 1)).cast("int") + cfg.least).alias("k"))
    own = relevant.groupBy("plan_id").agg(F.collect_list(chunk_key()).alias("own_keys"))
    wanted = noisy.join(own, "plan_id").select(F.col("plan_id").alias("id"), F.col("project").alias("own"), "own_keys", "k")
    noise = drawn_from_others(wanted, ranked, offsets, total, seed).select(F.col("id").alias("plan_id"), "source", "heading", "content")

    mixed = relevant.union(noise.withColumn("relevant", F.lit(False)))
    per = mixed.groupBy("plan_id").agg(F.collect_list(F.struct("source", "heading", "content", "relevant")).alias("context"))
    n_relevant = F.size(F.filter("context", lambda c: c["relevant"]))
    told = plans.join(per, "plan_id").withColumns({"n_relevant": n_relevant, "n_distractors": F.size("context") - n_relevant, "planned": F.col("conflict"), "context": shuffled(F.col("context"), seed, F.col("plan_id"))})
    told = told.withColumn("conflict", F.col("planned") & (F.col("n_relevant") >= 2))
    own_slot = slot(uniform(seed, *key, F.lit("slot"), F.lit("0")), pick(seed, ANSWERABLE_CATEGORIES, *key, F.lit("category0")), cfg)
    told = told.withColumn("slots", F.when(F.col("planned") & ~F.col("conflict"), F.concat(F.array(own_slot), F.slice("slots", 2, cfg.batch))).otherwise(F.col("slots")))
    prompt = F.concat(prompting.batch_instruction(F.col("slots"), F.col("n_distractors") > 0, F.col("conflict")), F.lit("\n\n## Documentation blocks\n\n"), prompting.render_context(F.col("context")), F.lit("\n"))
    return told.select("plan_id", "project", "context", "n_relevant", "n_distractors", "conflict", "slots", prompt.alias("prompt"))


def stratified(rows: DataFrame, wanted: dict[str, int], bucket: Column, seed: int = 42, key: str = "id") -> DataFrame:
    """Up to wanted[b] rows of every bucket b, the first in hash order."""
    quota = rows.sparkSession.createDataFrame(sorted(wanted.items()), "bucket string, quota int")
    order = Window.partitionBy("bucket").orderBy(hash_order(seed, key), key)
    return rows.withColumn("bucket", bucket).join(F.broadcast(quota), "bucket").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= F.col("quota")).drop("_n", "quota")


def bucket() -> Column:
    """none, partial, noisy or full: what a benchmark row tests."""
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    label = F.coalesce("answerable", F.lit("full"))
    return F.when(label == "none", "none").when(label == "partial", "partial").when(F.arrays_overlap(tags, F.array(F.lit("distractor"), F.lit("contradiction"))), "noisy").otherwise("full")
