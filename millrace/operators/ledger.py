"""Requests, responses and runs: what is cached, what is pending, what a run did."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def request_hash(**parts: Column) -> Column:
    """Key of a request: SHA-256 of its parts as JSON, keys in alphabetical order."""
    return F.sha2(F.to_json(F.struct(*[parts[k].alias(k) for k in sorted(parts)]), {"ignoreNullFields": "false"}), 256)


def latest_responses(responses: DataFrame, key: str = "cache_key") -> DataFrame:
    """One usable response per key: the one received last. Null, failed and unreadable ones are misses."""
    last = Window.partitionBy(key).orderBy(F.col("received_at").desc_nulls_last(), F.desc("request_id"))
    usable = responses.where("response is not null and status = 'ok'").where(F.try_parse_json("response").isNotNull())
    return usable.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def look_up(requests: DataFrame, responses: DataFrame, key: str = "cache_key") -> DataFrame:
    """Requests with `response` and `hit`."""
    return requests.join(latest_responses(responses, key).select(key, "response"), key, "left").withColumn("hit", F.col("response").isNotNull())


def pending(units: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return units.join(done.select(key).distinct(), key, "left_anti")


def append_new(existing: DataFrame, fresh: DataFrame, key: str = "id") -> DataFrame:
    """existing and those rows of fresh whose key it hasn't."""
    return existing.unionByName(fresh.join(existing.select(key), key, "left_anti"))


def run_report(responses: DataFrame, by: list[str]) -> DataFrame:
    """Counters of the stored responses per group: requests (repeated rows once), hits and misses by status, items, mean items per success, hit rate (0 without requests)."""
    one = responses.dropDuplicates(["request_id"])
    ok = F.col("status") == "ok"
    return one.groupBy(*by).agg(
        F.count("*").alias("requests"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(F.col("status") == "parse_failed").alias("parse_failed"),
        F.count_if(F.col("status") == "timeout").alias("timed_out"),
        F.count_if(F.col("status").isNull()).alias("unknown"),
        F.sum(F.when(ok, F.col("n_items")).otherwise(0)).alias("items"),
        F.round(F.coalesce(F.avg(F.when(ok, F.col("n_items"))), F.lit(0.0)), 4).alias("items_per_success"),
        F.round(F.coalesce(F.try_divide(F.count_if(ok), F.count("*")), F.lit(0.0)), 4).alias("hit_rate"),
    )


def latency(responses: DataFrame, by: list[str]) -> DataFrame:
    """Exact median, mean and extreme of total_ms per group; repeated rows count once, null times don't."""
    return responses.dropDuplicates(["request_id"]).where("total_ms is not null").groupBy(*by).agg(F.count("*").alias("n"), F.round(F.median("total_ms"), 3).alias("median_ms"), F.round(F.avg("total_ms"), 3).alias("mean_ms"), F.max("total_ms").alias("max_ms"))


# What a provider says when its quota is used up, and how much of the end of its output is looked at: the
# beginning may repeat the prompt, whose documentation may speak of limits.
QUOTA = (
    "usage limit", "rate limit exceeded", "rate_limit_error", "quota exceeded", "out of quota", "too many requests", "http 429", "status 429",
    "limit reached", "limit exceeded", "resets at", "try again later", "overloaded_error", "insufficient_quota", "you have hit your",
    "upgrade to continue", "plan limit",
)
TAIL = 2000


def output_tail(*streams: Column) -> Column:
    """The ends of a call's output streams, one after the other."""
    return F.btrim(F.concat_ws("\n", *[F.btrim(F.right(F.coalesce(s, F.lit("")), F.lit(TAIL))) for s in streams]))


def quota_signal(text: Column) -> Column:
    """Whether the end of an output says that the quota is used up."""
    low = F.lower(output_tail(text))
    return F.exists(F.array(*map(F.lit, QUOTA)), lambda p: F.contains(low, p))


def telling_lines(text: Column) -> Column:
    """The distinct lines that hold a quota phrase, 500 characters of them; where none does, the last 300 in lower case."""
    hits = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\R"), F.btrim), quota_signal))
    return F.when(F.size(hits) > 0, F.substring(F.array_join(hits, " | "), 1, 500)).otherwise(F.right(F.lower(F.coalesce(text, F.lit(""))), F.lit(300)))


def put_responses(fresh: DataFrame, folder: str) -> None:
    """Appends responses (cache_key, response, project, bundle, teacher, prompt_version, status, created_at, received_at) to the cache; a job's rows appear all or not at all."""
    fresh.write.mode("append").parquet(folder)


def audit(provider: Column, model: Column, version: Column, time: Column, request: Column, from_cache: Column) -> Column:
    """What is kept about the call an example came from."""
    parts = {"teacher_provider": provider, "teacher_model": model, "prompt_version": version, "generation_timestamp": time, "teacher_request_hash": request, "from_cache": from_cache}
    return F.struct(*[c.cast("boolean" if k == "from_cache" else "string").alias(k) for k, c in parts.items()])


STATE = "unit string, status string, accepted long, rejected long, from_cache boolean, updated_at timestamp"


def save_state(done: DataFrame, folder: str) -> None:
    """Appends what became of units (columns of STATE) to the run's ledger."""
    done.select("unit", "status", "accepted", "rejected", "from_cache", "updated_at").write.mode("append").parquet(folder)


def load_state(spark: SparkSession, folder: str, resume: bool = True) -> DataFrame:
    """The last state of every unit of the ledger; nothing where the run doesn't resume or has no ledger yet."""
    if resume:
        try:
            rows = spark.read.schema(STATE).parquet(folder)
            return rows.groupBy("unit").agg(F.max_by(F.struct("status", "accepted", "rejected", "from_cache"), "updated_at").alias("v"), F.max("updated_at").alias("updated_at")).select("unit", "v.*", "updated_at")
        except AnalysisException:
            pass
    return spark.createDataFrame([], STATE)


def run_counters(planned: DataFrame, state: DataFrame, key: str = "unit") -> DataFrame:
    """One row: planned units, done, calls, cache hits, accepted, rejected, failures, stopped on quota, and units left."""
    joined = planned.select(F.col(key).alias("unit")).distinct().join(state, "unit", "left")
    ok = F.col("status") == "ok"
    return joined.agg(
        F.count("*").alias("planned"),
        F.count_if(ok).alias("done"),
        F.count_if(ok & ~F.coalesce("from_cache", F.lit(False))).alias("calls"),
        F.count_if(F.coalesce("from_cache", F.lit(False))).alias("hits"),
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"),
        F.count_if(F.col("status").isNotNull() & ~ok & (F.col("status") != "quota")).alias("failures"),
        F.count_if(F.col("status") == "quota").alias("stopped"),
        F.count_if(F.coalesce(~ok, F.lit(True))).alias("left"),
    )
