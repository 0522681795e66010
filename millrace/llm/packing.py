"""Problem 7: filling fixed-capacity containers, by sum-of-squares online packing over token counts."""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written

#: Folder of the public vocabulary files; a parameter of every function that counts tokens.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Documents that one task packs. Each bucket leaves at most a few containers partly filled, so the waste per bucket is a fixed, small share.
BUCKET_ROWS = 50_000
# Fixed value: the public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_counter(vocabulary: bytes):
    """A function that counts the tokens of a whole text with a public byte-level vocabulary (a file of ranks); null has none."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    encode = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: len(encode(text)) if text else 0


def read_vocabulary(folder: str = TOKENIZERS, name: str = VOCABULARY) -> bytes:
    return Path(folder, name).read_bytes()


def token_counts(documents: DataFrame, text: str = "text", id_col: str = "doc_id", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens of every row with an id; null and empty text have 0 tokens. The vocabulary, a file of fixed size, is read by the driver only and sent to the tasks."""
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(folder, vocabulary))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = token_counter(shared.value)
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["i"], "n_tokens": [count(t) for t in frame["t"]]})

    rows = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text).alias("t"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Container number of each item, placed in order, and the fill of each container. Sizes must be 0..capacity.

    open_at[h] counts the partly filled containers of fill h. Of the levels that can take the item, and a new
    container, the one is chosen that makes the sum of the squared counts smallest; on a tie the fullest level.
    An item of size 0 goes to the first container.
    """
    open_at = np.zeros(capacity + 1, dtype=np.int64)
    at_level: dict[int, list[int]] = {}
    fills: list[int] = []
    out = np.zeros(len(sizes), dtype=np.int64)
    huge = np.iinfo(np.int64).max
    for i, size in enumerate(sizes.tolist()):
        if size == 0:
            continue
        if size == capacity:
            out[i] = len(fills)
            fills.append(size)
            continue
        # change of the sum when an open container of fill h = 1 .. capacity - size takes the item
        here = open_at[1 : capacity - size + 1]
        change = 2 * (open_at[1 + size : capacity + 1] - here) + 2
        change[-1] = 1 - 2 * here[-1]  # the container becomes full and leaves the sum
        change[here == 0] = huge
        best = len(change) - 1 - int(change[::-1].argmin())
        if change[best] <= 2 * open_at[size] + 1:
            level = best + 1
            box = at_level[level].pop()
            open_at[level] -= 1
        else:
            level, box = 0, len(fills)
            fills.append(0)
        fills[box] = level + size
        if fills[box] < capacity:
            open_at[fills[box]] += 1
            at_level.setdefault(fills[box], []).append(box)
        out[i] = box
    if not fills and len(sizes):
        fills.append(0)
    return out, np.array(fills, dtype=np.int64)


PIECES = "kind string, doc_id long, piece int, first_token long, n_tokens long, bucket int, container long"
#: Kinds of container; a parameter table, larger ones are refused.
MAX_KINDS = 1000


def _kinds(containers: DataFrame) -> list[tuple[str, int]]:
    rows = containers.where("kind is not null and capacity_tokens > 0").groupBy("kind").agg(F.max("capacity_tokens").cast("long")).limit(MAX_KINDS + 1).collect()
    if len(rows) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} kinds of container")
    return sorted(map(tuple, rows))


def pack(sizes: DataFrame, containers: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Places items of sizes (doc_id, n_tokens) in containers of every row of containers (kind, capacity_tokens).

    Returns one row per piece: kind, doc_id, piece, first_token, n_tokens, bucket, container. Items within the
    capacity stay whole; larger ones are cut into full containers and a rest, which is packed like an item. An
    item of 0 tokens lies in the first container of its bucket. Items are packed in order of doc_id within hash
    buckets; containers are numbered per bucket. The result doesn't depend on partitioning. Repeated rows of an
    id count once (the largest size); rows without id or of a kind with no positive capacity are left out.
    """
    kinds = _kinds(containers)
    if not kinds:
        return sizes.sparkSession.createDataFrame([], PIECES)
    items = written(sizes.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce("n_tokens", F.lit(0))).alias("n_tokens")), "token-counts")
    buckets = max(1, math.ceil(items.count() / bucket_rows))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id", kind="stable")
        capacity = int(frame["capacity"].iloc[0])
        n = frame["n_tokens"].to_numpy()
        pieces = np.maximum(1, -(-n // capacity))
        row = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(capacity, n[row] - piece * capacity)
        box, _ = sum_of_squares(size, capacity)
        return pd.DataFrame({"kind": frame["kind"].iloc[0], "doc_id": frame["doc_id"].to_numpy()[row], "piece": piece, "first_token": piece * capacity, "n_tokens": size, "bucket": frame["bucket"].to_numpy()[row], "container": box})

    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("capacity")) for k, n in kinds]))
    placed = items.select("doc_id", "n_tokens", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("bucket"), each.alias("to")).select("doc_id", "n_tokens", "bucket", "to.*")
    return placed.groupBy("kind", "bucket").applyInPandas(run, PIECES)


def fill_report(placed: DataFrame, containers: DataFrame) -> DataFrame:
    """Per kind: items, pieces, cut items, containers, tokens, fill (share of the capacity in use)."""
    kinds = containers.where("kind is not null and capacity_tokens > 0").groupBy("kind").agg(F.max("capacity_tokens").cast("long").alias("capacity"))
    boxes = placed.groupBy("kind", "bucket", "container").agg(F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"), F.count_if(F.col("piece") == 0).alias("n_items"), F.count_if(F.col("piece") == 1).alias("n_cut"))
    per_kind = boxes.groupBy("kind").agg(F.sum("n_items").alias("n_items"), F.sum("n_pieces").alias("n_pieces"), F.sum("n_cut").alias("n_cut"), F.count("*").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    return per_kind.join(kinds, "kind").withColumn("fill", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")), 4)).drop("capacity")
