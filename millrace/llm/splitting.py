"""Problem 2: cutting oversized texts at natural boundaries, by dynamic programming over boundary positions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cost of a cut by the boundary before it; the next piece's start costs half as much by its own boundary.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, ANYWHERE = 0.0, 1.0, 2.0, 6.0, 12.0, 40.0
#: Weight of the squared relative distance of a piece's length from the even length.
IMBALANCE = 4.0
#: Cost of a piece more than needed.
PIECE = 3.0
#: Stretches of a piece's length. A stretch without any boundary offers its cheapest position, so that text without boundaries can be cut too; at least 4, so that every piece finds one.
GRAIN = 64
#: Profiles of limits; a parameter table, larger ones are refused.
MAX_PROFILES = 100

_boundaries = [
    (WORD, re.compile(r"\s+")),
    (CLAUSE, re.compile(r"[,;:)\]]\s+")),
    (SENTENCE, re.compile(r"(?:[.!?…][\"'»”)\]`*]*\s+|[。！？])")),
    (LINE, re.compile(r"[ \t]*(?:\r\n|\r|\n| |\x85)")),
    (PARAGRAPH, re.compile(r"[ \t]*(?:\r\n|\r|\n)(?:[ \t]*(?:\r\n|\r|\n))+| ")),
]
_joined = re.compile("(?<=\r)\n|[̀-ͯ‍︀-️\U0001f3fb-\U0001f3ff]|(?<=‍).")


def cut_costs(text: str) -> np.ndarray:
    """Cost of a cut before each position 0..len(text); infinite inside CRLF and combined characters."""
    cost = np.full(len(text) + 1, ANYWHERE)
    for level, pattern in _boundaries:
        for m in pattern.finditer(text):
            cost[m.end()] = level
    for m in _joined.finditer(text):
        cost[m.start()] = np.inf
    cost[0] = cost[len(text)] = 0.0
    return cost


def split_text(text: str, max_chars: int, overlap: int) -> list[tuple[int, int]]:
    """Spans (start, end) of the pieces, in order: each at most max_chars code points, each starting exactly `overlap` code points before the end of the one before it, together the whole text.

    Of all such sequences one of the least cost is taken: cost of the boundary at each end, half of it at each
    start, the squared relative distance from the even length, and a price per piece. Every boundary is a candidate
    for an end; stretches of 1/GRAIN of a piece that hold none offer their cheapest position.
    """
    n = len(text)
    if not 0 <= overlap < max_chars:
        raise ValueError("the overlap must be smaller than the limit")
    if n <= max_chars:
        return [(0, n)]
    cost = cut_costs(text)
    step = max(1, (max_chars - overlap) // GRAIN)
    at = np.arange(overlap + 1, n)
    local = cost[at] + cost[at - overlap] / 2
    bounds = cost[at] < ANYWHERE
    stretch = np.arange(len(at)) // step
    cheapest = np.lexsort((np.arange(len(at)), local, stretch))  # first of each stretch, the earlier one on a tie
    cheapest = cheapest[np.searchsorted(stretch, np.arange(stretch[-1] + 1) if len(at) else [])]
    bare = np.ones(stretch[-1] + 1 if len(at) else 0, dtype=bool)
    bare[stretch[bounds]] = False
    pick = np.sort(np.concatenate([np.flatnonzero(bounds), cheapest[bare]]))
    at, local = np.append(at[pick], n), np.append(local[pick], 0.0)
    local[np.isinf(local)] = ANYWHERE * 4  # nothing but combined characters there
    pieces = -(-(n - overlap) // (max_chars - overlap))
    even = (n + (pieces - 1) * overlap) / pieces
    # a piece from the candidate i to the end e costs IMBALANCE * (e / even - u[i]) ** 2; its terms in u alone are added once
    u = (at - overlap) / even + 1
    upto, came = np.full(len(at), np.inf), [-1] * len(at)
    low, start = 0, (at - overlap).tolist()
    for j, (end, own) in enumerate(zip(at.tolist(), (local + PIECE).tolist(), strict=True)):
        e = end / even
        best = IMBALANCE * (e - 1) ** 2 if end <= max_chars else np.inf
        while start[low] < end - max_chars:
            low += 1
        if low < j:
            total = upto[low:j] - (2 * IMBALANCE * e) * u[low:j]
            k = total.argmin()
            if (found := total[k] + IMBALANCE * e * e) < best:
                best, came[j] = found, low + int(k)
        upto[j] = best + own + IMBALANCE * u[j] ** 2
    spans, j = [], len(at) - 1
    while j >= 0:
        spans.append((0 if came[j] < 0 else start[came[j]], int(at[j])))
        j = came[j]
    return spans[::-1]


def split_oversized(chunks: DataFrame, limits: DataFrame) -> DataFrame:
    """Pieces of every chunk whose content has more code points than a profile's max_chars.

    chunks: chunk_id, heading, content, loaded_at (others are ignored); of re-sent rows the latest counts. limits:
    profile, max_chars, overlap_chars; profiles with null or unusable limits are left out. Returns profile,
    chunk_id, piece, n_pieces, start, end, heading, content. Null and short contents give no rows.
    """
    rows = limits.where("profile is not null and max_chars > 0 and overlap_chars >= 0 and overlap_chars < max_chars").select("profile", "max_chars", "overlap_chars").distinct().limit(MAX_PROFILES + 1).collect()
    if len(rows) > MAX_PROFILES:
        raise ValueError(f"more than {MAX_PROFILES} profiles")
    profiles = [(r.profile, int(r.max_chars), int(r.overlap_chars)) for r in rows]
    out = "profile string, chunk_id long, piece int, n_pieces int, start int, end int, heading string, content string"
    if not profiles:
        return chunks.sparkSession.createDataFrame([], out)
    smallest = min(m for _, m, _ in profiles)
    last = chunks.where("chunk_id is not null").groupBy("chunk_id").agg(F.max(F.struct(F.coalesce("loaded_at", F.lit(0).cast("timestamp")).cast("string").alias("t"), F.xxhash64("content", "heading").alias("h"))).alias("last"))
    keyed = chunks.where(F.length("content") > smallest).select("chunk_id", "heading", "content", F.struct(F.coalesce("loaded_at", F.lit(0).cast("timestamp")).cast("string").alias("t"), F.xxhash64("content", "heading").alias("h")).alias("last"))
    oversized = keyed.join(last, ["chunk_id", "last"], "left_semi").dropDuplicates(["chunk_id"]).select("chunk_id", "heading", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for chunk, heading, text in zip(frame["chunk_id"], frame["heading"], frame["content"], strict=True):
                for profile, limit, overlap in profiles:
                    if len(text) > limit:
                        spans = split_text(text, limit, overlap)
                        out += [(profile, chunk, k, len(spans), a, b, heading, text[a:b]) for k, (a, b) in enumerate(spans)]
            yield pd.DataFrame(out, columns=["profile", "chunk_id", "piece", "n_pieces", "start", "end", "heading", "content"])

    return oversized.mapInPandas(run, out)
