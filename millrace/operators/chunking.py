"""Markdown and plain text into heading-scoped sections."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Patterns of a fence line and of a heading line, and the heading of text above the first one.
_FENCE = re.compile(r"^\s*(```|~~~)")
_HEADING = re.compile(r"^(#{1,6})\s+(.*?)\s*#*\s*$")
FIRST = "Overview"


@dataclass(frozen=True)
class ChunkConfig:
    lowest: int = 1
    highest: int = 4
    least: int = 80
    most: int = 4000


def _outside_fences(lines: list[str]) -> list[int]:
    """Numbers of the lines that neither open or close a fence nor stand inside one; a fence ends only with its own marker."""
    marks = [(k, m.group(1)) for k, m in ((k, _FENCE.match(line)) for k, line in enumerate(lines)) if m]
    inside = np.zeros(len(lines) + 1, dtype=bool)
    k = 0
    while k < len(marks):
        start, marker = marks[k]
        end = next((j for j in range(k + 1, len(marks)) if marks[j][1] == marker), None)
        inside[start : marks[end][0] + 1 if end is not None else len(lines)] = True
        k = len(marks) if end is None else end + 1
    return np.flatnonzero(~inside[: len(lines)]).tolist()


def sections(text: str, cfg: ChunkConfig = ChunkConfig()) -> list[tuple[str, list[str], str]]:
    """(heading, headings above it and itself, body) of every section with enough text, in order.

    The boundaries are found first: headings of the level range outside fences. A section's body is the slice of
    lines up to the next boundary. A section too short is left out, but its heading still counts above those below it.
    """
    lines = text.splitlines()
    found = ((k, _HEADING.match(lines[k])) for k in _outside_fences(lines))
    heads = [(k, len(m.group(1)), m.group(2).strip() or FIRST) for k, m in found if m and cfg.lowest <= len(m.group(1)) <= cfg.highest]
    starts = np.array([-1, *(k for k, _, _ in heads)])
    ends = np.append(starts[1:], len(lines))
    paths: list[list[str]] = [[]]
    for j, (_, level, title) in enumerate(heads):
        above = next((i for i in range(j - 1, -1, -1) if heads[i][1] < level), None)
        paths.append([*(paths[above + 1] if above is not None else []), title])
    bodies = ["\n".join(lines[a + 1 : b]).strip() for a, b in zip(starts, ends, strict=True)]
    return [(path[-1] if path else FIRST, path, body[: cfg.most]) for path, body in zip(paths, bodies, strict=True) if len(body) >= cfg.least]


def plain(text: str, name: str, cfg: ChunkConfig = ChunkConfig()) -> list[tuple[str, list[str], str]]:
    """A text without headings is one section, named after its file."""
    body = text.strip()[: cfg.most]
    return [(name.rsplit("/", 1)[-1].rsplit(".", 1)[0], [], body)] if len(body) >= cfg.least else []


CHUNK = "project string, source string, heading string, content string, relative_path string, heading_path array<string>, content_hash string, pos int"


def chunk_files(files: DataFrame, cfg: ChunkConfig = ChunkConfig()) -> DataFrame:
    """files: project, relative_path, text. One row per section; files with null text give none. Files are independent, so nothing is shuffled."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for project, path, text in zip(frame["project"], frame["relative_path"], frame["text"], strict=True):
                name = path.rsplit("/", 1)[-1]
                found = plain(text, name, cfg) if name.lower().endswith(".txt") else sections(text, cfg)
                out += [(project, name, h, c, path, p or None, hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest()[:16], k) for k, (h, p, c) in enumerate(found)]
            yield pd.DataFrame(out, columns=["project", "source", "heading", "content", "relative_path", "heading_path", "content_hash", "pos"])

    return files.where("text is not null and relative_path is not null").select("project", "relative_path", "text").mapInPandas(run, CHUNK)


def corpus_summary(chunks: DataFrame) -> DataFrame:
    """Sections per project and in all: project (null for the total), n_sections, n_projects."""
    return chunks.rollup("project").agg(F.count("*").alias("n_sections"), F.count_distinct("project").alias("n_projects"))


def staged(chunks: DataFrame, least: int) -> DataFrame:
    """Projects with their number of sections and whether they reach `least`."""
    return chunks.groupBy("project").agg(F.count("*").alias("n_sections")).withColumn("staged", F.col("n_sections") >= least)


def section_index(chunks: DataFrame) -> DataFrame:
    """One row per (project, source, heading): the last one loaded, by ord."""
    from pyspark.sql import Window

    last = Window.partitionBy("project", "source", "heading").orderBy(F.desc("ord"), F.desc("chunk_id"))
    return chunks.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
