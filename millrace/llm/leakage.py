"""Problem 8: evaluation texts inside training text, found by size-partitioned MinHash containment search.

Both sides are cut into partitions of one size, windows of `run` words, each a set of shingles of `shingle` words.
A window inside a document has containment 1 or it isn't there, so the smallest shingle hashes of an item's window
equal those of the document's window. Documents and items that have a signature in common are candidates, and
none is missed; only the distinct signatures, 8 bytes each, are joined. Candidates are verified by exact containment:
the item's windows are looked up, word for word, among the document's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.canonical import Forms, canonical_text
from millrace.session import written

_words = re.compile(r"[^\W_]+")
#: Hash functions of a window's signature. One makes a candidate of every document that shares a phrase of `shingle` words at the right place; more make false candidates rare, and signatures more.
FUNCTIONS = 3
#: Distinct words whose hashes a task keeps.
WORD_MEMO = 500_000


def _word_numbers(words: list[str], memo: dict[str, int]) -> np.ndarray:
    if len(memo) > WORD_MEMO:
        memo.clear()
    for w in set(words).difference(memo):
        memo[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_signatures(numbers: np.ndarray, run: int, shingle: int, functions: int = FUNCTIONS) -> np.ndarray:
    """The MinHash signature of every window of `run` words, in order of the windows' first words: the smallest shingle hash under each of `functions` hash functions, mixed into one number."""
    n = len(numbers) - run + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = np.zeros(len(numbers) - shingle + 1, dtype=np.uint64)
    for k in range(shingle):
        base = base * np.uint64(0x9E3779B97F4A7C15) + numbers[k : k + len(base)]
    out = np.zeros(n, dtype=np.uint64)
    for f in range(functions):
        h, left, width = _mix(base + np.uint64(f * 0xD6E8FEB86659FD93 % (1 << 64))), run - shingle + 1, 1
        while width < left:  # minima of doubling width
            step = min(width, left - width)
            h = np.minimum(h[: len(h) - step], h[step:])
            width += step
        out = _mix(out) + h[:n]
    return out


def _texts(rows: DataFrame, id_col: str, text: str, name: str) -> DataFrame:
    return rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias(name), F.coalesce(F.col(text), F.lit("")).alias("t"))


def _signatures(rows: DataFrame, name: str, run: int, shingle: int) -> DataFrame:
    """The distinct signatures of every text: name, signature."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms, memo = Forms(), {}
        for batch in batches:
            found = [np.unique(window_signatures(_word_numbers(_words.findall(canonical_text(t, forms)), memo), run, shingle)).view(np.int64) for t in batch.column("t").to_pylist()]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(name), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))], names=[name, "signatures"])

    return rows.mapInArrow(cut, f"{name} long, signatures array<long>").select(name, F.explode("signatures").alias("signature"))


def _windows(words: list[str], run: int) -> set[str]:
    return {" ".join(words[k : k + run]) for k in range(len(words) - run + 1)}


def _verified(frames: Iterator[pd.DataFrame], run: int) -> Iterator[pd.DataFrame]:
    """Windows of the item that stand in the document, for rows doc_id, t, item_id, it. Rows of one document mostly follow each other, so its windows are kept for the next row."""
    forms, items = Forms(), {}
    text, windows = None, set()
    for frame in frames:
        out = []
        for doc, t, item, it in zip(frame["doc_id"], frame["t"], frame["item_id"], frame["it"], strict=True):
            if t != text:
                text, windows = t, _windows(_words.findall(canonical_text(t, forms)), run)
            if len(items) > 10_000:
                items.clear()
            if it not in items:
                items[it] = _windows(_words.findall(canonical_text(it, forms)), run)
            if both := len(items[it] & windows):
                out.append((doc, item, both, len(items[it])))
        yield pd.DataFrame(out, columns=["doc_id", "item_id", "n_windows", "n_all"])


def leaked_items(documents: DataFrame, items: DataFrame, run: int = 12, shingle: int = 5, text: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """doc_id, item_id, n_windows (distinct windows of the item that the document carries), containment (their share of the item's windows).

    Both texts are taken in the canonical form; a window is `run` words in a row. Items of fewer words can't be
    found. Null text is empty, rows without id are left out, repeated rows count once (of differing texts of one id
    the pair that shares most), empty tables give no rows.
    """
    asked, searched = _texts(items, item_id, item_text, "item_id").distinct(), _texts(documents, id_col, text, "doc_id")
    known = written(_signatures(asked, "item_id", run, shingle), "item-signatures")
    candidates = written(_signatures(searched, "doc_id", run, shingle).join(known, "signature").select("doc_id", "item_id").distinct(), "leak-candidates")
    pairs = candidates.join(asked.withColumnRenamed("t", "it"), "item_id").join(searched, "doc_id").select("doc_id", "t", "item_id", "it")
    hits = pairs.mapInPandas(lambda frames: _verified(frames, run), "doc_id long, item_id long, n_windows long, n_all long")
    most = hits.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_windows", "n_all")).alias("m"))
    return most.select("doc_id", "item_id", "m.n_windows", F.round(F.col("m.n_windows") / F.col("m.n_all"), 4).alias("containment"))


def leaked_report(documents: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """Per item that leaked: suite, item_id, documents that carry some of it, the largest share carried."""
    hits = leaked_items(documents, items, **kw)
    suite = items.groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("suite").alias("suite"))
    return hits.groupBy("item_id").agg(F.count("*").alias("n_documents"), F.max("containment").alias("most_carried")).join(suite, "item_id").select("suite", "item_id", "n_documents", "most_carried")
