"""Exact set-similarity join by T-occurrence search over inverted lists, divided and merged as in DivideSkip.

Sets r, s of likeness >= t share at least T = ceil(t * |r|) words. Every set keeps its words in one global order,
rare ones first. Its L last words have the longest inverted lists; L follows from T and the length M of the longest
list as T / (MU * log2(M) + 1). A partner must occur on at least K = T - L of the other, short lists:

1. divide: the short lists are inverted, word by word, and a set fetches those of its own short words;
2. merge: per set a heap runs over its sorted short lists, counts occurrences, and skips list elements that can't
   reach the count any more;
3. probe: of candidates that reach the count, the words on long lists are looked up by binary search, and those that
   reach the required overlap are kept.

Exact counts say which words are frequent. Their lists, which grow with the table, don't meet pair by pair: an element
stands once in its list, at its size band, is copied at most to the next band (and to the other blocks of a list over
BLOCK x MEET elements), and within a band it only meets elements of sizes and places that leave enough words. Of those
pairs only the ones are fetched whose signatures, 128 parities of words, don't already differ too much.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written

#: Cost of a probe of a long list against that of an element merged; a larger value probes less and merges more.
MU = 0.002
#: Elements of a block of an inverted list; what a set fetches is divided by partner into as many slots as its longest short list has blocks.
BLOCK = 2000
#: Blocks of a frequent word's list that meet in one task, by columns; of longer lists, askers go to every part.
MEET = 1000
#: Elements up to which (and up to a block) a list is joined pair by pair; words on more sets are frequent.
FEW = 64
#: Frequent words, of which exact counts are broadcast: 16 bytes each. If more words have lists over the limit, only lists of a multiple of it count as frequent.
MOST_FREQUENT = 2_000_000
#: Rows of lists gathered before they are matched, and pairs matched at once.
HELD, AT_ONCE = 100_000, 1_000_000
#: Cells of the sketch that orders words which aren't frequent; it only orders, so its size is fixed.
CELLS = 1 << 18
EPS = 1e-9


class WordOrder:
    """Counts that order words: exact for frequent ones, by hash cell for the others."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, cells: np.ndarray, block: int):
        at = np.argsort(words)
        self.words, self.counts, self.cells, self.block = words[at], counts[at], cells, block

    def lengths(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of every word's list, for ordering, and its blocks, 0 where the word isn't frequent."""
        # a word that isn't frequent is put before every frequent one
        length = np.minimum(self.cells[flat % len(self.cells)], self.counts.min() - 1 if len(self.counts) else np.iinfo(np.int64).max)
        parts = np.zeros(len(flat), dtype=np.int32)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, flat), len(self.words) - 1)
            known = self.words[at] == flat
            length[known] = self.counts[at[known]]
            parts[known] = -(-length[known] // self.block)
        return length, parts


def word_order(sets: DataFrame, block: int = BLOCK, cells: int = CELLS, most: int = MOST_FREQUENT) -> WordOrder:
    """Counts every word over all sets, once, and fetches those over `block` or FEW (at most `most`) and the sketch of the others."""
    few = min(block, FEW)
    counts = written(sets.select(F.explode("tokens").alias("w")).groupBy("w").agg(F.count("*").alias("n")), "word-counts")
    times = F.greatest(F.lit(0), F.floor(F.log2(F.col("n") / F.lit(few)))).cast("int")
    steps = {r["times"]: r["words"] for r in counts.where(F.col("n") > few).groupBy(times.alias("times")).agg(F.count("*").alias("words")).collect()}
    # at most one row per power of two; the lowest limit whose words fit
    limit = few
    while sum(n for k, n in steps.items() if few << k >= limit) > most:
        limit *= 2
    frequent = counts.where((F.col("n") > few) & (F.col("n") >= limit)).toArrow()
    rest = counts.where((F.col("n") <= few) | (F.col("n") < limit)).groupBy(F.pmod("w", F.lit(cells)).cast("int").alias("cell")).agg(F.sum("n").alias("n")).toArrow()
    sketch = np.zeros(cells, dtype=np.int64)
    sketch[rest["cell"].to_numpy()] = rest["n"].to_numpy()
    return WordOrder(frequent["w"].to_numpy(), frequent["n"].to_numpy(), sketch, block)


def signatures(flat: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 parities of each set's words, as two longs. A word that only one of two sets has changes one of them, so two signatures differ in no more places than the sets in words."""
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = (flat.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(57)
    bit = np.uint64(1) << (place & np.uint64(63))
    low, high = (np.bitwise_xor.reduceat(np.where((place >> np.uint64(6)) == half, bit, np.uint64(0)), start) for half in (0, 1))
    return low.view(np.int64), high.view(np.int64)


def ordered_sets(sets: DataFrame, order: WordOrder, threshold: float, mu: float = MU) -> DataFrame:
    """Sets with their words in the global order: c, side, n, k (occurrences on short lists that a partner needs), s0 and s1 (signature), tokens, and parts, the blocks of the list of each short word (0: not frequent), one element per short word."""
    shared = sets.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            tokens = batch.column("tokens")
            flat = tokens.flatten().to_numpy(zero_copy_only=False)
            size = np.diff(tokens.offsets.to_numpy()).astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            length, parts = order.lengths(flat)
            at = np.lexsort((flat, length, row))
            flat, length, parts = flat[at], length[at], parts[at]
            end = np.cumsum(size)
            longest = np.where(size > 0, length[np.maximum(end - 1, 0)] if len(length) else 0, 1)
            need = np.ceil(threshold * size - EPS).astype(np.int64)
            probed = np.minimum(need - 1, np.floor(need / (mu * np.log2(np.maximum(longest, 1) + 1) + 1)).astype(np.int64))
            short = np.maximum(0, size - probed)
            keep = np.arange(len(flat)) - np.repeat(end - size, size) < np.repeat(short, size)
            offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("c"), batch.column("side"), pa.array(size.astype(np.int32)), pa.array((need - probed).astype(np.int32)), *map(pa.array, signatures(flat, end - size)), pa.ListArray.from_arrays(offsets(size), pa.array(flat)), pa.ListArray.from_arrays(offsets(short), pa.array(parts[keep]))],
                names=["c", "side", "n", "k", "s0", "s1", "tokens", "parts"],
            )

    rows = sets.where(F.size("tokens") > 1).select("c", F.col("side").cast("int").alias("side"), "tokens")
    return rows.mapInArrow(run, "c long, side int, n int, k int, s0 long, s1 long, tokens array<long>, parts array<int>")


def short_lists(ordered: DataFrame) -> DataFrame:
    """The inverted lists of short words as rows: w, c, n, k, side, s0, s1, place of the word in the set, parts (blocks of the list, 0: not frequent), spread (blocks of the set's longest short list, at least 1)."""
    words = F.arrays_zip(F.slice("tokens", F.lit(1), F.size("parts")).alias("w"), F.col("parts").alias("parts"))
    own = ("c", "n", "k", "side", "s0", "s1")
    each = ordered.select(*own, F.greatest(F.array_max("parts"), F.lit(1)).alias("spread"), F.posexplode(words).alias("place", "x"))
    return each.select(*own, "spread", "place", F.col("x.w").alias("w"), F.col("x.parts").alias("parts"))


def joined(lists: DataFrame, threshold: float, sides: bool) -> DataFrame:
    """Elements of the lists of words that aren't frequent, as fetched() has them, by a join on the word. Both sides of it are one exchange; signatures are folded to 64 parities."""
    each = lists.where("parts = 0").select("w", "c", "n", "k", "side", "place", "spread", F.col("s0").bitwiseXOR(F.col("s1")).alias("s"))
    x, y = each.alias("x"), each.alias("y")
    col = F.col
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (col("x.n") + col("y.n")) - F.lit(EPS)).cast("int")
    k = F.least("x.k", "y.k")
    left = F.least(col("x.n") - col("x.place"), col("y.n") - col("y.place"))
    meets = (
        (col("x.w") == col("y.w"))
        & ((col("x.n") < col("y.n")) | ((col("x.n") == col("y.n")) & (col("x.c") < col("y.c"))))
        & (col("x.n") >= F.lit(threshold) * col("y.n") - F.lit(EPS))
        & (left + k - 1 >= need)
        & (F.bit_count(col("x.s").bitwiseXOR(col("y.s"))) <= col("x.n") + col("y.n") - 2 * need)
    )
    if sides:
        meets = meets & (((col("x.side").bitwiseAND(1) > 0) & (col("y.side").bitwiseAND(2) > 0)) | ((col("x.side").bitwiseAND(2) > 0) & (col("y.side").bitwiseAND(1) > 0)))
    return x.join(y.hint("merge"), meets).select(col("x.c").alias("c1"), F.greatest("x.spread", "y.spread").alias("spread"), col("x.place").alias("place"), col("y.c").alias("c2"), need.alias("need"), k.alias("k"), (left - 1).alias("room"))


def banded(lists: DataFrame, threshold: float, meet: int = MEET) -> DataFrame:
    """The lists of frequent words by key (word, size band, part of a list of over `meet` blocks): every element at home once, and, where its words allow a larger partner elsewhere, as an asker there."""
    base = float(np.log(max(1 / threshold, 1.25)))
    band = lambda n: F.floor(F.log(n.cast("double")) / F.lit(base)).cast("int")
    each = lists.where("parts > 0")
    # the largest partner for which the words from this one on are enough
    most = F.floor((F.col("n") - F.col("place") + F.col("k") - 1 + F.lit(1e-6)) * F.lit((1 + threshold) / threshold) + F.lit(1e-6)).cast("int") - F.col("n")
    each = each.withColumns({"upto": F.least(most, F.floor(F.col("n") / F.lit(threshold) + F.lit(1e-6)).cast("int")), "cuts": F.ceil(F.col("parts") / F.lit(meet)).cast("int"), "band": band(F.col("n"))})
    each = each.withColumns({"asks": F.col("upto") >= F.col("n"), "own": F.pmod(F.xxhash64("c"), "cuts").cast("int")})
    each = each.withColumn("copies", F.when(F.col("asks"), (band(F.col("upto")) - F.col("band") + 1) * F.col("cuts")).otherwise(1))
    each = each.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    there = F.col("band") + F.when(F.col("asks"), F.floor(F.col("at") / F.col("cuts")).cast("int")).otherwise(0)
    part = F.when(F.col("asks"), F.col("at") % F.col("cuts")).otherwise(F.col("own"))
    each = each.withColumns({"key": F.xxhash64("w", there, part), "home": (there == F.col("band")) & (part == F.col("own"))})
    return each.select("key", "c", "n", "k", "side", "s0", "s1", "place", "spread", F.when(F.col("asks"), F.col("upto")).otherwise(0).alias("upto"), "home")


def meeting(cols: dict[str, np.ndarray], threshold: float, sides: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of elements of whole lists of banded(), as fetched() has them, at most AT_ONCE matched at a time.

    Elements at home are sorted by list, size and place. An asker goes through the sizes of its list that it can reach;
    of each, the places up to a last one are left, and of these the signatures decide.
    """
    share = threshold / (1 + threshold)
    need_of = lambda a, b: np.ceil(share * (a + b) - EPS).astype(np.int64)
    n, k, place, upto, c = (cols[x].astype(np.int64) for x in ("n", "k", "place", "upto", "c"))
    group = np.cumsum(np.concatenate([[0], cols["key"][1:] != cols["key"][:-1]]))
    home, asks = np.flatnonzero(cols["home"]), np.flatnonzero(upto)
    if not len(home) or not len(asks):
        return
    home = home[np.lexsort((place[home], n[home], group[home]))]
    sizes, places = max(int(n.max()), int(upto.max())) + 2, int(place.max()) + 2
    code = group[home] * sizes + n[home]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    lists, at_size = code[first], n[home][first]
    by_place = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(code)))) * places + place[home]
    low, high = np.searchsorted(lists, group[asks] * sizes + n[asks]), np.searchsorted(lists, group[asks] * sizes + upto[asks], "right")
    s0, s1, side, spread = (cols[x] for x in ("s0", "s1", "side", "spread"))
    for asker, run in _ranges(asks, low, high):
        need = need_of(n[asker], at_size[run])
        last = np.minimum(at_size[run] - need + k[asker] - 1, places - 2)
        end = np.where((n[asker] - place[asker] + k[asker] - 1 >= need) & (last >= 0), np.searchsorted(by_place, run * places + last, "right"), first[run])
        for x, y in _ranges(asker, first[run], np.maximum(end, first[run])):
            y = home[y]
            need = need_of(n[x], n[y])
            differ = np.bitwise_count((s0[x] ^ s0[y]).view(np.uint64)).astype(np.int64) + np.bitwise_count((s1[x] ^ s1[y]).view(np.uint64))
            keep = differ <= n[x] + n[y] - 2 * need
            x, y, need = x[keep], y[keep], need[keep]
            least, left = np.minimum(k[x], k[y]), np.minimum(n[x] - place[x], n[y] - place[y])
            keep = ((n[x] < n[y]) | (c[x] < c[y])) & (n[x] >= threshold * n[y] - EPS) & (left + least - 1 >= need)
            if sides:
                keep &= (((side[x] & 1) > 0) & ((side[y] & 2) > 0)) | (((side[x] & 2) > 0) & ((side[y] & 1) > 0))
            x, y, need, least, left = (v[keep] for v in (x, y, need, least, left))
            if len(x):
                ints = (np.maximum(spread[x], spread[y]), place[x], need, least, left - 1)
                wide, at, needs, ks, room = (pa.array(v.astype(np.int32)) for v in ints)
                yield pa.RecordBatch.from_arrays([pa.array(c[x]), wide, at, pa.array(c[y]), needs, ks, room], names=["c1", "spread", "place", "c2", "need", "k", "room"])


def _ranges(of: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every member of `of` with every number from its low to below its high, in pieces of about AT_ONCE."""
    count = high - low
    ends = np.cumsum(count)
    a = 0
    while a < len(of):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + AT_ONCE, "right")))
        own = count[a:b]
        total = int(own.sum())
        if total:
            yield np.repeat(of[a:b], own), np.arange(total) - np.repeat(np.cumsum(own) - own, own) + np.repeat(low[a:b], own)
        a = b


def matched(batches: Iterator[pa.RecordBatch], threshold: float, sides: bool) -> Iterator[pa.RecordBatch]:
    """meeting() over rows of banded() sorted by key: gathers whole lists."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append({x: batch.column(x).to_numpy(zero_copy_only=False) for x in batch.schema.names})
        if sum(len(h["key"]) for h in held) < HELD or held[-1]["key"][-1] == held[0]["key"][0]:
            continue
        cols = {x: np.concatenate([h[x] for h in held]) for x in held[0]}
        # the last list may go on in the next batch
        cut = int(np.flatnonzero(cols["key"] != cols["key"][-1])[-1]) + 1
        held = [{x: v[cut:] for x, v in cols.items()}]
        yield from meeting({x: v[:cut] for x, v in cols.items()}, threshold, sides)
    if held:
        yield from meeting({x: np.concatenate([h[x] for h in held]) for x in held[0]}, threshold, sides)


def fetched(lists: DataFrame, threshold: float, sides: bool, meet: int = MEET) -> DataFrame:
    """Every set's short lists, one row per element: c1, slot, place (the list), c2, and need (overlap that the pair must reach), k (occurrences that it must reach), room (words that can still be common behind this one).

    The smaller set of a pair (ties by c) asks. Elements that the sizes, the words left behind this one, or the
    signatures rule out aren't fetched: a pair that signatures rule out is too unlike, however
    few of its words are counted. Where a set's lists are long, slot divides them by partner.
    """
    frequent = banded(lists, threshold, meet).repartition("key").sortWithinPartitions("key")
    frequent = frequent.mapInArrow(lambda it: matched(it, threshold, sides), "c1 long, spread int, place int, c2 long, need int, k int, room int")
    slot = F.pmod(F.xxhash64("c2"), "spread").cast("int")
    return joined(lists, threshold, sides).unionByName(frequent).select("c1", slot.alias("slot"), "place", "c2", "need", "k", "room")


def merge_skip(lists: list[tuple[int, int]], c2: list[int], k: list[int], need: list[int], room: list[int]) -> list[tuple[int, int, int, int]]:
    """Partners that occur on enough of one set's lists: (c2, occurrences, need, k).

    lists: (start, end) of each list in the columns, in the order of the set's words, elements ascending. A heap holds
    the head of every list. Elements equal to the smallest head are taken off and counted; if they are too few
    for any partner, further heads that can't make up the number are taken off as well, and all of these lists
    jump to the new smallest head.
    """
    least = min(min(k[a:b]) for a, b in lists)
    if len(lists) < least:
        return []
    heap = [(c2[a], x, a) for x, (a, _) in enumerate(lists)]
    heapq.heapify(heap)
    out = []
    while len(heap) >= least:
        top = heap[0][0]
        taken = []
        while heap and heap[0][0] == top:
            taken.append(heapq.heappop(heap))
        at = taken[-1][2]  # the occurrence on the rearmost list
        n = len(taken)
        if n >= k[at] and n + room[at] >= need[at]:
            out.append((top, n, need[at], k[at]))
        if n >= least:
            for _, x, a in taken:
                if a + 1 < lists[x][1]:
                    heapq.heappush(heap, (c2[a + 1], x, a + 1))
            continue
        while heap and len(taken) < least - 1:
            taken.append(heapq.heappop(heap))
        if not heap:
            break
        goal = heap[0][0]
        for _, x, a in taken:
            a = bisect_left(c2, goal, a, lists[x][1])
            if a < lists[x][1]:
                heapq.heappush(heap, (c2[a], x, a))
    return out


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """merge_skip over sorted rows of fetched(): candidates c1, c2, m (occurrences), need, k."""
    names = ("c1", "slot", "place", "c2", "need", "k", "room")
    held: list[np.ndarray] | None = None

    def search(cols: list[np.ndarray]) -> pa.RecordBatch:
        c1, slot, place, c2, need, k, room = cols
        new_set = np.concatenate([[True], (c1[1:] != c1[:-1]) | (slot[1:] != slot[:-1])])
        new_list = np.flatnonzero(new_set | np.concatenate([[True], place[1:] != place[:-1]]))
        ends = np.append(new_list[1:], len(c1)).tolist()
        first = np.flatnonzero(np.append(new_set[new_list], True)).tolist()
        starts, own = new_list.tolist(), c1[new_list].tolist()
        c2, k, need, room = c2.tolist(), k.tolist(), need.tolist(), room.tolist()
        out = []
        for a, b in zip(first, first[1:]):
            out += [(own[a], *found) for found in merge_skip(list(zip(starts[a:b], ends[a:b], strict=True)), c2, k, need, room)]
        cols_out = zip(*out, strict=True) if out else ([],) * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(cols_out, kinds, strict=True)], names=["c1", "c2", "m", "need", "k"])

    for batch in batches:
        cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if held is not None:
            cols = [np.concatenate(both) for both in zip(held, cols, strict=True)]
        # the last set may go on in the next batch
        same = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1])) if len(cols[0]) else []
        cut = int(same[-1]) + 1 if len(same) else 0
        held = [x[cut:] for x in cols]
        if cut:
            yield search([x[:cut] for x in cols])
    if held is not None and len(held[0]):
        yield search(held)


def probe(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Looks the words that weren't merged up by binary search and keeps the pairs of likeness >= threshold: those of the first set's long lists in all of the other's words, those of its short lists in the other's long ones."""
    for batch in batches:
        one, two = batch.column("t1"), batch.column("t2")
        a, b, at, bt = one.flatten().to_numpy(zero_copy_only=False), two.flatten().to_numpy(zero_copy_only=False), one.offsets.to_numpy(), two.offsets.to_numpy()
        at, bt = at - at[0], bt - bt[0]
        merged_, need, k = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("m", "need", "k"))
        likeness = np.zeros(batch.num_rows)
        for i in range(batch.num_rows):
            r, s = a[at[i] : at[i + 1]], b[bt[i] : bt[i + 1]]
            mine, theirs = len(r) - need[i] + k[i], len(s) - need[i] + k[i]
            common = merged_[i] + _found(r[mine:], np.sort(s)) + _found(r[:mine], np.sort(s[theirs:]))
            likeness[i] = common / (len(r) + len(s) - common)
        keep = pa.array(np.flatnonzero(likeness >= threshold - EPS))
        yield pa.RecordBatch.from_arrays([batch.column("c1").take(keep), batch.column("c2").take(keep), pa.array(likeness).take(keep)], names=["c1", "c2", "likeness"])


def _found(words: np.ndarray, ordered: np.ndarray) -> int:
    if not len(ordered) or not len(words):
        return 0
    at = np.minimum(np.searchsorted(ordered, words), len(ordered) - 1)
    return int((ordered[at] == words).sum())


def similar_classes(sets: DataFrame, threshold: float, sides: bool = False, block: int = BLOCK, cells: int = CELLS, mu: float = MU, most: int = MOST_FREQUENT, meet: int = MEET) -> DataFrame:
    """All pairs of classes with likeness >= threshold, each once: c1, c2, likeness.

    sets: c (long, unique), tokens (distinct longs), side (int; 1 and 2 are the sides of a two-sided join, 3 both).
    The frame should be a written table: it is read twice. Empty sets and sets of one word have no partner but
    themselves. Exact: order and division of the lists only decide how much is read.
    """
    if not 0.5 <= threshold <= 1:
        raise ValueError("threshold must lie between 0.5 and 1")
    ordered = written(ordered_sets(sets, word_order(sets, block, cells, most), threshold, mu), "ordered-sets")
    rows = fetched(short_lists(ordered), threshold, sides, meet).repartition("c1", "slot").sortWithinPartitions("c1", "slot", "place", "c2")
    found = rows.mapInArrow(merged, "c1 long, c2 long, m int, need int, k int")
    one, two = ordered.select(F.col("c").alias("c1"), F.col("tokens").alias("t1")), ordered.select(F.col("c").alias("c2"), F.col("tokens").alias("t2"))
    return found.join(one, "c1").join(two, "c2").mapInArrow(lambda it: probe(it, threshold), "c1 long, c2 long, likeness double")


def set_classes(rows: DataFrame, name: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Groups rows (id, tokens, side) by equal word sets.

    Returns the written classes (c, tokens, side) and the members (id, c, and the columns named in keep). An id counts once: should its rows
    differ, the one of the smallest class is kept. Classes are named by a 64-bit fingerprint of the sorted set.
    """
    keyed = rows.withColumn("c", F.xxhash64(F.lit(7), "tokens"))
    members = keyed.groupBy("id").agg(F.min(F.struct("c", *keep)).alias("m")).select("id", "m.*") if keep else keyed.groupBy("id").agg(F.min("c").alias("c"))
    classes = keyed.groupBy("c").agg(F.first("tokens").alias("tokens"), F.bit_or("side").cast("int").alias("side"))
    return written(classes, name), members
