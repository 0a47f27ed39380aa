"""Benchmark decontamination: Wu-Manber multi-pattern search with words as symbols.

A test item is cut into windows of 13 consecutive words (a shorter item is one window). Windows of one length are
searched together: the table of *block shifts* maps each pair of neighbouring words of a window to its smallest
distance from a window's end, so a position whose last two words are in no window is left by a full window length less
one; the pairs at a window's end are the *suffix hash*, each with a bucket of windows; and a window of a bucket
counts only if a *direct comparison* of all its words succeeds.

Windows are cut and counted in Spark. They go to the tasks in blocks of at most ``block_bytes``: as a rule one, so
documents are read once and not shuffled; a larger benchmark takes one pass for each block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ascii_words, columns, free_name, map_texts, written

WINDOW = 13
BLOCK_BYTES = 64 << 20
SPANS = "array<struct<start:int,end:int>>"


class WuManber:
    """Search tables over windows, which are (words, item ids) pairs."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[str]]):
        self.items = windows
        self.by_length: dict[int, tuple[dict, dict]] = {}
        for words in windows:
            shifts, buckets = self.by_length.setdefault(len(words), ({}, {}))
            size = min(2, len(words))
            for end in range(size, len(words) + 1):
                block = words[end - size:end]
                shifts[block] = min(shifts.get(block, len(words)), len(words) - end)
            buckets.setdefault(words[len(words) - size:], {}).setdefault(words[0], []).append(words)

    def find(self, words: list[bytes]) -> list[tuple[int, int, tuple[bytes, ...]]]:
        """(start, end, window) of every occurrence, in words."""
        found, n = [], len(words)
        for length, (shifts, buckets) in self.by_length.items():
            size = min(2, length)
            most, end = length - size + 1, length
            shift_of = shifts.get
            while end <= n:
                block = tuple(words[end - size:end])
                step = shift_of(block, most)
                if step:
                    end += step
                    continue
                for window in buckets[block].get(words[end - length], ()):
                    if tuple(words[end - length:end]) == window:
                        found.append((end - length, end, window))
                end += 1
        return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same words."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def item_windows(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (window, item): the item's windows as space-joined words. A null text has none; a null id stays null."""

    def make():
        def fn(texts):
            out = []
            for t in texts:
                words = ascii_words(t)
                k = min(window, len(words))
                out.append([b" ".join(words[i:i + k]).decode() for i in range(len(words) - k + 1)] if k else [])
            return [out]
        return fn

    cut = map_texts(benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")), make,
                    [("windows", "array<string>")], keep=["item"])
    return cut.select("item", F.explode("windows").alias("window")).distinct()


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
               block_bytes: int = BLOCK_BYTES, names: tuple[str, str, str] = ("n_words", "hits", "items")) -> DataFrame:
    """All columns of ``docs`` plus the number of words, the disjoint hit spans (word positions) and the item ids found.

    A null or empty text has no words; an item without words matches nothing; an item with a null id marks words but is
    not listed; equal items, equal ids and repeated documents are each treated alone; an empty benchmark finds nothing.
    The three names must not be taken.
    """
    spark = docs.sparkSession
    windows = written(item_windows(benchmark, window), "windows")
    total = windows.agg(F.coalesce(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0)) + 100), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_bytes))
    n, hits, items = names
    keep = docs.columns
    out = docs
    for b in range(blocks):
        # at most block_bytes by the sum above, up to the evenness of the hash
        patterns: dict[tuple[bytes, ...], list[str]] = {}
        for row in windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == b).collect():
            patterns.setdefault(tuple(row["window"].encode().split()), []).append(row["item"])
        shared = spark.sparkContext.broadcast(patterns)

        def make(shared=shared):
            search = WuManber(shared.value)

            def fn(texts, old_hits=None, old_items=None):
                counts, spans, ids = [], [], []
                for i, t in enumerate(texts):
                    words = ascii_words(t)
                    found = search.find(words)
                    span = [(s, e) for s, e, _ in found]
                    names_found = {x for _, _, w in found for x in search.items[w] if x is not None}
                    if old_hits is not None:
                        span += [(x["start"], x["end"]) for x in old_hits[i]]
                        names_found |= set(old_items[i])
                    counts.append(len(words))
                    spans.append([{"start": s, "end": e} for s, e in merged(span)])
                    ids.append(sorted(names_found))
                return [counts, spans, ids]
            return fn

        fields = [(n, "bigint"), (hits, SPANS), (items, "array<string>")]
        if b == 0:
            out = map_texts(out, make, fields, keep, [text])
        else:
            renamed = written(out, "hits").withColumnsRenamed({hits: (h := free_name(out, "old_hits")), items: (k := free_name(out, "old_items"))}).drop(n)
            out = map_texts(renamed, make, fields, keep, [text, h, k])
    return out


def n_hit(hits: str) -> F.Column:
    """Words inside the spans."""
    return F.aggregate(F.col(hits), F.lit(0).cast("bigint"), lambda a, x: a + (x["end"] - x["start"]))


def is_contaminated(words: F.Column, hit: F.Column) -> F.Column:
    """Any hit, and a twentieth of the words at least."""
    return (hit > 0) & (20 * hit >= words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    names = tuple(free_name(docs, x) for x in ("n_words", "hits", "items"))
    found = find_items(docs, benchmark, window, text, names=names)
    return found.where(~is_contaminated(F.col(names[0]), n_hit(names[1]))).select(*columns(docs.columns))
