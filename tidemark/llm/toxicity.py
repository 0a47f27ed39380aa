"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are a bounded sample of labelled rows (``EXAMPLES`` of each class, chosen by hash of the key). Vectors hold every word of a text and
the first ``STEM`` bytes of longer ones, as insults inflect. A term's weight is its inverse document frequency over the whole corpus times
how far the examples with the term part from the share of the classes, never below ``FLOOR``: no term is left out, and words that have nothing to
do with the label weigh little. Terms of a text that no example has count for its length.

Texts are read once: every row's terms are numbered and written as (numbers, counts), from which corpus counts and vectors are made.

The index holds postings in blocks of ``BLOCK`` examples, with each term's greatest weight in each block. For a query the
block maxima give an upper bound of any cosine in a block. The block with the greatest bound is scored first, then all whose bound reaches
the k-th best cosine of it. Common terms are scored for many queries at once as a product of matrices in single precision; every example that its
error bound leaves among the k best gets its cosine in double precision, so the neighbours are exact. They vote with weights that grow with the
cosine and undo the sampling of the classes; the rate of the labels is mixed in, so few or far neighbours give
scores near it. The neighbours are the evidence.
"""

from __future__ import annotations

import hashlib
import math
import struct
import uuid
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ascii_words, columns, hash_sample, is_held_out, map_texts, quoted, written

#: Labelled rows used of each class; neighbours; examples of a block; power of the cosine in a vote; weight of the base rate.
EXAMPLES, NEIGHBOURS, BLOCK, POWER, SMOOTH = 2_000, 25, 512, 2.0, 0.5
#: Bytes of a stem; weight of a term that says nothing of the label; examples of the overall share mixed into a term's share; terms a task counts before it sends them on.
STEM, FLOOR, PRIOR, FLUSH = 5, 0.02, 4.0, 500_000
THRESHOLD = 0.5
#: Terms in more than one of so many examples have their postings as rows of a matrix for each block.
DENSE_PART = 16
#: Results of texts remembered by a task, as copies are common; queries scored at once.
REMEMBERED, TOGETHER = 20_000, 64


def terms_of(text: str | None) -> Counter:
    """Occurrences of words and stems; a stem is marked by a sign that no word has."""
    out = Counter(ascii_words(text))
    stems: dict[bytes, int] = defaultdict(int)
    for word, n in out.items():
        if len(word) > STEM:
            stems[b"^" + word[:STEM]] += n
    out.update(stems)
    return out


def _sums(found: dict[bytes, list[int]], names: list[str]) -> pa.RecordBatch:
    terms = list(found)
    return pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), *(pa.array([found[t][i] for t in terms], pa.int64()) for i in range(len(names) - 1))], names)


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, n0, n1): the rows of each label y with the term. A task sends sums, not occurrences."""

    def count(batches):
        found: dict[bytes, list[int]] = {}
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for t in terms_of(text):
                    found.setdefault(t, [0, 0])[y] += 1
            if len(found) > FLUSH:
                yield _sums(found, ["term", "n0", "n1"])
                found = {}
        yield _sums(found, ["term", "n0", "n1"])

    parts = rows.select("text", "y").mapInArrow(count, "term binary, n0 bigint, n1 bigint")
    return parts.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def counted(rows: DataFrame, terms: list[bytes], keep: list[str]) -> DataFrame:
    """``keep`` and the known terms of each text: ``at`` (their numbers in order) and ``n`` (occurrences) as 32-bit integers, ``rest`` of the others."""
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def make():
        vectors = Vectors(shared.value, np.zeros(0), 0.0)

        def fn(texts):
            got = [vectors.count(terms_of(t)) for t in texts]
            return [[at.tobytes() for at, _, _ in got], [n.tobytes() for _, n, _ in got], [rest for _, _, rest in got]]
        return fn

    return map_texts(rows, make, [("at", "binary"), ("n", "binary"), ("rest", "double")], keep)


def corpus_counts(rows: DataFrame, size: int) -> DataFrame:
    """(id, n): counted rows with each of the ``size`` terms. A task sends sums."""

    def count(batches):
        found = np.zeros(size, np.int64)
        for batch in batches:
            for at in batch.column(0).to_pylist():
                found[np.frombuffer(at, np.int32)] += 1  # a row has each number once
        hit = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(found[hit], pa.int64())], ["id", "n"])

    return rows.select("at").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def class_weight(n0: np.ndarray, n1: np.ndarray, share: float) -> np.ndarray:
    """How far the examples with a term part from the share of class 1 (relative entropy of the smoothed shares), plus the floor."""
    r = (n1 + PRIOR * share) / (n0 + n1 + PRIOR)
    return FLOOR + np.maximum(r * np.log(r / share) + (1 - r) * np.log((1 - r) / (1 - share)), 0)


class Vectors:
    """Weights of terms, and unit vectors of texts over them."""

    def __init__(self, terms: list[bytes], weights: np.ndarray, unknown: float):
        self.at, self.weights, self.unknown = {t: i for i, t in enumerate(terms)}, weights, unknown

    def count(self, counts: Counter) -> tuple[np.ndarray, np.ndarray, float]:
        """(numbers, occurrences) of the known terms, by number; squared frequency weights of the others, summed."""
        at = np.fromiter(map(self.at.get, counts, repeat(-1)), np.int32, len(counts))
        n = np.fromiter(counts.values(), np.int32, len(counts))
        known = np.flatnonzero(at >= 0)
        order = known[np.argsort(at[known])]
        return at[order], n[order], float(np.square(1 + np.log(n[at < 0])).sum())

    def unit(self, at: np.ndarray, n: np.ndarray, rest: float) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of counted terms; the length is that of all terms."""
        w = (1 + np.log(n)) * self.weights[at]
        length = math.sqrt(float(w @ w) + self.unknown ** 2 * rest)
        return at, w / length if length else w

    def __call__(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        return self.unit(*self.count(counts))


class Index:
    """Block-max inverted index over example vectors."""

    def __init__(self, vectors: Vectors, examples: list[tuple[str, int, np.ndarray, np.ndarray]], weights: tuple[float, float] = (1.0, 1.0), prior: float = 0.0):
        self.vectors, self.weights, self.prior = vectors, weights, prior
        # like examples side by side, so block maxima are tight; the order itself changes no result
        examples = sorted((e for e in examples if len(e[2])), key=lambda e: (e[1], int(e[2][np.argmax(e[3])]), e[0]))
        self.keys = [e[0] for e in examples]
        self.rank = np.argsort(np.argsort(np.array(self.keys, dtype=str), kind="stable"), kind="stable") if examples else np.zeros(0, int)
        self.labels = np.array([e[1] for e in examples], dtype=int)
        self.blocks = -(-len(examples) // BLOCK)
        size = len(vectors.weights)
        term = np.concatenate([e[2] for e in examples]) if examples else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(examples)), [len(e[2]) for e in examples])
        order = np.argsort(term, kind="stable")
        self.owner, self.w = owner[order], (np.concatenate([e[3] for e in examples]) if examples else np.zeros(0))[order]
        # place of the first posting of each term in each block, and the greatest weight there
        cell = term[order] * max(self.blocks, 1) + self.owner // BLOCK
        counts = np.bincount(cell, minlength=size * max(self.blocks, 1))
        self.begin = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        self.maxima = np.zeros(size * max(self.blocks, 1), np.float32)
        # rounded up, so that a bound stays a bound
        np.maximum.at(self.maxima, cell, np.nextafter(self.w.astype(np.float32), np.float32(np.inf)))
        self.maxima = self.maxima.reshape(size, max(self.blocks, 1))
        counts = np.bincount(term, minlength=size)
        common = np.flatnonzero(counts * DENSE_PART > len(examples))
        self.row = np.full(size, -1, np.int64)
        self.row[common] = np.arange(len(common))
        rows = self.row[term[order]]
        held = rows >= 0
        self.dense = np.zeros((self.blocks, len(common), BLOCK), np.float32)
        self.dense[self.owner[held] // BLOCK, rows[held], self.owner[held] % BLOCK] = self.w[held]
        # bound of the error of a cosine from the matrices, as absolute products of unit vectors add up to 1 at most
        self.slack = (len(common) + 8) * 2.0 ** -24
        # the same in double precision, example by example
        self.common = np.zeros((self.blocks * BLOCK, len(common)))
        self.common[self.owner[held], rows[held]] = self.w[held]
        # postings of the other terms are read in short runs all over memory, so they are kept small
        self.owner = self.owner.astype(np.min_scalar_type(max(len(examples), 1)))
        self.known: dict[bytes, tuple[float, list[str]]] = {}
        self.scored_blocks = 0

    def _score(self, need: np.ndarray, queries: list, table: np.ndarray, near: np.ndarray, rest: np.ndarray) -> None:
        """Cosines of the queries with the needed blocks, within the slack, into ``near``; their parts from uncommon terms into ``rest``."""
        self.scored_blocks += int(need.sum())
        for b in range(self.blocks):
            at = np.flatnonzero(need[:, b])
            if len(at):
                near[at, b * BLOCK:(b + 1) * BLOCK] = table[at].astype(np.float32) @ self.dense[b]
        for j in np.flatnonzero(need.any(axis=1)).tolist():
            terms, weights = queries[j]
            rare = self.row[terms] < 0
            low, high = np.flatnonzero(need[j])[[0, -1]].tolist()
            base = terms[rare].astype(np.int64) * self.blocks
            begin = self.begin[base + low].astype(np.int64)
            count = self.begin[base + high + 1] - begin
            at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            found = np.bincount(self.owner[at], weights=self.w[at] * np.repeat(weights[rare], count), minlength=near.shape[1])
            for b in np.flatnonzero(need[j]).tolist():
                part = slice(b * BLOCK, (b + 1) * BLOCK)
                rest[j, part] = found[part]
                near[j, part] += found[part]

    def _kth(self, near: np.ndarray, k: int) -> float:
        """The k-th best cosine, 0 if there are fewer."""
        return max(0.0, float(np.partition(near, len(near) - k)[len(near) - k])) if len(near) >= k else 0.0

    def nearest_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> list[list[tuple[int, float]]]:
        """For each query (example, cosine) of the k nearest with a cosine over 0; among equal cosines the smaller keys."""
        if not queries or not self.blocks:
            return [[] for _ in queries]
        table = np.zeros((len(queries), self.dense.shape[1]))
        for j, (terms, weights) in enumerate(queries):
            rows = self.row[terms]
            table[j, rows[rows >= 0]] = weights[rows >= 0]
        bounds = np.stack([weights @ self.maxima[terms] for terms, weights in queries])
        near, rest = np.full((len(queries), self.blocks * BLOCK), -9, np.float32), np.zeros((len(queries), self.blocks * BLOCK))
        first = np.arange(self.blocks) == bounds.argmax(axis=1)[:, None]
        first &= bounds > 0
        self._score(first, queries, table, near, rest)
        kth = np.array([self._kth(n, k) for n in near])
        self._score((bounds > 0) & (bounds >= (kth - self.slack - 1e-6)[:, None]) & ~first, queries, table, near, rest)
        out = []
        for n, uncommon, weights in zip(near, rest, table):
            some = np.flatnonzero((n > 0) & (n >= self._kth(n, k) - 2 * self.slack - 1e-6))
            cosine = np.round(uncommon[some] + self.common[some] @ weights, 9)
            order = np.lexsort((self.rank[some], -cosine))[:k]
            out.append([(i, s) for i, s in zip(some[order].tolist(), cosine[order].tolist()) if s > 0])
        return out

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[int, float]]:
        """``nearest_all`` of one query."""
        return self.nearest_all([(terms, weights)], k)[0]

    def _vote(self, near: list[tuple[int, float]]) -> tuple[float, list[str]]:
        """Score, and the keys of the neighbours as evidence."""
        votes = [0.0, 0.0]
        for i, s in near:
            y = int(self.labels[i])
            votes[y] += s ** POWER * self.weights[y]
        return (votes[1] + SMOOTH * self.prior) / (votes[0] + votes[1] + SMOOTH), [self.keys[i] for i, _ in near]

    def scores(self, ats: list[bytes], ns: list[bytes], rests: list[float]) -> list[tuple[float, list[str]]]:
        """Votes for counted texts. Equal texts share a result."""
        names = [hashlib.blake2b(at + n + struct.pack("<d", rest), digest_size=16).digest() for at, n, rest in zip(ats, ns, rests)]
        got = {name: self.known[name] for name in names if name in self.known}
        new = list({name: j for j, name in enumerate(names) if name not in got}.items())
        for i in range(0, len(new), TOGETHER):
            part = new[i:i + TOGETHER]
            queries = [self.vectors.unit(np.frombuffer(ats[j], np.int32), np.frombuffer(ns[j], np.int32), rests[j]) for _, j in part]
            got.update(zip([name for name, _ in part], map(self._vote, self.nearest_all(queries))))
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        self.known.update(got)
        return [got[name] for name in names]


_BUILT: dict[str, Index] = {}


def _index(model) -> Index:
    """The index of a broadcast model, built once in a Python worker."""
    if model.value[0] not in _BUILT:
        _BUILT.clear()
        number, weights, unknown, examples, votes, prior = model.value
        vectors = Vectors([], weights, unknown)
        made = [(key, y, *vectors.unit(np.frombuffer(at, np.int32), np.frombuffer(n, np.int32), rest)) for key, y, at, n, rest in examples]
        _BUILT[number] = Index(vectors, made, votes, prior)
    return _BUILT[model.value[0]]


def fit(docs: DataFrame, labels: DataFrame, key: str, label: str, examples: int = EXAMPLES) -> tuple[DataFrame | None, tuple, float]:
    """All texts counted, (weights, weight of unknown terms, examples, class weights), base rate; from labelled rows that are not held out.

    The driver holds the terms of at most 2 x ``examples`` texts. One class alone, or none, gives no examples and no counts.
    """
    taught = labels.select(F.col(quoted(key)).alias("key"), F.col(quoted(label)).cast("int").alias("y")).where("key is not null and y in (0, 1)")
    taught = written(taught.where(~is_held_out(F.col("key"))).groupBy("key").agg(F.max("y").alias("y")), "labels")
    rows = {r["y"]: r["count"] for r in taught.groupBy("y").count().collect()}
    chosen = written(hash_sample(taught.where("y = 1"), "key", examples).withColumn("y", F.lit(1)).unionByName(
        hash_sample(taught.where("y = 0"), "key", examples).withColumn("y", F.lit(0))), "chosen")
    found = docs.join(F.broadcast(chosen), "key").select("key", "text", "y")  # at most 2 * examples keys
    sample = written(found.groupBy("key", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")), "examples")
    n = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    base = rows.get(1, 0) / max(1, rows.get(0, 0) + rows.get(1, 0))
    if not n0 or not n1:
        return None, (), base
    table = term_counts(sample.dropDuplicates(["text", "y"])).orderBy("term").toArrow()
    terms = table["term"].to_pylist()
    every = written(counted(docs, terms, ["key"]), "counted", compression="zstd")
    having, total = corpus_counts(every, len(terms)).toArrow(), every.count()
    n_docs = np.zeros(len(terms), np.int64)
    n_docs[having["id"].to_numpy()] = having["n"].to_numpy()
    idf = np.log((1 + total) / (1 + n_docs)) + 1
    weights = idf * class_weight(table["n0"].to_numpy(), table["n1"].to_numpy(), n1 / (n0 + n1))
    unknown = (math.log(1 + total) + 1) * FLOOR
    made = counted(sample, terms, ["key", "y"]).orderBy("key").collect()  # at most 2 * examples rows
    vectors = [(str(r["key"]), r["y"], bytes(r["at"]), bytes(r["n"]), r["rest"]) for r in made]
    return every, (weights, unknown, vectors, (rows[0] / max(1, n0), rows[1] / max(1, n1))), base


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", evidence: bool = True,
           examples: int = EXAMPLES) -> DataFrame:
    """(key, held_out, score, predicted, neighbours) of every row of ``docs``; the neighbours are keys of examples.

    Null keys and labels teach nothing; of several labels of a key the greatest counts, of several texts the least.
    A text that shares no term with an example (empty and null ones, too) scores the share of class 1 among the labels, and so does every text
    if a class is empty. However few labels there are, each example finds itself.
    """
    narrow = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    every, fitted, base = fit(narrow, labels, key, label, examples)
    fields = [("score", "double"), ("predicted", "int")] + ([("neighbours", "array<string>")] if evidence else [])
    if every is None:
        out = narrow.select("key", F.lit(base).alias("score"), F.lit(int(base >= THRESHOLD)).alias("predicted"), F.array().cast("array<string>").alias("neighbours"))
    else:
        model = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, *fitted, base))

        def make():
            index = _index(model)

            def fn(*counts):
                got = index.scores(*counts)
                return [[g[0] for g in got], [int(g[0] >= THRESHOLD) for g in got], *([[g[1] for g in got]] if evidence else [])]
            return fn

        out = map_texts(every, make, fields, ["key"], ["at", "n", "rest"])
    return out.select(F.col("key").alias(key), is_held_out(F.col("key")).alias("held_out"), *columns([n for n, _ in fields]))
