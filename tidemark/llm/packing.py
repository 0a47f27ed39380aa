"""Lexical retrieval packing: BM25 neighbours of a seed document fill its window.

1. ``tokenised``: token ids of whole texts, written once.
2. ``document_frequencies``: documents that hold each token, over all documents; a vocabulary of numbers.
3. Whole windows of long documents are sequences of their own. What is left of each document, less than a window, is sorted by
   its most telling token across the cluster, so related documents meet; ``BLOCK_DOCS`` neighbours in that order are one shard.
4. Each shard builds an inverted index of token ids with BM25 weights. The first unused document is the seed; unused documents
   by falling score fill its window; the one that does not fit is cut and its rest is the next seed. What does not fill a
   window goes on to the next shard of the task. The last rest of a task is cut into sequences of 2^i tokens: no padding.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import quoted, written

WINDOW, END = 2048, 1
K1, B = 1.2, 0.75
#: Documents of one shard, and the token bytes a task of the packing stage is planned for (its memory is bounded by the shard).
BLOCK_DOCS, TASK_BYTES = 2048, 32 << 20
#: Tokens in more than one of so many documents of a shard are scored as matrix rows; neighbours sorted at first; documents sampled for each task's bounds.
DENSE_PART, FIRST, SAMPLE = 8, 64, 200
#: Tasks of the packing stage at most: the driver holds one bound for each. A task works shard by shard, so its size bounds no memory.
MOST_TASKS = 20_000

#: Words of a byte-level BPE, as its format fixes them.
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# texts left to the tokenizer library: characters whose classes may differ between versions of Unicode, very long white space
_RARE = re.compile("[^\x00-\u024f\u2010-\u2027]")
# bytes of white space below U+0250 become spaces
_SPACES = bytes(32 if b in b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \xc2\x85\xa0" else b for b in range(256))
_LONG_SPACE = b" " * 256

_PIECES = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType()),
           ("sequence_id", T.LongType()), ("offset", T.LongType())]


def _ranks(path: str) -> dict[bytes, int] | None:
    """Bytes and rank of each token of a plain byte-level BPE whose ids are in order of its merges; None for any other tokenizer."""
    from tokenizers.pre_tokenizers import ByteLevel

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or spec["normalizer"] or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
        return None
    # a byte is written as its own character or, if that doesn't print, as one from 256 on
    letters = sorted(ByteLevel.alphabet())
    own = {c: ord(c) for c in letters if ord(c) < 256}
    byte = own | dict(zip((c for c in letters if ord(c) >= 256), (b for b in range(256) if b not in own.values())))
    vocab = model["vocab"]
    merges = [m if isinstance(m, str) else "".join(m) for m in model["merges"]]
    if any(vocab.get(m.replace(" ", "")) != 256 + i for i, m in enumerate(merges)) or len(byte) != 256:
        return None
    return {bytes(byte[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}


class Encoder:
    """Ids of texts as the tokenizer library gives them.

    For a plain byte-level BPE tiktoken gives the same ids in a third of the time, with ranks made from the same file. Texts with
    special tokens, characters of which the two libraries' tables might differ, or very long white space go to the tokenizer library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = _ranks(path)
        self.fast = ranks and tiktoken.Encoding("ranks", pat_str=_WORD, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> bool:
        return not (not text.isascii() and _RARE.search(text) or any(s in text for s in self.specials) or _LONG_SPACE in text.encode().translate(_SPACES))

    def __call__(self, texts: list[str]) -> list[list[int]]:
        out = [self.fast.encode_ordinary(t) if self.fast and self._plain(t) else None for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.tokenizer.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path)


def width(path: str) -> str:
    """The smallest whole-number type of numpy that holds the ids of a tokenizer."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def tokenised(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """(key, n, ids): tokens of each text with ``end`` behind them; a null text holds that one only."""
    src = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    kind = width(path)

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            ids = [np.fromiter((*x, end), kind, len(x) + 1) for x in encode([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                                             ["key", "n", "ids"])

    return src.mapInArrow(run, T.StructType([src.schema["key"], T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())]))


def _distinct(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token, times) of every distinct token of each document, in that order."""
    if not ids:
        return (np.zeros(0, np.int64),) * 3
    owners = np.repeat(np.arange(len(ids), dtype=np.int64), [len(x) for x in ids])
    pairs, times = np.unique(owners << 32 | np.concatenate(ids), return_counts=True)
    return pairs >> 32, pairs & 0xFFFFFFFF, times


def _terms(ids: np.ndarray) -> np.ndarray:
    return ids[:-1]  # without the end token


def document_frequencies(tokens: DataFrame, kind: str) -> np.ndarray:
    """For each token the number of documents that hold it. One row a token and task travels, then the vocabulary."""

    def run(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            _, term, _ = _distinct([_terms(np.frombuffer(b, kind)) for b in batch.column(0).to_pylist()])
            if len(term):
                counts = np.pad(counts, (0, max(0, int(term.max()) + 1 - len(counts))))
                counts += np.bincount(term, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], ["token", "n"])

    rows = tokens.select("ids").mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(1 + max([0, *(r["token"] for r in rows)]), np.int64)
    for r in rows:
        out[r["token"]] = r["n"]
    return out


class Weights:
    """BM25 weights from the counts of the whole corpus."""

    def __init__(self, frequencies: np.ndarray, n_docs: int, mean: float):
        self.idf = np.log1p((n_docs - frequencies + 0.5) / (frequencies + 0.5))
        self.mean = max(mean, 1.0)

    def __call__(self, term: np.ndarray, times: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return self.idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * lengths / self.mean))


class Shard:
    """Inverted index over the documents of one shard."""

    def __init__(self, ids: list[np.ndarray], weights: Weights):
        terms = [_terms(x) for x in ids]
        doc, term, times = _distinct(terms)
        lengths = np.array([len(x) for x in terms], np.float64)
        self.n = len(ids)
        names, term = np.unique(term, return_inverse=True)
        weight = weights(names[term], times, lengths[doc]) if len(doc) else np.zeros(0)
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order], weight[order]
        self.begin = np.searchsorted(term[order], np.arange(len(names) + 1))
        self.of = np.split(term, np.searchsorted(doc, np.arange(1, self.n)))
        # postings of tokens that stand in an eighth of the documents, as rows of a matrix: at most 8 x tokens of a document of them
        counts = np.diff(self.begin)
        common = np.flatnonzero(counts * DENSE_PART > self.n)
        self.row = np.full(len(names), -1, np.int64)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), self.n), np.float32)
        held = self.row[term] >= 0
        self.dense[self.row[term[held]], doc[held]] = weight[held]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every document of the shard for the distinct tokens of one."""
        rows = self.row[self.of[seed]]
        wanted = np.zeros(len(self.dense), np.float32)
        wanted[rows[rows >= 0]] = 1
        terms = self.of[seed][rows < 0]
        begin, count = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return np.bincount(self.docs[at], weights=self.weights[at], minlength=self.n) + wanted @ self.dense


def _falling(scores: np.ndarray) -> Iterator[int]:
    """Documents of score 0 or more by falling score, ties in their order; the best few are sorted first."""
    top = scores
    if len(scores) > 4 * FIRST:
        least = max(np.partition(scores, -FIRST)[-FIRST], 0)
        best = np.flatnonzero(scores >= least)
        yield from best[np.argsort(-scores[best], kind="stable")]
        top = np.where(scores >= least, -1.0, scores)
    rest = np.flatnonzero(top >= 0)
    yield from rest[np.argsort(-top[rest], kind="stable")]


class Rest:
    """What is still unpacked of a document."""

    __slots__ = ("key", "start", "ids", "total")

    def __init__(self, key, start: int, ids: np.ndarray, total: int):
        self.key, self.start, self.ids, self.total = key, start, ids, total

    def cut(self, n: int) -> Rest:
        head = Rest(self.key, self.start, self.ids[:n], self.total)
        self.start, self.ids = self.start + n, self.ids[n:]
        return head


def fill(rests: list[Rest], weights: Weights, window: int) -> tuple[list[list[Rest]], list[Rest]]:
    """Full sequences of one shard and the documents that fill none. Every rest is shorter than a window."""
    index = Shard([r.ids for r in rests], weights)
    unused = np.ones(len(rests), bool)
    full: list[list[Rest]] = []
    at, seed = 0, None
    while True:
        if seed is None:
            while at < len(rests) and not unused[at]:
                at += 1
            if at == len(rests):
                return full, []
            seed = at
            unused[seed] = False
        sequence, room = [rests[seed]], window - len(rests[seed].ids)
        scores = np.where(unused, index.scores(seed), -1.0)
        seed = None
        # ties: the earlier document
        for other in _falling(scores) if room else ():
            unused[other] = False
            if len(rests[other].ids) > room:
                sequence.append(rests[other].cut(room))
                seed, room = int(other), 0
            else:
                sequence.append(rests[other])
                room -= len(rests[other].ids)
            if not room:
                break
        if room:
            return full, sequence
        full.append(sequence)


def _rows(sequences: list[tuple[int, list[Rest]]], key_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in names]
    for number, pieces in sequences:
        offset = 0
        for p in pieces:
            for column, value in zip(columns, (p.key, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, number, offset)):
                column.append(value)
            offset += len(p.ids)
    return pa.RecordBatch.from_arrays([pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names)


def _powers(pieces: list[Rest]) -> list[list[Rest]]:
    """Pieces over sequences whose lengths are powers of two, the longest first."""
    out, total = [], sum(len(p.ids) for p in pieces)
    pieces = list(pieces)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        sequence = []
        while room:
            p = pieces[0]
            if len(p.ids) > room:
                sequence.append(p.cut(room))
                room = 0
            else:
                sequence.append(pieces.pop(0))
                room -= len(p.ids)
        out.append(sequence)
    return out


def _numbers(kind: int) -> Callable[[], int]:
    """Sequence ids of a task: unique over tasks, and over the two stages by ``kind``. A task that runs again gives the same."""
    state = [(TaskContext.get().partitionId() << 33) | kind]

    def take() -> int:
        state[0] += 2
        return state[0] - 2

    return take


def packed(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The pieces of all documents in sequences of at most ``window`` tokens: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts hold the end token only. Rows that repeat, null keys and equal texts are packed one by one. A document of a window or more
    gives whole windows, then its rest is packed like any other. Other columns are not read; an empty table gives no rows.
    Sequences are full, but for one run of power-of-two lengths a task. ``window`` must be a power of two itself.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    kind = width(path)
    tokens = written(tokenised(docs, path, key, text, end), "tokens")
    spark = tokens.sparkSession
    size = tokens.agg(F.count("*").alias("n"), F.sum("n").alias("total")).first()
    weights = Weights(document_frequencies(tokens, kind), size["n"], (size["total"] or 0) / max(size["n"], 1))
    item = np.dtype(kind).itemsize
    fields = [T.StructField(key, tokens.schema["key"].dataType), *[T.StructField(n, t) for n, t in _PIECES]]
    names, out = [f.name for f in fields], T.StructType(fields)
    rest_schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("spot", T.LongType()), tokens.schema["key"], tokens.schema["n"],
                                T.StructField("telling", T.LongType()), T.StructField("crc", T.LongType()), tokens.schema["ids"]])

    def windows(batches):
        take = _numbers(1)
        for batch in batches:
            made = []
            for k, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(raw, kind)
                made += [(take(), [Rest(k, at, ids[at:at + window], n)]) for at in range(0, n - window + 1, window)]
            yield _rows(made, batch.column(0).type, names)

    def telling(ids: list[np.ndarray]) -> np.ndarray:
        """The token of the largest weight of each document, of equal ones the largest; -1 for a document without any."""
        doc, term, times = _distinct([_terms(x) for x in ids])
        out = np.full(len(ids), -1, np.int64)
        if len(doc):
            weight = weights(term, times, np.array([len(x) for x in ids], np.float64)[doc])
            begin = np.flatnonzero(np.diff(doc, prepend=-1))
            best = np.repeat(np.maximum.reduceat(weight, begin), np.diff(np.append(begin, len(doc))))
            out[doc[begin]] = np.maximum.reduceat(np.where(weight == best, term, -1), begin)
        return out

    def rests(bounds: np.ndarray):
        def run(batches):
            at = TaskContext.get().partitionId() << 40
            for batch in batches:
                totals = batch.column(1).to_pylist()
                found = [np.frombuffer(raw, kind)[n // window * window:] for n, raw in zip(totals, batch.column(2).to_pylist())]
                raw, token = [ids.tobytes() for ids in found], telling(found)
                # the place of a row spreads the documents of one token evenly, copies and repeated rows too
                spot = (token << 32) + [zlib.crc32(struct.pack("<q", at + i)) for i in range(len(found))]
                at += len(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.searchsorted(bounds, spot), pa.int32()), pa.array(spot), batch.column(0), batch.column(1), pa.array(token),
                    pa.array(map(zlib.crc32, raw), pa.int64()), pa.array(raw, pa.binary())], rest_schema.names)
        return run

    def pack(batches):
        take = _numbers(0)
        held: list[Rest] = []
        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for k, n, _, _, raw in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(raw, kind)
                held.append(Rest(k, n - len(ids), ids, n))
                if len(held) >= block_docs:
                    full, held = fill(held, weights, window)
                    yield _rows([(take(), s) for s in full], key_type, names)
        if held:
            full, held = fill(held, weights, window)
            yield _rows([(take(), s) for s in [*full, *_powers(held)]], key_type, names)

    left = tokens.where(F.col("n") % window > 0).select("key", "n", "ids")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, -(-(size["total"] or 0) * item // TASK_BYTES)))
    # ranges of (telling, place) for the tasks; a sample bounds them, so their balance depends on it and no row does
    probe = left.sample(min(1.0, SAMPLE * tasks / max(size["n"], 1)), seed=1).mapInArrow(rests(np.zeros(0, np.int64)), rest_schema)
    bounds = probe.agg(F.percentile_approx("spot", [i / tasks for i in range(1, tasks)] or [0.5], 20 * tasks)).first()[0] or []
    dealt = left.mapInArrow(rests(np.array(sorted(bounds), np.int64)), rest_schema).repartitionById(tasks, "part")
    near = dealt.sortWithinPartitions("telling", "crc", "key", "n").drop("part", "spot")
    whole = tokens.where(F.col("n") >= window).select("key", "n", "ids").mapInArrow(windows, out)
    return written(near.mapInArrow(pack, out).unionByName(whole), "pieces")


def default_path() -> str:
    """The file the query uses; only its path is known here, the file is not part of the repository."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
