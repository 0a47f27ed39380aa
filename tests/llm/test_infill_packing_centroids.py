"""Fill-in-middle, packing and exact k-means against brute force, and on awkward and empty tables."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import awkward, sorted_rows
from tidemark.llm import centroids, infill, packing
from tidemark.llm.shared import read

SF = "/root/testdata/sf0.001"


# ---- fill-in-middle

def plain_infill(key, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (key, n, "plain", None, None, text, text)
    if h[3] % 100 < 20:
        return (key, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}", text)
    return (key, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}", text)


def test_infill_brute_force(llm_spark):
    rng = random.Random(5)
    alphabet = ["a", "Zb", " ", "\n", "\0", "é", "日", "\U0001f600", "<", "P", ">", "<S", "\x7f", "ÿ", "1"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))) for i in range(400)]
    rows += [(900, "x<P>y"), (901, None), (None, "null key"), (902, "a" * 3_000_000), (903, "é, " * 700_000), (902, "twice"), (902, "twice")]
    got = infill.filled_in_middle(llm_spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted_rows(got) == sorted((plain_infill(*r) for r in rows), key=repr)


def test_infill_awkward(llm_spark):
    docs = awkward(llm_spark).withColumn("output", F.lit(1)).withColumn("_key", F.lit(2))
    got = infill.filled_in_middle(docs)
    assert sorted_rows(got) == sorted((plain_infill(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert infill.filled_in_middle(docs.limit(0)).collect() == []


def test_restored_reads_output_only():
    import pyarrow as pa

    out = pa.array(["<P>a<S<S>c><M><Mb", "<S>c<P><P<M>", "as it is"])
    assert infill.restored(out, pa.array(["psm", "spm", "plain"])).to_pylist() == ["a<S<Mbc>", "<Pc", "as it is"]


# ---- packing

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_path())


def test_encoder_equals_library(library):
    encode = packing.Encoder(packing.default_path())
    assert encode.fast
    texts = [f"a{chr(c)}1 {chr(c)}{chr(c)}b  {chr(c)} \n{chr(c)}'s" for c in [*range(0x3000), *range(0xA000, 0xD800), *range(0xE000, 0x30000)]]
    texts += ["x <|endoftext|> y", " " * 100_000, "a" * 100_000, "\n" * 5000, "a" + " " * 255 + "b", "", " \t" * 128 + "c"]
    rng = random.Random(2)
    letters = [chr(c) for c in (*range(128), *range(128), *range(0x250), *range(0x2010, 0x2028))]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(3000)]
    assert encode(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def check_packed(rows, docs, library, window=2048):
    """Every id in one piece, sequences gapless and full or of a power of two. Gives the sequences."""
    want = defaultdict(list)
    for key, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want[key].append(ids)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    for key, texts in want.items():
        # several documents of one key: their pieces are told apart by crc
        left = [[ids, 0] for ids in texts]
        for r in sorted(by_doc[key], key=lambda r: r["start"]):
            fits = [d for d in left if d[1] == r["start"] and len(d[0]) == r["doc_tokens"]
                    and zlib.crc32(struct.pack(f"<{r['length']}I", *d[0][d[1]:d[1] + r["length"]])) == r["ids_crc32"]]
            assert fits and r["length"] > 0
            fits[0][1] += r["length"]
        assert all(len(ids) == at for ids, at in left)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in pieces]).tolist()
        assert [r["offset"] for r in pieces] == [0, *ends[:-1]]
        assert ends[-1] <= window and ends[-1] & (ends[-1] - 1) == 0
    return by_sequence


def test_packing_given_documents(llm_spark, library):
    docs = read(llm_spark, SF, "documents")
    rows = packing.packed(docs, packing.default_path()).collect()
    check_packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], library)


def test_packing_awkward(llm_spark, library):
    docs = awkward(llm_spark).withColumn("n", F.lit(1)).withColumn("ids", F.lit("x"))
    rows = packing.packed(docs, packing.default_path(), block_docs=3).collect()
    check_packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], library)
    assert packing.packed(docs.limit(0), packing.default_path()).collect() == []
    with pytest.raises(ValueError):
        packing.packed(docs, packing.default_path(), window=1000)


def test_packing_many_copies(llm_spark, library):
    """One text and one key hold most rows; shards stay bounded and nothing is lost."""
    docs = [(7, "the same words again and again " * 20)] * 300 + [(None, "no key")] * 40 + [(i, f"text {i}") for i in range(50)]
    rows = packing.packed(llm_spark.createDataFrame(docs, "doc_id bigint, text string"), packing.default_path(), block_docs=64).collect()
    check_packed(rows, docs, library)


def plain_scores(ids, seed, df, n_docs, mean):
    out = []
    for doc in ids:
        words, total = doc[:-1].tolist(), 0.0
        for t in set(ids[seed][:-1].tolist()):
            tf = words.count(t)
            idf = math.log(1 + (n_docs - df[t] + 0.5) / (df[t] + 0.5))
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean)) if tf else 0.0
        out.append(total)
    return out


def test_scores_and_greedy_fill_brute_force():
    rng = np.random.default_rng(4)
    ids = [np.append(rng.zipf(1.5, rng.integers(0, 30)) % 50 + 2, 1).astype("<u2") for _ in range(60)]
    df = np.bincount(np.concatenate([np.unique(x[:-1]) for x in ids]), minlength=60)
    mean = sum(len(x) for x in ids) / len(ids)
    weights = packing.Weights(df, len(ids), mean)
    index = packing.Shard(ids, weights)
    for seed in range(60):
        assert np.allclose(index.scores(seed), plain_scores(ids, seed, df, 60, mean))
    full, left = packing.fill([packing.Rest(i, 0, x, len(x)) for i, x in enumerate(ids)], weights, 64)
    # the same rule, one document at a time
    state, unused, want, seed = [x.tolist() for x in ids], list(range(60)), [], None
    while unused or seed is not None:
        seed = unused.pop(0) if seed is None else seed
        sequence, room, score = [(seed, len(state[seed]))], 64 - len(state[seed]), index.scores(seed)
        seed = None
        for other in sorted(unused, key=lambda o: (-score[o], o)):
            if not room:
                break
            unused.remove(other)
            take = min(room, len(state[other]))
            sequence.append((other, take))
            if take < len(state[other]):
                seed = other
            state[other] = state[other][take:]
            room -= take
        want.append(sequence)
    got = [[(p.key, len(p.ids)) for p in s] for s in [*full, *([left] if left else [])]]
    assert got == want


def test_neighbours_share_sequences(llm_spark, library):
    """Documents of one subject meet in a sequence more often than by chance."""
    rng = random.Random(8)
    subjects = [[f"{chr(97 + s)}{w}word" for w in range(30)] for s in range(20)]
    docs = [(i, " ".join(rng.choice(subjects[i % 20]) for _ in range(60))) for i in range(800)]
    rows = packing.packed(llm_spark.createDataFrame(docs, "doc_id bigint, text string"), packing.default_path()).collect()
    together = [len({p["doc_id"] % 20 for p in s}) / len({p["doc_id"] for p in s}) for s in check_packed(rows, docs, library).values() if len(s) > 3]
    assert sum(together) / len(together) < 0.5  # by chance about 0.9


# ---- exact k-means

def plain_clusters(rows, k=40, rounds=5, dims=64, scale=256):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    keyed = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), struct.pack(f"<{dims}i", *v), v) for i, v in kept if i is not None)
    c = [v for _, _, v in keyed[:k]]
    if not c:
        return []

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in enumerate(c))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        c = [[sum(col) // len(members[j]) for col in zip(*members[j])] if members[j] else w for j, w in enumerate(c)]
    found = [(i, *reversed(near(v))) for i, v in kept]
    per = defaultdict(int)
    for _, j, d in found:
        per[j] += d
    return [(i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in found]


@pytest.mark.parametrize("grid", [0.0, 0.5])
def test_centroids_brute_force(llm_spark, grid):
    """Coarse grids make ties between centroids and between sums."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 8))
    x = np.round(x / grid) * grid if grid else x
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)] + [(5, [0.0] * 8), (5, [0.0] * 8), (None, [1.0] * 8)]
    rows += [(900, None), (901, [1.0] * 7), (902, [1.0] * 7 + [None]), (903, [float("nan")] + [1.0] * 7), (904, [float("inf")] * 8), (905, []), (906, [-0.001] * 8)]
    df = llm_spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("cluster", F.lit("x"))
    got = centroids.clustered(df, dims=8, k=12, rounds=4)
    assert sorted_rows(got) == sorted(plain_clusters(rows, k=12, rounds=4, dims=8), key=repr)


def test_centroids_few_and_none(llm_spark):
    rows = [(1, [0.5] * 64), (2, [0.25] * 64)]
    df = llm_spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert sorted_rows(centroids.clustered(df)) == sorted(plain_clusters(rows), key=repr)
    assert centroids.clustered(df.limit(0)).collect() == []
    assert centroids.clustered(df.select(F.lit(None).cast("bigint").alias("vec_id"), "embedding")).collect() == []


@pytest.mark.parametrize("high", [2, 40, centroids.LARGEST])
def test_search_is_exact_and_saves_distances(high):
    rng = np.random.default_rng(3)
    saved = 0
    for _ in range(30):
        k = int(rng.integers(1, 41))
        c, x = rng.integers(-high, high + 1, (k, 64)), rng.integers(-high, high + 1, (200, 64))
        shift = rng.integers(-high, high + 1, 200)
        x = np.clip(x // 8 + shift[:, None], -high, high)
        who, best, worked = centroids.Search(c).nearest(x)
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=-1)
        assert (best == d.min(axis=1)).all() and (who == d.argmin(axis=1)).all()
        saved += k * 200 - worked
    assert saved > 0


def test_components_too_large(llm_spark):
    with pytest.raises(ValueError):
        centroids.whole(np.array([1e30]), 256)
