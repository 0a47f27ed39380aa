"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within ``radius`` 3 meet at a variant half way: two of them at distance 3 have different bit parity, so there
is a value of even parity one bit from the odd one and two bits from the even one. Distance 1 meets at the even one,
distance 2 of odd ones one bit from each, distance 2 of even ones at either. So it is enough that an odd fingerprint emits
its variants at distance 1, and an even one itself and its variants at distance 2 (its *far* variants); every variant
has even parity. Moreover, any fingerprint that holds a variant as itself or at distance 1 (a *centre* of it) is within
the radius of all others that hold it, and if a variant has no centre, its holders at distance 2 from each other meet at
one of themselves. So the fingerprints of a variant need only be tied to one centre: a star instead of all pairs, with
the same components. Each tie is verified by its distance.

Variants are shuffled by slice: a random linear code over GF(2) of the variant. As the code of ``f xor mask`` is
``code(f) xor code(mask)``, a fingerprint travels once to each slice that any of its variants falls in, and the task of the
slice makes just those variants. A slice holds its centres sorted and streams the far variants past them in blocks, so
memory is bounded by fingerprints / slices; the number of slices grows with the number of fingerprints.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import columns, free_name, map_texts, quoted, written

SHINGLE, RADIUS = 3, 3
#: Fewest slices; most centres and most fingerprints of a slice, whatever the parities; fingerprints a task sends on at once, copies included.
SLICES, CENTRES, HOLDERS, SENT = 64, 8_000_000, 32_000_000, 4_000_000
SINGLE = np.uint64(1) << np.arange(64, dtype=np.uint64)
DOUBLE = np.array([SINGLE[i] | SINGLE[j] for i, j in itertools.combinations(range(64), 2)], dtype=np.uint64)
SELF = np.zeros(1, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: a bit is 1 if it is set in over half the XXH64 hashes (seed 42) of the word shingles, repeats included.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer words than a shingle hash as a whole; none give 0.
    """
    words = [] if text is None else text.encode().lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_digest, b" ".join
    size = min(shingle, len(words))
    count = len(words) - size + 1
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, count, 1 << 16):  # long texts in blocks
        block = words[at:at + (1 << 16) + size - 1]
        hashes = b"".join([digest(x, 42) for x in map(join, zip(*[block[i:] for i in range(size)]))])
        bits += np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > count).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(docs: DataFrame, name: str, text: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns (all by default) and the fingerprint as a signed 64-bit integer. A null text has no words."""

    def make():
        return lambda texts: [[signed(fingerprint(t, shingle)) for t in texts]]

    return map_texts(docs, make, [(name, "bigint")], docs.columns if keep is None else keep, [text])


def slice_codes(slices: int) -> np.ndarray:
    """A fixed random code of log2(slices) bits for each of the 64 bit positions."""
    return np.random.default_rng(64).integers(0, slices, 64, dtype=np.uint32)


def codes_of(values: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The linear code of each value: the codes of its set bits, xor-ed."""
    out = np.zeros(len(values), dtype=np.uint32)
    for i in range(64):
        out ^= np.where(values & SINGLE[i], codes[i], np.uint32(0))
    return out


def odd_parity(values: np.ndarray) -> np.ndarray:
    v = values.copy()
    for s in (32, 16, 8, 4, 2, 1):
        v ^= v >> np.uint64(s)
    return (v & np.uint64(1)).astype(bool)


def to_slices(fps: np.ndarray, slices: int) -> dict[int, np.ndarray]:
    """For each slice the fingerprints that have a variant in it."""
    codes = slice_codes(slices)
    own, odd = codes_of(fps, codes), odd_parity(fps)
    single = np.unique(codes_of(SINGLE, codes))
    even = np.unique(np.concatenate([codes_of(DOUBLE, codes), np.zeros(1, np.uint32)]))
    out: dict[int, list] = {}
    for members, targets in ((odd, single), (~odd, even)):
        f, c = fps[members], own[members]
        for t in targets:
            goes = c ^ t
            order = np.argsort(goes, kind="stable")
            found, starts = np.unique(goes[order], return_index=True)
            for s, part in zip(found.tolist(), np.split(f[order], starts[1:])):
                out.setdefault(s, []).append(part)
    return {s: np.concatenate(parts) for s, parts in out.items()}


def variants_in(fps: np.ndarray, masks: np.ndarray, which: int, codes: np.ndarray):
    """(fingerprints, variants) whose variants lie in the slice, mask by mask."""
    own, mask_codes = codes_of(fps, codes), codes_of(masks, codes)
    order = np.argsort(own, kind="stable")
    own, fps = own[order], fps[order]
    starts = dict(zip(*(x.tolist() for x in np.unique(own, return_index=True))))
    ends = dict(zip(own[np.r_[own[1:] != own[:-1], True]].tolist(), (np.flatnonzero(np.r_[own[1:] != own[:-1], True]) + 1).tolist())) if len(own) else {}
    for mask, code in zip(masks, mask_codes.tolist()):
        c = which ^ code
        if c in starts:
            f = fps[starts[c]:ends[c]]
            yield f, f ^ mask


def ties_of_slice(fps: np.ndarray, which: int, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified ties (fingerprint, centre) over the variants of one slice."""
    fps, codes = np.unique(fps), slice_codes(slices)
    odd = odd_parity(fps)
    centres = [*variants_in(fps[~odd], SELF, which, codes), *variants_in(fps[odd], SINGLE, which, codes)]
    if not centres:
        return SELF[:0], SELF[:0]
    holder, value = (np.concatenate(x) for x in zip(*centres))
    order = np.lexsort((holder, value))
    holder, value = holder[order], value[order]
    first = np.r_[True, value[1:] != value[:-1]]
    centre = holder[np.maximum.accumulate(np.where(first, np.arange(len(value)), 0))]
    left, right = [holder[~first]], [centre[~first]]
    keys, heads = value[first], holder[first]
    # a cheap test of the low bits first: most far variants meet no centre
    seen = np.zeros(1 << 22, dtype=bool)
    low = np.uint64((1 << 22) - 1)
    mixed = lambda v: (v ^ (v >> np.uint64(22)) ^ (v >> np.uint64(43))) & low
    seen[mixed(keys)] = True
    for f, v in variants_in(fps[~odd], DOUBLE, which, codes):
        near = np.flatnonzero(seen[mixed(v)])
        if len(near):
            at = np.minimum(np.searchsorted(keys, v[near]), len(keys) - 1)
            hit = keys[at] == v[near]
            left.append(f[near[hit]])
            right.append(heads[at[hit]])
    a, b = np.concatenate(left), np.concatenate(right)
    near = (np.bitwise_count(a ^ b) <= RADIUS) & (a != b)
    return a[near], b[near]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as the ties, as one tie of each member to the smallest one."""
    if not len(a):
        return a, b
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[:len(a)], index[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    member = root != np.arange(len(nodes))
    return nodes[member], nodes[root[member]]


def slices_for(count: int) -> int:
    """A power of two such that no slice holds too much: centres fall evenly, a fingerprint goes to 2,017 slices at most."""
    slices = SLICES
    while count * (1 + len(SINGLE)) > CENTRES * slices or count * min(1.0, (1 + len(DOUBLE)) / slices) > HOLDERS:
        slices *= 2
    return slices


def ties(fps: DataFrame, name: str = "fp") -> DataFrame:
    """Ties (a, b) between distinct fingerprints that connect all those within the radius."""
    slices = slices_for(fps.count())
    at_once = SENT // min(slices, 1 + len(DOUBLE))

    def scatter(batches):
        def sent():
            # a row for each slice, its fingerprints packed
            parts = to_slices(np.concatenate(held), slices)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([p.tobytes() for p in parts.values()], pa.binary())], ["slice", "fps"])

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            if sum(map(len, held)) >= at_once:
                yield sent()
        if held:
            yield sent()

    def meet(table):
        parts = table.column("fps")
        fp = np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint64) for x in parts])
        a, b = forest(*ties_of_slice(fp, table.column("slice")[0].as_py(), slices))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = fps.select(F.col(name)).mapInArrow(scatter, "slice int, fps binary")
    return sent.groupBy("slice").applyInArrow(meet, "a bigint, b bigint").distinct()


def roots(edges: DataFrame, label: str = "roots") -> DataFrame:
    """(node, root): the smallest connected node of every node with an edge; edges are (a, b).

    Alternating large-star and small-star steps, each a grouped minimum and a join, written out each time. A star's
    edges are never gathered in a list.
    """
    current = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    mark = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, label)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        current = written(small.select("e.u", "e.v").where("u <> v").distinct(), label)
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == tuple(seen):
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(seen)


def components(rows: DataFrame, fp: str, key: str, out: str, root: str | None = None) -> DataFrame:
    """All columns of ``rows`` plus ``out``: the smallest ``key`` of the component of the row's fingerprint.

    With ``root`` a column of that name gives the component's smallest fingerprint, which names it without keys, too.

    Null keys take part but are never a smallest key (null if a component has no other). Equal fingerprints, repeated
    rows and repeated keys meet in one grouped row first, so a third of all rows with one text is one fingerprint here.
    """
    # aggregate and join on own names, whatever the rows' columns are called
    grouped = written(rows.groupBy(F.col(fp).alias("_f")).agg(F.min(F.col(quoted(key))).alias("_k")), "fingerprints")
    linked = roots(ties(grouped, "_f"))
    own = grouped.join(linked.withColumnsRenamed({"node": "_f", "root": "_r"}), "_f", "left").withColumn("_r", F.coalesce("_r", "_f"))
    own = own.select("_f", "_r", "_k")
    least = own.groupBy("_r").agg(F.min("_k").alias("_c"))
    table = own.join(least, "_r").select(F.col("_f").alias(f := free_name(rows, "_f")), F.col("_c").alias(c := free_name(rows, "_c")), F.col("_r").alias(r := free_name(rows, "_r")))
    joined = rows.join(table, F.col(fp) == F.col(f))
    return joined.select(*columns(rows.columns), F.col(c).alias(out), *([F.col(r).alias(root)] if root else []))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id) of every row of ``docs``."""
    narrow = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    rows = written(with_fingerprints(narrow, "fp", keep=["key"]), "fps")
    found = components(rows, "fp", "key", "component_id")
    return found.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with its own columns: the one of the smallest key, any one among equal keys.

    A null key comes after all others; a component without any key keeps one document, too.
    """
    fp, row, group, root, best = (free_name(docs, x) for x in ("_fp", "_row", "_group", "_root", "_best"))
    marked = written(with_fingerprints(docs, fp, text).withColumn(row, F.monotonically_increasing_id()), "docs")
    narrow = marked.select(F.col(quoted(key)), fp, row)
    found = components(narrow, fp, key, group, root)
    first = found.groupBy(root).agg(F.min_by(F.col(row), F.struct(F.col(quoted(key)).isNull(), F.col(quoted(key)), F.col(row))).alias(best))
    return marked.join(first.select(best), F.col(row) == F.col(best), "left_semi").select(*columns(docs.columns))
