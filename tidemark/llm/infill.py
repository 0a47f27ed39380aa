"""Fill-in-middle transformation as one pyarrow.compute pipeline over each batch.

Units are cut by marking their ends with a byte that UTF-8 never holds, so the texts travel as binary. Per batch: texts to
lists of units, lists flattened with parent indices, ordinals from the offsets, units filtered by role (prefix, middle,
suffix), lists rebuilt and joined back to pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import quoted

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents: those that stay plain from here on, and those of the others with the suffix first.
PLAIN_FROM, SUFFIX_FIRST = 90, 20
#: Text bytes worked on at once; a longer text is worked on alone.
BLOCK_BYTES = 4 << 20

_END = b"\xff"
# bytes: a run of letters, any other ASCII byte, or one character of several bytes
_UNIT = rb"([A-Za-z]+|[\x00-\x40\x5B-\x60\x7B-\x7F]|[\xC2-\xF4][\x80-\xBF]+)"


def _remainder(values: pa.Array, by: pa.Array | int) -> pa.Array:
    return pc.subtract(values, pc.multiply(pc.divide(values, by), by))


def _pieces(texts: pa.Array, first: pa.Array, second: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """Units of each text, and its prefix, middle and suffix as binary: cut after first % (n + 1) and second % (n + 1) units."""
    marked = pc.replace_substring_regex(texts, pattern=_UNIT, replacement=rb"\1" + _END)
    lists = pc.split_pattern(marked, pattern=_END)  # one empty piece behind the last mark
    parents, units = pc.list_parent_indices(lists), pc.list_flatten(lists)
    lengths = pc.cast(pc.list_value_length(lists), pa.int64())
    n = pc.subtract(lengths, 1)
    begins = pc.subtract(pc.cumulative_sum(lengths), lengths)
    ordinals = pc.subtract(pa.array(np.arange(len(units))), pc.take(begins, parents))
    a, b = _remainder(first, pc.add(n, 1)), _remainder(second, pc.add(n, 1))
    low, high = pc.take(pc.min_element_wise(a, b), parents), pc.take(pc.max_element_wise(a, b), parents)
    before, behind = pc.less(ordinals, low), pc.greater_equal(ordinals, high)
    roles = [before, pc.and_not(pc.invert(before), behind), pc.and_(behind, pc.less(ordinals, pc.take(n, parents)))]
    joined = []
    for role in roles:
        owners = np.asarray(pc.filter(parents, role))
        offsets = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(texts)))))
        rebuilt = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pc.filter(units, role))
        joined.append(pc.binary_join(rebuilt, b""))
    return n, joined


def _text(binary: pa.Array) -> pa.Array:
    return binary.cast(pa.string())


def _after(lists: pa.Array, i: int) -> pa.Array:
    return pc.list_element(lists, i)


def restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts rebuilt from outputs and forms alone. A marker's characters cannot overlap a text that holds no marker, so the first one found is it."""
    texts = outputs
    for form, (one, two, three), order in (("psm", (PREFIX, SUFFIX, MIDDLE), (0, 2, 1)), ("spm", (SUFFIX, PREFIX, MIDDLE), (1, 2, 0))):
        mask = pc.equal(forms, form)
        some = pc.filter(outputs, mask)
        if not len(some):
            continue
        head = pc.split_pattern(pc.utf8_slice_codeunits(some, len(one)), pattern=two, max_splits=1)
        tail = pc.split_pattern(_after(head, 1), pattern=three, max_splits=1)
        parts = [_after(head, 0), _after(tail, 0), _after(tail, 1)]
        texts = pc.replace_with_mask(texts, mask, pc.binary_join_element_wise(*[parts[i] for i in order], ""))
    return texts


def _transformed(texts: pa.Array, h: list[pa.Array], plain_from: int, suffix_first: int) -> list[pa.Array]:
    raw = pc.fill_null(texts, "")
    n, (prefix, middle, suffix) = _pieces(raw.cast(pa.binary()), h[0], h[1])
    prefix, middle, suffix = _text(prefix), _text(middle), _text(suffix)
    marked = pc.or_(pc.or_(pc.match_substring(raw, PREFIX), pc.match_substring(raw, SUFFIX)), pc.match_substring(raw, MIDDLE))
    plain = pc.or_(pc.or_(pc.equal(n, 0), marked), pc.greater_equal(_remainder(h[2], 100), plain_from))
    form = pc.if_else(plain, "plain", pc.if_else(pc.less(_remainder(h[3], 100), suffix_first), "spm", "psm"))
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    output = pc.if_else(plain, raw, pc.if_else(pc.equal(form, "spm"), spm, psm))
    none = pa.scalar(None, pa.int64())
    lengths = [pc.if_else(plain, none, pc.cast(pc.utf8_length(p), pa.int64())) for p in (prefix, middle)]
    return [n, form, *lengths, output, restored(output, form)]


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BLOCK_BYTES`` of text each; a longer text is a slice of its own."""
    start, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if held and held + size > BLOCK_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start)


def filled_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", plain_from: int = PLAIN_FROM, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """key, n (units), form (plain, psm, spm), prefix_chars, middle_chars, output and restored of each document.

    Cuts and form follow from the key alone: the first four 8-digit groups of the sha256 of ``1:`` and the key. A null key counts as
    empty text there, so all such rows are cut by one hash; a null text is empty, and its form is plain. Texts that hold a marker stay plain.
    Rows that repeat give repeated results, other columns are not read, and a text is worked on whole, whatever its length (up to the 2 GB of a cell).
    """
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(quoted(key)).cast("string"), F.lit(""))), 256)
    group = lambda i: F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"_h{i + 1}")
    src = docs.select(F.col(quoted(key)).alias("_key"), F.col(quoted(text)).alias("_text"), digest.alias("_digest"))
    src = src.select("_key", "_text", *[group(i) for i in range(4)])
    fields = [(key, src.schema["_key"].dataType), ("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
              ("middle_chars", T.LongType()), ("output", T.StringType()), ("restored", T.StringType())]

    def run(batches):
        for batch in batches:
            for part in _blocks(batch, 1):
                if part.num_rows:
                    made = _transformed(part.column(1), [part.column(i) for i in range(2, 6)], plain_from, suffix_first)
                    yield pa.RecordBatch.from_arrays([part.column(0), *made], [name for name, _ in fields])

    return src.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields]))
