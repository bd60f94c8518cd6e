"""Fill-in-middle transformation as a pyarrow.compute pipeline over Arrow batches.

A text is cut into units (a run of A-Z and a-z, or one other code point), and the units into
prefix, middle and suffix at two places drawn from a hash of the document's id. Per batch:
units become list arrays, the lists are flattened with the index of their parent, a unit's
ordinal is its place in the flat array less its parent's offset, the ordinals are filtered by
role, the survivors are rebuilt into lists, and ``binary_join`` puts each piece together. No
step loops over rows, and a batch is worked on in slices of bounded bytes.

Hashes, digests and the way back (:func:`restored`) are DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import free_name, python_workers

# The markers in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# A unit in UTF-8 bytes: letters, one ASCII byte, one longer code point, or a stray byte.
UNIT = rb"[A-Za-z]+|[\x00-\x7F]|[\xC2-\xF4][\x80-\xBF]+|[\x80-\xFF]"
# No UTF-8 text holds this byte, so it can mark where units end.
END = b"\xff"
SLICE_BYTES = 4 * 1024 * 1024


def draws(doc_id: Column) -> list[Column]:
    """The first four 8-digit groups of sha256(``1:`` and the decimal id), as longs. A NULL id
    is hashed as an empty one."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def form_of(text: Column, h3: Column, h4: Column, plain_above: int = 90, spm_below: int = 20) -> Column:
    """``plain``, ``spm`` or ``psm``; texts that are empty or hold a marker stay plain."""
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    return (F.when((text == "") | marked | (h3 % 100 >= plain_above), "plain")
            .when(h4 % 100 < spm_below, "spm").otherwise("psm"))


def units(texts: pa.Array) -> pa.Array:
    """The units of each text as a list array; each list ends with one empty item."""
    marked = pc.replace_substring_regex(texts.cast(pa.large_binary()), pattern=UNIT, replacement=rb"\0" + END)
    return pc.split_pattern(marked, pattern=END)


def pieces(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """(number of units, prefix, middle, suffix) of each text, the pieces as large binary."""
    lists = units(texts)
    n = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), 1)
    # Spark has taken h mod (n + 1) for no batch yet: n is known only here.
    places = pc.add(n, 1)
    drawn = [pc.subtract(h, pc.multiply(pc.divide(h, places), places)) for h in (h1, h2)]
    cut, until = pc.min_element_wise(*drawn), pc.max_element_wise(*drawn)

    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    starts = lists.offsets[:-1].cast(pa.int64())
    starts = pc.subtract(starts, starts[0]) if len(starts) else starts
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(starts, parent))

    def joined(role: pa.Array, size: pa.Array) -> pa.Array:
        offsets = pa.concat_arrays([pa.array([0], pa.int64()), _flat(pc.cumulative_sum(size))])
        rebuilt = pa.LargeListArray.from_arrays(offsets, pc.filter(flat, role))
        return pc.binary_join(rebuilt, pa.scalar(b"", pa.large_binary()))

    before, upto, whole = (pc.less(ordinal, pc.take(x, parent)) for x in (cut, until, n))
    return (n, joined(before, cut), joined(pc.and_not(upto, before), pc.subtract(until, cut)),
            joined(pc.and_not(whole, upto), pc.subtract(n, until)))


def _flat(array: pa.Array | pa.ChunkedArray) -> pa.Array:
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def _text(binary: pa.Array) -> pa.Array:
    return binary.cast(pa.large_string())


def transform_slice(texts: pa.Array, h1: pa.Array, h2: pa.Array, form: pa.Array) -> list[pa.Array]:
    """n, output, prefix_chars and middle_chars of texts that are not NULL."""
    n, prefix, middle, suffix = pieces(texts, h1, h2)
    mark = {m: pa.scalar(m.encode(), pa.large_binary()) for m in (PREFIX, SUFFIX, MIDDLE)}
    none = pa.scalar(b"", pa.large_binary())
    psm = pc.binary_join_element_wise(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle, none)
    spm = pc.binary_join_element_wise(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle, none)
    plain = pc.equal(form, "plain")
    output = pc.if_else(plain, texts.cast(pa.large_binary()), pc.if_else(pc.equal(form, "spm"), spm, psm))
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(_text(x)).cast(pa.int64()))
             for x in (prefix, middle)]
    return [n, _text(output), *chars]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of slices of about ``SLICE_BYTES``; one longer text is a slice by itself."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())).to_numpy()
    start, before = 0, 0
    while start < len(texts):
        stop = max(start + 1, int(ends.searchsorted(before + SLICE_BYTES, "right")))
        yield start, stop - start
        start, before = stop, int(ends[stop - 1])


def transform(docs: DataFrame, plain_above: int = 90, spm_below: int = 20) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with n, form, output, prefix_chars and
    middle_chars added; a name that is taken gets underscores.

    ``plain_above`` and ``spm_below`` are hundredths: that share and more stays plain, and of
    the rest that share has its suffix first. A NULL text is an empty one: no units, plain. The
    lengths are NULL where the form is plain. Rows are independent: repeats give the same result.
    """
    names = list(docs.columns)
    added = []
    for name in ("n", "form", "output", "prefix_chars", "middle_chars"):
        added.append(free_name(names + added, name))
    n, form, output, prefix_chars, middle_chars = added
    helper = [free_name(names + added, x) for x in ("h1_", "h2_", "text_")]
    h1, h2, h3, h4 = draws(F.col("doc_id"))
    text = F.coalesce(F.col("text"), F.lit(""))
    given = docs.select(*[F.col(f"`{c}`") for c in names], h1.alias(helper[0]), h2.alias(helper[1]),
                        text.alias(helper[2]), form_of(text, h3, h4, plain_above, spm_below).alias(form))
    fields = {n: T.LongType(), form: T.StringType(), output: T.StringType(), prefix_chars: T.LongType(),
              middle_chars: T.LongType()}
    schema = T.StructType(list(docs.schema.fields) + [T.StructField(c, t) for c, t in fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(names) + 2)
            for start, rows in _slices(texts):
                part = batch.slice(start, rows)
                *own, a, b, t, kind = part.columns
                count, out, *chars = transform_slice(t, a, b, kind)
                columns = [*own, count, kind, out.cast(t.type), *chars]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    python_workers(docs.sparkSession, rows=2000)
    return given.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of: the markers part it into pieces, which go back in
    order. Texts with a marker of their own are plain, so it is exact."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(F.get(part, 1), F.get(part, 3), F.get(part, 2)))
            .when(form == "spm", F.concat(F.get(part, 2), F.get(part, 3), F.get(part, 1))).otherwise(output))
