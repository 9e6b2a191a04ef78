"""Fill-in-middle: texts cut at line ends into prefix, middle and suffix, and put together anew.

Units are lines with their line end. A batch of texts is one pipeline of Arrow kernels: the
texts are split into lists of pieces, the lists flattened with the number of the text that each
piece comes from, every piece gets its ordinal, the pieces of a role are filtered out and
gathered into lists again, and ``binary_join`` makes one string of each list. Cuts come from a
digest of seed and id, so that a text is cut the same way in any partition and any run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import keyed

#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Bytes of text that the kernels work on at a time; a longer text is worked on alone.
SLICE_BYTES = 8 << 20


def draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the digest of ``seed:id``; a NULL id is written as nothing."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def _mod(a: pa.Array, b: pa.Array | int) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))  # whole numbers, not negative


def _gather(pieces: pa.Array, mask: pa.Array, sizes: pa.Array) -> pa.Array:
    """The pieces under ``mask`` joined into one string for each text; ``sizes`` is how many it has."""
    ends = pc.cumulative_sum(sizes)
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, pc.filter(pieces, mask)), pa.scalar("", pa.large_string()))


def _cut(text: pa.Array, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Units, prefix, middle and suffix of every text."""
    text = text.cast(pa.large_string())
    lists = pc.split_pattern(text, "\n").cast(pa.large_list(pa.large_string()))
    pieces, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    lengths = pc.list_value_length(lists)
    first = pc.subtract(pc.cumulative_sum(lengths), lengths)
    ordinal = pc.subtract(pa.array(range(len(pieces)), pa.int64()), pc.take(first, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(lengths, parent), 1))
    end = pc.if_else(last, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    # what follows the last line end is a unit only if there is something
    rest_empty = pc.or_(pc.equal(text, ""), pc.ends_with(text, "\n"))
    n = pc.subtract(lengths, rest_empty.cast(pa.int64()))
    real = pc.less(ordinal, pc.take(n, parent))
    units = pc.filter(pc.binary_join_element_wise(pieces, end, pa.scalar("", pa.large_string())), real)
    ordinal, parent = pc.filter(ordinal, real), pc.filter(parent, real)

    places = pc.add(n, 1)
    one, two = _mod(h1, places), _mod(h2, places)
    a, b = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    of_a, of_b = pc.take(a, parent), pc.take(b, parent)
    prefix = _gather(units, pc.less(ordinal, of_a), a)
    middle = _gather(units, pc.and_(pc.greater_equal(ordinal, of_a), pc.less(ordinal, of_b)), pc.subtract(b, a))
    suffix = _gather(units, pc.greater_equal(ordinal, of_b), pc.subtract(n, b))
    return n, prefix, middle, suffix


def _transform(batch: pa.RecordBatch, rate: int, spm: int, marks: Sequence[str]) -> pa.RecordBatch:
    text = batch.column("text").cast(pa.large_string())
    h1, h2, h3, h4 = (batch.column(f"h{k}") for k in (1, 2, 3, 4))
    n, prefix, middle, suffix = _cut(text, h1, h2)
    plain = pc.or_(pc.equal(text, ""), pc.greater_equal(_mod(h3, 100), rate))
    for m in marks:
        plain = pc.or_(plain, pc.match_substring(text, m))
    swapped = pc.less(_mod(h4, 100), spm)
    form = pc.if_else(plain, "plain", pc.if_else(swapped, "spm", "psm"))
    p, s, m, none = (pa.scalar(x, pa.large_string()) for x in (*marks, ""))
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    output = pc.if_else(plain, text, pc.if_else(swapped, spm_text, psm))

    def chars(part: pa.Array) -> pa.Array:
        return pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(part).cast(pa.int64()))

    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("text_key"), n, form, chars(prefix), chars(middle), output.cast(pa.string())],
        names=["doc_id", "text_key", "n", "form", "prefix_chars", "middle_chars", "output"])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with ``SLICE_BYTES`` of text at most, or a single row."""
    start, held = 0, 0
    for k, size in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
        if k > start and held + size > SLICE_BYTES:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, marks: Sequence[str] = MARKS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n, form, prefix_chars, middle_chars, output for every row of ``docs``.

    ``n`` is the number of lines. ``rate`` percent of the texts are cut, ``spm`` percent of
    those have the suffix first. Form ``plain`` returns the text: it is empty, holds a mark
    already, or lies outside of the rate. ``psm`` is prefix, suffix, middle, ``spm`` suffix,
    prefix, middle, each after its mark of ``marks`` (prefix, suffix, middle). A NULL text is
    the empty one; a NULL id is cut by the digest of the seed alone; repeated rows get equal
    results; equal texts with different ids are cut apart; an empty table gives an empty
    result. One pass without a shuffle; a very long text is worked on alone and whole.
    Marks must be different, begin with ``<``, end with ``>`` and hold neither in between,
    so that no text next to a mark can form another one.
    """
    if len(set(marks)) != 3 or not all(re.fullmatch(r"<[^<>]*>", m) for m in marks):
        raise ValueError("three different marks of the form <...> are needed")
    rows = keyed(docs, id_col, text_col)
    rows = rows.select("doc_id", "text_key", "text", *[h.alias(f"h{k + 1}") for k, h in enumerate(draws("doc_id", seed))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b):
                yield _transform(part, rate, spm, marks)

    return rows.mapInArrow(run, "doc_id long, text_key long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form", marks: Sequence[str] = MARKS) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form."""
    parts = F.split(F.col(output), "|".join(re.escape(m) for m in marks), -1)
    part = lambda k: F.element_at(parts, k)
    return F.when(F.col(form) == "psm", F.concat(part(2), part(4), part(3))).when(
        F.col(form) == "spm", F.concat(part(3), part(4), part(2))).otherwise(F.col(output))


def fim_digest(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    found = fill_in_middle(docs, seed, rate, spm)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))


SQL = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || doc_id) as h from documents),
u as (select doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as u,
             cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
             cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from d),
c as (select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b from u),
p as (select doc_id, t, n, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle,
             array_to_string(u[b + 1:], '') as suffix,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain'
                  when h4 % 100 < 50 then 'spm' else 'psm' end as form from c)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from p
"""
