"""Line dedup: hashes range-partitioned, sorted by document and position, first occurrences streamed.

Lines never travel: a line is two 64-bit hashes, its document and its position. The rows are
range-partitioned and sorted by (hash, document, position), so that a stream over a partition
sees the first document of a hash before its others. A frequent line fills several
partitions; the stream marks what it says about the first hash of a partition as open, and a
table of one row per partition (hash, first document seen) settles it. The result per
document is a compressed bitmap of the lines that stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import keyed, persist_table, sha256_hex

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2, doc_id, text_key, pos of every line whose key is long enough."""
    lines = docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(BLANKS)), UPPER, LOWER)
    return lines.withColumn("line_key", key).filter(F.char_length("line_key") >= min_chars).select(
        F.xxhash64("line_key").alias("h1"), F.xxhash64(F.lit(7), "line_key").alias("h2"), "doc_id", "text_key", "pos")


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a sorted partition that do not lie in the first document of their hash.

    Rows of the partition's first hash are open, as an earlier partition may hold
    the first document. Rows with pos -1 tell the first and the last hash of the
    partition with their first documents here.
    """
    first, run, run_doc = None, None, None
    for b in batches:
        if not len(b):
            continue
        h1, h2, doc = b["h1"].to_numpy(), b["h2"].to_numpy(), b["doc_id"].to_numpy()
        if first is None:
            first = run = (h1[0], h2[0])
            run_doc = doc[0]
            yield _mark(run, run_doc)
        new = np.ones(len(b), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = (h1[0], h2[0]) != run
        at = np.maximum.accumulate(np.where(new, np.arange(len(b)), -1))
        first_doc = np.where(at >= 0, doc[at], run_doc)
        is_open = (h1 == first[0]) & (h2 == first[1])
        take = is_open | (doc > first_doc)
        yield pd.DataFrame({"h1": h1[take], "h2": h2[take], "doc_id": doc[take],
                            "text_key": b["text_key"].to_numpy()[take], "pos": b["pos"].to_numpy()[take],
                            "open": is_open[take]})
        run, run_doc = (h1[-1], h2[-1]), first_doc[-1]
    if first is not None:
        yield _mark(run, run_doc)


def _mark(key: tuple[int, int], doc: int) -> pd.DataFrame:
    return pd.DataFrame({"h1": [key[0]], "h2": [key[1]], "doc_id": [doc], "text_key": [0],
                         "pos": np.array([-1], np.int32), "open": [True]})


def later_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text_key, pos of the lines that go, from ``keyed`` documents."""
    order = ["h1", "h2", "doc_id", "pos", "text_key"]
    ordered = line_rows(docs, min_chars).repartitionByRange(*order).sortWithinPartitions(*order)
    seen = persist_table(ordered.mapInPandas(
        _stream, "h1 long, h2 long, doc_id long, text_key long, pos int, open boolean"))
    # two rows for each partition at most, so this side is small at any size of the input
    firsts = seen.filter("pos = -1").groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"))
    opened = seen.filter("open and pos >= 0").join(F.broadcast(firsts), ["h1", "h2"]).filter("doc_id > first_doc")
    return seen.filter("not open").select("doc_id", "text_key", "pos").unionByName(
        opened.select("doc_id", "text_key", "pos"))


def _to_bitmaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        maps, counts = [], []
        for n, gone in zip(b["n_lines"], b["gone"]):
            keep = np.ones(n, bool)
            if gone is not None:
                keep[np.asarray(gone, np.int64)] = False
            counts.append(n - int(keep.sum()))
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield b[["doc_id", "text_key", "n_lines"]].assign(n_dropped=counts, keep_bitmap=maps)


def keep_flags(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Which lines stay, from a bitmap of ``keep_bitmaps``."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n_lines, n_dropped, keep_bitmap: one row per different (id, text).

    Texts are split at newlines. A line's key is the line without blanks at both
    ends, A-Z lower-cased; keys of ``min_chars`` code points or more that lie in two
    or more documents keep their lines only in the smallest id. ``keep_bitmap`` is
    one bit per line, deflated (``keep_flags`` reads it). NULL and empty texts are
    one empty line. A row with a NULL id keeps all lines and does not count as a
    document for others; lines repeated inside the first document all stay. Rows
    that repeat an id are one document. Runs jobs when called (writes one table).
    """
    docs = keyed(docs, id_col, text_col)
    gone = later_lines(docs, min_chars).groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("gone"))
    sizes = docs.select("doc_id", "text_key", F.size(F.split("text", "\n", -1)).alias("n_lines")).distinct()
    return sizes.join(gone, ["doc_id", "text_key"], "left").mapInPandas(
        _to_bitmaps, "doc_id long, text_key long, n_lines long, n_dropped long, keep_bitmap binary")


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        kept = []
        for text, n, bitmap in zip(b["text"], b["n_lines"], b["keep_bitmap"]):
            if bitmap is not None:
                text = "\n".join(line for line, stays in zip(text.split("\n"), keep_flags(bitmap, n)) if stays)
            kept.append(text)
        yield b[["doc_id", "text_key", "n_lines", "n_dropped"]].assign(
            text=kept, kept_sha256=[sha256_hex(t) for t in kept])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (of the old text), text (kept lines), n_lines, n_dropped, kept_sha256 for every row of ``docs``."""
    docs = keyed(docs, id_col, text_col)
    maps = bitmaps.filter("n_dropped > 0").select("doc_id", "text_key", "n_dropped", "keep_bitmap")
    joined = docs.withColumn("n_lines", F.size(F.split("text", "\n", -1)).cast("long")).join(
        maps, ["doc_id", "text_key"], "left").fillna(0, ["n_dropped"])
    return joined.mapInPandas(_cut, "doc_id long, text_key long, n_lines long, n_dropped long, text string, kept_sha256 string")


def line_digest(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for every document."""
    docs = docs.select("doc_id", "text")
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars)).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


SQL = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keys as (
  select doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
firsts as (select k, min(doc_id) as first_doc from keys where length(k) >= 10 group by k),
marked as (
  select keys.*, coalesce(keys.doc_id > first_doc, false) as gone from keys left join firsts using (k))
select doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
