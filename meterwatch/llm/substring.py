"""Repeated passages, found with a compressed FM-index per shard.

Texts are cut into segments: runs of windows with the same minimizer, the window's group of
``ANCHOR`` words with the smallest hash. Equal windows have equal minimizers, so a segment has
to be compared only with those of its minimizer. Minimizers of a single document are done
with; equal segments are one, held by their smallest document. Segments of a minimizer go to
one shard, which indexes their words (``fm_index``), streams them backwards through the index,
and reports the windows that a document with a smaller id holds too.

A minimizer with very many different segments (the border of a common passage) is not kept
together: its segments are cut into single windows, which go to shards by their own hash, those
of one document left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import WordHashes, keyed, mix64, persist_table, running_hash, sha256_hex, sorted_groups
from meterwatch.llm.fm_index import WindowIndex

#: Words of a minimizer; windows of a segment at most.
ANCHOR, LONGEST = 12, 64
#: Different segments of a minimizer that stay together; segments of a shard on average.
TOGETHER, PER_SHARD = 500, 6_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _hashes() -> WordHashes:
    return WordHashes()


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words_of(text: str) -> list[bytes]:
    """Words between blanks (space, \\t to \\r), as they are."""
    return text.encode("utf-8", "surrogatepass").split()


def _range_hashes(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each range of words that does not depend on its place."""
    size = 1 << max(10, len(hashes).bit_length())
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(hashes) * _powers(int(_BASE), size)[:len(hashes)], dtype=np.uint64)])
        return mix64((sums[starts + lengths] - sums[starts]) * _powers(int(_BACK), size)[starts] + lengths.astype(np.uint64))


def segments(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, windows, digest) of the segments of a document."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64)
    anchor = min(ANCHOR, width)
    groups = running_hash(hashes, anchor)
    span = width - anchor + 1
    padded = np.full(-(-len(groups) // span) * span + span, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(groups)] = groups
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[span - 1:span - 1 + n])
    new = np.ones(n, bool)
    new[1:] = least[1:] != least[:-1]
    starts = np.flatnonzero(new)
    run = np.arange(n) - starts[np.cumsum(new) - 1]
    starts = np.flatnonzero(run % LONGEST == 0)
    counts = np.diff(np.append(starts, n))
    digests = _range_hashes(hashes, starts, counts + width - 1)
    return least[starts].view(np.int64), starts.astype(np.int32), counts.astype(np.int32), digests.view(np.int64)


def _cut_documents(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _hashes()
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("n_words", "kept_sha256", "keys", "starts", "counts", "digests")}
            for text in b["text"]:
                words = words_of(text)
                found = segments(hashes(words) if len(words) >= width else np.zeros(0, np.uint64), width)
                for k, v in zip(out, (len(words), sha256_hex(b" ".join(words)), *found)):
                    out[k].append(v)
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_key": b["text_key"], **out})

    return docs.select("doc_id", "text_key", "text").mapInPandas(
        run, "doc_id long, text_key long, n_words long, kept_sha256 string, keys array<long>, starts array<int>, counts array<int>, digests array<long>")


def _contents(docs: DataFrame, owned: DataFrame, width: int) -> DataFrame:
    """key, digest, doc_id, off, unit, content: the words of every owned segment, or of its windows where it is hot (off >= 0)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _hashes()
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("key", "digest", "doc_id", "off", "unit", "content")}
            for doc, text, own in zip(b["doc_id"], b["text"], b["own"]):
                words = words_of(text)
                numbers = None
                for s in own:
                    start, count = s["start"], s["count"]
                    if not s["hot"]:
                        row = [(-1, s["key"], b" ".join(words[start:start + count + width - 1]))]
                    else:
                        numbers = hashes(words) if numbers is None else numbers
                        units = _range_hashes(numbers, np.arange(start, start + count), np.full(count, width)).view(np.int64)
                        row = [(j, units[j], b" ".join(words[start + j:start + j + width])) for j in range(count)]
                    for off, unit, content in row:
                        for k, v in zip(out, (s["key"], s["digest"], doc, off, unit, content)):
                            out[k].append(v)
            yield pd.DataFrame(out)

    own = owned.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("key", "digest", "start", "count", "hot")).alias("own"))
    texts = docs.join(own, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    return texts.select("doc_id", "text", "own").mapInPandas(
        run, "key long, digest long, doc_id long, off int, unit long, content binary")


def _reports(units: DataFrame, width: int) -> DataFrame:
    """number, unit, digest, offs, lens, docs: runs of windows that a smaller document holds, with that document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in sorted_groups(batches, ["shard"]):
            texts = [c.split(b" ") for c in g["content"]]
            numbers: dict[bytes, int] = {}
            coded = [np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in t), np.int64, len(t)) for t in texts]
            index = WindowIndex(coded, len(numbers) + 1, width)
            docs = g["doc_id"].astype(np.int64)
            smallest = index.smallest(docs)
            out: dict[str, list] = {k: [] for k in ("number", "unit", "digest", "offs", "lens", "docs")}
            for k, classes in enumerate(index.window_classes()):
                first = smallest[classes]
                at = np.flatnonzero(first < docs[k])
                if not len(at):
                    continue
                new = np.ones(len(at), bool)
                new[1:] = (at[1:] != at[:-1] + 1) | (first[at[1:]] != first[at[:-1]])
                begin = np.flatnonzero(new)
                for name, v in zip(out, (g["number"][k], g["unit"][k], g["digest"][k], at[begin].astype(np.int32),
                                         np.diff(np.append(begin, len(at))).astype(np.int32), first[at[begin]])):
                    out[name].append(v)
            yield pd.DataFrame(out)

    return units.repartition("shard").sortWithinPartitions("shard", "unit", "number", "digest").mapInPandas(
        run, "number long, unit long, digest long, offs array<int>, lens array<int>, docs array<long>")


def repeated_passages(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, cuts): doc_id, text_key, n_words, kept_sha256 (of all words), and doc_id, text_key, spans of words to cut.

    ``spans`` (array<struct<at, n>>) are words covered by a window of ``width`` words whose
    words also start in a document with a smaller id. Segments count as equal if their
    minimizer, length and digest are (two hashes of 64 bits); everything else is decided by the
    words themselves. Runs jobs when called and writes intermediate tables.
    """
    docs = keyed(docs, id_col, text_col)
    cut = persist_table(_cut_documents(docs, width))
    rows = cut.filter("doc_id is not null").select("doc_id", "text_key", F.explode(F.arrays_zip("keys", "starts", "counts", "digests")).alias("s")).select(
        "doc_id", "text_key", F.col("s.keys").alias("key"), F.col("s.starts").alias("start"), F.col("s.counts").alias("count"), F.col("s.digests").alias("digest"))
    shared = rows.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("key")
    repeated = persist_table(rows.join(shared, "key", "left_semi"))
    owners = repeated.groupBy("key", "digest", "count").agg(F.min(F.struct("doc_id", "text_key", "start")).alias("first"))
    owners = persist_table(owners.select("key", "digest", "count", "first.*"))
    many = owners.groupBy("key").agg(F.count("*").alias("n"))
    # a minimizer with one segment left has nothing to be compared with
    open_keys = many.filter("n > 1").select("key", (F.col("n") > TOGETHER).alias("hot"))
    owned = owners.join(open_keys, "key")
    contents = persist_table(_contents(docs, owned, width))

    whole = contents.filter("off < 0").select(F.lit(-1).cast("long").alias("number"), "unit", "digest", "doc_id", "content")
    windows = contents.filter("off >= 0")
    # windows are the same if their words are; the hash only deals them out. A common one is a number that is written down
    common = windows.groupBy("unit", "content").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b")
    common = persist_table(common.select(F.monotonically_increasing_id().alias("number"), "unit", "content", "a", "b"))
    # it is held by its smallest document and asked for by a larger one
    asked = common.select("number", "unit", F.explode(F.array(F.struct(F.col("a").alias("doc_id"), F.lit(0).cast("long").alias("digest")),
                                                              F.struct(F.col("b").alias("doc_id"), F.lit(1).cast("long").alias("digest")))).alias("u"), "content")
    units = whole.unionByName(asked.select("number", "unit", "u.digest", "u.doc_id", "content"))
    shards = max(1, contents.count() // PER_SHARD)
    units = units.withColumn("shard", F.pmod(F.xxhash64("unit"), F.lit(shards)).cast("int"))
    reports = persist_table(_reports(units, width))

    runs = reports.filter("number < 0").join(open_keys.filter("not hot").select(F.col("key").alias("unit")), "unit", "left_semi").select(
        F.col("unit").alias("key"), "digest", F.expr("transform(arrays_zip(offs, lens), r -> struct(r.offs as at, r.lens as n))").alias("runs"))
    first = reports.filter("number >= 0 and digest = 1").select("number", F.col("docs")[0].alias("first_doc")).join(common, "number")
    hot_runs = windows.join(first.select("unit", "content", "first_doc"), ["unit", "content"]).filter("first_doc < doc_id").groupBy("key", "digest").agg(
        F.collect_list(F.struct(F.col("off").alias("at"), F.lit(1).alias("n"))).alias("runs"))
    found = owners.select("key", "digest", "count", F.col("doc_id").alias("owner")).join(
        runs.unionByName(hot_runs), ["key", "digest"], "left")
    spans = repeated.join(found, ["key", "digest", "count"]).withColumn("spans", F.when(
        F.col("doc_id") > F.col("owner"), F.array(F.struct(F.col("start").alias("at"), (F.col("count") + width - 1).alias("n")))).otherwise(
        F.expr(f"transform(runs, r -> struct(start + r.at as at, r.n + {width - 1} as n))")))
    cuts = spans.filter("size(spans) > 0").groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return cut.select("doc_id", "text_key", "n_words", "kept_sha256"), cuts


def remove_passages(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, kept_sha256 and text (kept words, one space between) for every row of ``docs``.

    A word goes if a window of ``width`` words covers it whose words also start in
    a document with a smaller id; windows are judged on the input. Texts shorter
    than a window keep all words; NULL, empty and blank texts have none. Rows with
    a NULL id keep all words and count for no other; rows that repeat an id are no
    smaller than each other. ``with_text=False`` leaves the text out, and texts
    without a cut are not moved.
    """
    every, cuts = repeated_passages(docs, width, id_col, text_col)
    texts = keyed(docs, id_col, text_col).join(cuts, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            removed, kept = [], []
            for text, spans in zip(b["text"], b["spans"]):
                words = words_of(text)
                cover = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    cover[s["at"]] += 1
                    cover[s["at"] + s["n"]] -= 1
                gone = np.cumsum(cover[:-1]) > 0
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone) if not g))
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_key": b["text_key"], "n_removed": removed, "cut_sha256": [sha256_hex(k) for k in kept],
                                "kept": [k.decode("utf-8", "surrogatepass") for k in kept] if with_text else None})

    changed = texts.select("doc_id", "text_key", "text", "spans").mapInPandas(
        run, "doc_id long, text_key long, n_removed long, cut_sha256 string, kept string")
    if not with_text:
        changed = changed.drop("kept")
    result = every.join(changed, ["doc_id", "text_key"], "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("cut_sha256", "kept_sha256").alias("kept_sha256"), *(["kept"] if with_text else []))
    if not with_text:
        return result
    blanks = F.array_join(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""), " ")
    plain = keyed(docs, id_col, text_col).select("doc_id", "text_key", blanks.alias("plain")).dropDuplicates(["doc_id", "text_key"])
    joined = result.join(plain.withColumnsRenamed({"doc_id": "other_id", "text_key": "other_key"}), F.expr("text_key = other_key and doc_id <=> other_id"))
    return joined.select("doc_id", "text_key", "n_words", "n_removed", "kept_sha256", F.coalesce("kept", "plain").alias("text"))


def passage_digest(docs: DataFrame, width: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``."""
    return remove_passages(docs, width, with_text=False).drop("text_key")


SQL = r"""
with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 49], ' ') as k
        from (select doc_id, w, unnest(generate_series(1, len(w) - 49)) as i from w where len(w) >= 50)),
low as (select k, min(doc_id) as d from win group by k),
gone as (select distinct doc_id, unnest(generate_series(i, i + 49)) as p from win join low using (k) where d < doc_id),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from w),
kept as (select doc_id, count(p2) as n_removed, string_agg(word, ' ' order by p) filter (where p2 is null) as s
         from (select words.doc_id, words.p, word, gone.p as p2 from words left join gone on words.doc_id = gone.doc_id and words.p = gone.p)
         group by doc_id)
select w.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(s, '')) as kept_sha256
from w left join kept using (doc_id)
"""
