"""Benchmark decontamination by multi-pattern search over words (after Wu and Manber).

Patterns are the windows of the test items as sequences of word numbers. A table of shifts
over hashed blocks of two words tells how far a search may jump; most words of a clean
document are never looked at twice. Where no jump is allowed, the block's bucket lists the
windows that end with it, and the words are compared one by one. Many starting places of a
batch of documents advance side by side in numpy.

The items go to the tasks in blocks of a fixed number of words, which are numbered in Spark,
written down, and read by the driver one at a time; a longer item is cut into runs that overlap
by a window less a word. With more than one block every document is searched once for each,
what is found is written down before the next block is read, and joined per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import keyed, persist_table

#: Word bytes stay, A-Z are lowered, the rest parts words. Every byte of a character beyond ASCII is a word byte.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Words of test items that are held by a task at once.
BLOCK_WORDS = 1_000_000
SLOTS = 1 << 20
LANE = 128


def plain_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def _block_slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (h >> np.uint64(44)).astype(np.int64)


class PatternSet:
    """Windows of one length with their shift table and suffix buckets."""

    def __init__(self, windows: np.ndarray, owners: list[list[str]]):
        self.windows, self.owners = windows, owners
        n, self.length = windows.shape
        self.block = min(2, self.length)
        self.shift = np.full(SLOTS, self.length - self.block + 1, np.int16)
        for end in range(self.block, self.length + 1):
            np.minimum.at(self.shift, self.slot_at(windows, end), self.length - end)
        last = self.slot_at(windows, self.length)
        self.order = np.argsort(last, kind="stable")
        self.starts = np.searchsorted(last[self.order], np.arange(SLOTS + 1)).astype(np.int32)

    def slot_at(self, rows: np.ndarray, end: int) -> np.ndarray:
        right = rows[:, end - 1]
        return _block_slot(rows[:, end - 2] if self.block == 2 else np.zeros_like(right), right)

    def search(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, windows): where in ``ids`` a window starts and which; ``ends[k]`` is where the document of word k ends.

        ``ids`` are the words of many documents in a row. A lane looks at window
        ends from its first place up to its last one.
        """
        n, m = len(ids), self.length
        if n < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        left = np.zeros(n, ids.dtype)
        if self.block == 2:
            left[1:] = ids[:-1]
        shifts = self.shift[_block_slot(left, ids)]
        at = np.arange(m - 1, n, LANE)
        stop = np.minimum(at + LANE, n)
        hits = []
        while len(at):
            jump = shifts[at]
            stay = at[jump == 0]
            if len(stay):
                hits.append(stay)
            at = at + np.maximum(jump, 1)
            alive = at < stop
            at, stop = at[alive], stop[alive]
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        last = np.concatenate(hits)
        slot = _block_slot(left[last], ids[last])
        low, count = self.starts[slot], self.starts[slot + 1] - self.starts[slot]
        places, found = [], []
        for lo in range(0, len(last), 200_000):  # bounds the candidates held at once
            c = count[lo:lo + 200_000]
            start = np.repeat(last[lo:lo + 200_000] - (m - 1), c)
            inner = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            pattern = self.order[np.repeat(low[lo:lo + 200_000], c) + inner]
            good = ends[start] >= start + m
            start, pattern = start[good], pattern[good]
            for j in range(m):
                same = ids[start + j] == self.windows[pattern, j]
                start, pattern = start[same], pattern[same]
            places.append(start)
            found.append(pattern)
        return np.concatenate(places), np.concatenate(found)


class ItemBlock:
    """Pattern sets of a block of test items; word numbers from 1 on, 0 is any other word."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.numbers: dict[bytes, int] = {}
        windows: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in plain_words(text)]
            length = min(width, len(words))
            for i in range(len(words) - length + 1 if length else 0):
                windows.setdefault(length, {}).setdefault(tuple(words[i:i + length]), set()).add(item)
        self.sets = [PatternSet(np.array(list(of), np.int32), [sorted(x) for x in of.values()]) for of in windows.values()]

    def numbered(self, words: list[bytes]) -> np.ndarray:
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in words), np.int32, len(words))


def item_runs(text: str, width: int, most: int) -> Iterator[tuple[str, int]]:
    """The words of an item and their number, in runs of ``most`` words at most (or ``width``) that hold every window."""
    words = plain_words(text)
    most = max(most, width)
    for lo in range(0, max(len(words) - width, 0) + 1, most - width + 1):
        run = words[lo:lo + most]
        if run:
            yield b" ".join(run).decode("utf-8", "surrogatepass"), len(run)


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int, block_words: int) -> DataFrame:
    """block, item_id, text: runs of the test items in blocks of ``block_words`` words at most (or one window), written down."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter(
        "item_id is not null and text is not null").distinct()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for item, text in zip(b["item_id"], b["text"]):
                runs = list(item_runs(text, width, block_words))
                if runs:
                    yield pd.DataFrame({"item_id": [item] * len(runs), "text": [t for t, _ in runs], "n": [n for _, n in runs]})

    runs = persist_table(items.mapInPandas(cut, "item_id string, text string, n long"))
    total = runs.agg(F.sum("n")).first()[0] or 0
    if total <= block_words:
        return runs.select(F.lit(0).cast("long").alias("block"), "item_id", "text")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, room = TaskContext.get().partitionId() << 32, block_words
        for b in batches:
            blocks = []
            for n in b["n"]:
                if room < n and room < block_words:
                    block, room = block + 1, block_words
                room -= n
                blocks.append(block)
            yield pd.DataFrame({"block": blocks, "item_id": b["item_id"], "text": b["text"]})

    # each task fills blocks of its own
    return persist_table(runs.repartition(-(-total // block_words)).mapInPandas(number, "block long, item_id string, text string"))


def _hits(words_of_docs: list[list[bytes]], block: ItemBlock) -> list[tuple[list[int], list[str]]]:
    """For each document: hit intervals (start, end, start, end, ...) and the items found."""
    sizes = np.array([len(w) for w in words_of_docs], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.concatenate([block.numbered(w) for w in words_of_docs]) if sizes.sum() else np.zeros(0, np.int32)
    ends = np.repeat(begins[1:], sizes)
    cover = np.zeros(len(ids) + 1, np.int32)
    items: dict[int, set[str]] = {}
    for patterns in block.sets:
        places, found = patterns.search(ids, ends)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + patterns.length, -1)
        owner = np.searchsorted(begins, places, side="right") - 1
        for d, p in set(zip(owner.tolist(), found.tolist())):
            items.setdefault(d, set()).update(patterns.owners[p])
    hit = np.cumsum(cover[:-1]) > 0
    out = []
    for d, n in enumerate(sizes):
        if d not in items:
            out.append(([], []))
            continue
        own = np.concatenate([[False], hit[begins[d]:begins[d] + n], [False]])
        out.append((np.flatnonzero(own[1:] != own[:-1]).tolist(), sorted(items[d])))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, hits (array of start, end in words, in turn), items (array<string>) for every row.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased.
    A window is ``width`` words in a row of an item, or all words of a shorter one.
    Items with a NULL id, a NULL text or no words have no windows; repeated items
    count once; an empty benchmark hits nothing. NULL and empty texts have no
    words; NULL ids and repeated rows are searched like any other. The items are
    cut, numbered and written down by jobs when this is called, and reach the driver a block
    at a time; with more than one block the searches too run when this is called.
    """
    docs = keyed(docs, id_col, text_col)
    context = docs.sparkSession.sparkContext
    runs = item_blocks(benchmark, item_col, item_text_col, width, block_words)
    numbers = sorted(r["block"] for r in runs.select("block").distinct().collect()) or [0]

    def search(sent):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            block = ItemBlock(sent.value, width)
            for b in batches:
                for lo in range(0, len(b), 2_000):
                    part = b.iloc[lo:lo + 2_000]
                    words = [plain_words(t) for t in part["text"]]
                    found = _hits(words, block)
                    yield pd.DataFrame({"doc_id": part["doc_id"], "text_key": part["text_key"], "n_words": [len(w) for w in words],
                                        "hits": [h for h, _ in found], "items": [i for _, i in found]})
        return run

    schema = "doc_id long, text_key long, n_words long, hits array<int>, items array<string>"
    found = []
    for k in numbers:
        items = [(r["item_id"], r["text"]) for r in runs.filter(F.col("block") == k).select("item_id", "text").collect()]
        sent = context.broadcast(items)
        rows = docs.mapInPandas(search(sent), schema)
        if len(numbers) == 1:
            return rows.select("doc_id", "text_key", "n_words", _covered("hits").alias("n_hit"), "hits", "items")
        # every row of the first block, of the others those that hold an item
        found.append(persist_table(rows if not found else rows.filter("size(items) > 0")))
        sent.destroy()
    return _merged(found, schema)


def _covered(hits: str):
    """Words inside of the intervals: ends count up, starts count down."""
    return F.aggregate(F.transform(hits, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long")), F.lit(0).cast("long"),
                       lambda a, x: a + x)


def _merged(found: list[DataFrame], schema: str) -> DataFrame:
    """Results of several blocks of items joined per document; copies of a row keep their number."""
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hits, items = [], []
            for many, names in zip(b["all_hits"], b["all_items"]):
                spans = sorted((h[k], h[k + 1]) for h in many for k in range(0, len(h), 2))
                merged: list[int] = []
                for s, e in spans:
                    if merged and s <= merged[-1]:
                        merged[-1] = max(merged[-1], e)
                    else:
                        merged += [s, e]
                hits.append(merged)
                items.append(sorted({x for n in names for x in n}))
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_key": b["text_key"], "n_words": b["n_words"], "hits": hits, "items": items})

    every = found[0].withColumn("block", F.lit(0))
    for k, more in enumerate(found[1:], 1):
        every = every.unionByName(more.withColumn("block", F.lit(k)))
    held = every.groupBy("doc_id", "text_key", "n_words").agg(
        F.collect_set(F.when(F.size("hits") > 0, F.col("hits"))).alias("all_hits"),
        F.collect_set(F.when(F.size("items") > 0, F.col("items"))).alias("all_items"),
        F.sum((F.col("block") == 0).cast("int")).alias("rows"))
    joined = held.withColumn("copy", F.explode(F.sequence(F.lit(1), "rows"))).drop("copy", "rows").mapInPandas(join, schema)
    return joined.select("doc_id", "text_key", "n_words", _covered("hits").alias("n_hit"), "hits", "items")


def leak_digest(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``."""
    found = find_leaks(docs, benchmark, width)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
bw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select distinct item_id, least(len(w), 10) as l, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as k
  from (select item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) as i from bw where len(w) > 0)),
lens as (select distinct l from win),
dwin as (
  select doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') as k
  from (select doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) as i from dw, lens where len(w) >= l)),
hit as (select doc_id, i, dwin.l, item_id from dwin join win on dwin.k = win.k and dwin.l = win.l),
cov as (select doc_id, count(distinct p) as n_hit from (
          select distinct doc_id, unnest(generate_series(i, i + l - 1)) as p from hit) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(x, ',' order by x) as s
        from (select distinct doc_id, cast(item_id as varchar) as x from hit) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join cov using (doc_id) left join its using (doc_id)
"""
