"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

Sketch. Every document's set of word shingles fills ``COORDINATES`` bins: in round i each
shingle is placed in the bin that its i-th hash names, for as many rounds as there are bins;
then round t + j places all shingles in bin j. A bin keeps the smallest value of the first
round that reached it, so every bin is filled, most after one or two rounds, and the share of
equal bins concentrates around the similarity of two sets.

Search. Documents with equal sets are one class. Classes that agree in a band of bins are
candidates. A bucket's classes are first compared with its hub, the class that meets the most
others over all bands, so a group of copies costs one comparison each. Buckets whose classes
are not all connected by then are searched in bounded tiles of full sets, between classes of
different components only; a tile reports no pairs but one link per class that reaches another.
Every link is confirmed on the full sets of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import WordHashes, arrow_rows, keyed, mix64, persist_table, running_hash, sorted_groups
from meterwatch.llm.components import component_tops, connected_components

#: Bins of a sketch; bands of four bins. At a similarity of 0.85 a pair shares no band once in two million times, at 0.8 once in 37,000.
COORDINATES, BAND = 80, 4
#: Rows and shingles of one side of a tile; shingles that are multiplied at once.
TILE, TILE_SHINGLES, COLUMNS = 512, 500_000, 2048

_ROUNDS = mix64(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=1)
def _hashes() -> WordHashes:
    return WordHashes()


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; of all words if they are fewer; empty without words.

    Blanks (space, \\t to \\r) part words, A-Z are lower-cased.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(running_hash(_hashes()(words), min(width, len(words))))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """``COORDINATES`` values of a set that is not empty."""
    t = COORDINATES
    out = np.zeros(t, np.uint64)
    empty = np.ones(t, bool)
    for i in range(2 * t):
        h = mix64(shingles ^ _ROUNDS[i])
        if i < t:
            h.sort()  # by bin, then by value
            bins = (((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64)
            first = np.ones(len(h), bool)
            first[1:] = bins[1:] != bins[:-1]
            bins, h = bins[first], h[first]
            new = empty[bins]
            out[bins[new]] = h[new] ^ _ROUNDS[i]
            empty[bins] = False
        elif empty[i - t]:
            out[i - t] = h.min() ^ _ROUNDS[i]
            empty[i - t] = False
        if not empty.any():
            break
    return out


def _band_keys(values: np.ndarray) -> np.ndarray:
    bands = values.reshape(-1, BAND)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for j in range(BAND):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, j])
    return key.view(np.int64)


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, s1, s2 (digest of the set), bands (array of keys)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, s1, s2, bands = [], [], [], []
            for text in b["text"]:
                shingles = shingle_set(text, width)
                n.append(len(shingles))
                if len(shingles):
                    digest = running_hash(np.concatenate([mix64(shingles).sum(keepdims=True), mix64(shingles ^ _ROUNDS[7]).sum(keepdims=True)]), 1)
                    s1.append(digest.view(np.int64)[0])
                    s2.append(digest.view(np.int64)[1])
                    bands.append(_band_keys(sketch(shingles)))
                else:
                    s1.append(0)
                    s2.append(0)
                    bands.append(None)
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_key": b["text_key"], "n_shingles": n, "s1": s1, "s2": s2,
                                "bands": bands})

    return docs.select("doc_id", "text_key", "text").mapInPandas(
        run, "doc_id long, text_key long, n_shingles long, s1 long, s2 long, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar, written down; ``texts``: class, text."""
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, last_set = None, None
        for b in batches:
            good = np.zeros(len(b), bool)
            for k, (hub, one, other) in enumerate(zip(b["b"], b["text_b"], b["text_a"])):
                if hub != last:  # rows of a hub lie together
                    last, last_set = hub, shingle_set(one, width)
                mine = shingle_set(other, width)
                small, large = min(len(mine), len(last_set)), max(len(mine), len(last_set))
                if 100 * small < percent * large:
                    continue
                common = len(np.intersect1d(mine, last_set, assume_unique=True))
                good[k] = 100 * common >= percent * (len(mine) + len(last_set) - common)
            yield b.loc[good, ["a", "b"]]

    first = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
    with arrow_rows(pairs.sparkSession, 500):  # two texts a row
        return persist_table(both.select("a", "b", "text_a", "text_b").mapInPandas(confirm, "a long, b long"))


def _hub_pairs(buckets: DataFrame) -> DataFrame:
    """(a, b): every class of a bucket with the bucket's hub; ``buckets``: key, class."""
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n"))
    scores = buckets.join(sizes, "key").groupBy("class").agg(F.sum("n").alias("score"))
    hubs = buckets.join(scores, "class").groupBy("key").agg(F.max(F.struct("score", (-F.col("class")).alias("back"))).alias("top"))
    return buckets.join(hubs.select("key", (-F.col("top.back")).alias("b")), "key").filter("class <> b").select(
        F.col("class").alias("a"), "b").distinct()


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``left`` and ``right`` sets, by products over the shingles that two or more hold."""
    sizes = np.array([len(x) for x in sets], np.int64)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    held = np.bincount(column, minlength=len(values)) > 1
    number = np.cumsum(held) - 1
    row, column = row[held[column]], number[column[held[column]]]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(held.sum()), COLUMNS):
        i, k = np.searchsorted(column, [lo, lo + COLUMNS])
        dense = np.zeros((len(sets), COLUMNS), np.float32)
        dense[row[i:k], column[i:k] - lo] = 1
        out += dense[left] @ dense[right].T
    return out.astype(np.int64)


def _tile_links(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): links found in tiles, from each class to the smallest one that links reach there.

    ``rows``: key, tile, part, side (0 left, 1 right), class, component, shingles.
    """
    def tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in sorted_groups(batches, ["key", "tile", "part"]):
            left, right = np.flatnonzero(g["side"] == 0), np.flatnonzero(g["side"] == 1)
            own = g["part"][0] == 0
            if not len(left) or len(left) + len(right) < 2:
                continue
            right = np.concatenate([left, right]) if own else right
            sets = [np.frombuffer(x, np.uint64) for x in g["shingles"]]
            sizes = np.array([len(x) for x in sets])
            common = common_counts(sets, left, right)
            union = sizes[left][:, None] + sizes[right][None, :] - common
            linked = (100 * common >= percent * union) & (g["component"][left][:, None] != g["component"][right][None, :])
            i, k = np.nonzero(linked)
            if not len(i):
                continue
            i, k = left[i], right[k]
            parent = g["class"].copy()
            while True:
                low, before = np.minimum(parent[i], parent[k]), parent.copy()
                np.minimum.at(parent, i, low)
                np.minimum.at(parent, k, low)
                if (before == parent).all():
                    break
            new = parent != g["class"]
            yield pd.DataFrame({"a": g["class"][new], "b": parent[new]})

    order = ["key", "tile", "part"]
    return rows.repartition(*order).sortWithinPartitions(*order).mapInPandas(tiles, "a long, b long").distinct()


def _open_rows(buckets: DataFrame, labels: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Rows of the tiles of buckets that hold more than one component, with their sets.

    The classes outside of a bucket's largest component are dealt over tiles. A tile
    is compared with itself and a part of the largest component (part 0), with the
    other parts of it, and with each later tile (parts beyond those). Tiles and parts
    are as many as rows and shingles ask for, so a group is bounded.
    """
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"class": b["class"], "shingles": [shingle_set(t, width).tobytes() for t in b["text"]]})

    labelled = buckets.join(labels, "class", "left").select(
        "key", "class", "n_shingles", F.coalesce("component", "class").alias("component"))
    shares = labelled.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    tops = shares.groupBy("key").agg(F.max(F.struct("n", "component", "w")).alias("top"), F.sum("n").alias("every"),
                                     F.sum("w").alias("weight")).filter("every > top.n")
    rows = persist_table(labelled.join(tops, "key").select(
        "key", "class", "component", F.expr("component = top.component").alias("main"),
        F.expr(f"cast(greatest(ceil((every - top.n) / {TILE}), ceil((weight - top.w) / {TILE_SHINGLES})) as int)").alias("tiles"),
        F.expr(f"cast(greatest(ceil(top.n / {TILE}), ceil(top.w / {TILE_SHINGLES})) as int)").alias("parts")))
    needed = texts.join(rows.select("class").distinct(), "class", "left_semi").mapInPandas(sets, "class long, shingles binary")
    rows = rows.withColumn("own", F.expr("cast(pmod(xxhash64(class), tiles) as int)"))
    minor = """concat(
        transform(sequence(0, parts - 1), p -> struct(own as tile, p as part, 0 as side)),
        transform(filter(sequence(0, tiles - 1), t -> t > own), t -> struct(own as tile, parts + t as part, 0 as side)),
        transform(filter(sequence(0, tiles - 1), t -> t < own), t -> struct(t as tile, parts + own as part, 1 as side)))"""
    major = "transform(sequence(0, tiles - 1), t -> struct(t as tile, cast(pmod(xxhash64(class, 1), parts) as int) as part, 1 as side))"
    dealt = rows.join(needed, "class").select(
        "key", "class", "component", "shingles", F.explode(F.expr(f"if(main, {major}, {minor})")).alias("to"))
    return dealt.select("key", "to.tile", "to.part", "to.side", "class", "component", "shingles")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept: one row per row of ``docs``.

    Two documents are linked if 100 * (common shingles) >= ``percent`` * (all
    shingles). ``component_id`` is the smallest doc_id that links reach; ``kept``
    marks the document with that id. Texts with fewer than ``width`` words are one
    shingle; NULL and blank texts have none and are linked with nothing. A row with
    a NULL id is linked with nothing, has a NULL component and is kept. Rows that
    repeat an id with other texts are compared like documents of their own; if
    several of one component have its smallest id, the one with the smallest hash
    of the text is kept. Runs jobs when called and writes intermediate tables.
    """
    docs = keyed(docs, id_col, text_col)
    sketches = persist_table(sketched(docs, width))
    usable = sketches.filter("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "text_key", "n_shingles", "bands")).alias("one"))
    # a class is a number that is written down; its first row has the smallest (doc_id, text_key)
    classes = persist_table(classes.select("s1", "s2", F.monotonically_increasing_id().alias("class"), F.col("one.doc_id").alias("first_id"),
                                           F.col("one.text_key").alias("first_key"), F.col("one.n_shingles").alias("n_shingles"),
                                           F.col("one.bands").alias("bands")))
    rows = classes.select("class", "n_shingles", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = persist_table(rows.join(shared, "key", "left_semi"))
    involved = buckets.select("class").distinct()
    names = classes.join(involved, "class", "left_semi").select("class", "first_id", "first_key")
    texts = persist_table(docs.join(names, (docs["doc_id"] == names["first_id"]) & (docs["text_key"] == names["first_key"])).select(
        "class", "text").dropDuplicates(["class"]))

    links = _verified(_hub_pairs(buckets), texts, width, percent)
    labels = connected_components(links).select(F.col("node").alias("class"), "component")
    links = links.unionByName(persist_table(_tile_links(_open_rows(buckets, labels, texts, width), percent)))
    found = connected_components(links)

    tops = component_tops(found, classes.select("class", "first_id", "first_key"))
    named = classes.select("s1", "s2", "class", "first_id", "first_key").join(tops, "class", "left").select(
        "s1", "s2", F.coalesce("top_id", "first_id").alias("top_id"), F.coalesce("top_key", "first_key").alias("top_key"))
    placed = usable.select("doc_id", "text_key", "s1", "s2").distinct().join(named, ["s1", "s2"]).drop("s1", "s2")
    result = sketches.select("doc_id", "text_key", "n_shingles").join(placed, ["doc_id", "text_key"], "left")
    return result.select("doc_id", "text_key", "n_shingles", F.coalesce("top_id", "doc_id").alias("component_id"),
                         F.coalesce(F.expr("top_id = doc_id and top_key = text_key"), F.lit(True)).alias("kept"))


def near_digest(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    return near_duplicates(docs, width, percent).drop("text_key")
