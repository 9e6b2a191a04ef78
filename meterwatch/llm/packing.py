"""Token ids packed into rows of a fixed length by best fit decreasing.

Documents are encoded, a long one is cut into pieces of the row length at most, and pieces are
dealt over shards by a hash, as many as the size of the corpus asks for. In a shard the longest
piece goes first, each to the fullest row that still holds it; a segment tree over the
remaining capacities finds that row. A packed row is what a trainer reads: ids and positions
as fixed-length little-endian numbers, so that rows one after another are the matrix, with the
cumulative segment lengths and the pieces that lie in it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import keyed, sorted_groups
from meterwatch.llm.pretokens import BYTE_PATTERN

#: Bytes of text that make a shard; a shard is packed by one task in memory.
SHARD_BYTES = 8 << 20


def number_type(ranks_path: str, length: int, *further: int | None) -> str:
    """The numbers of a packed row: 16 bits, or 32 if an id of the file, a further id or a position asks for it."""
    with open(ranks_path, "rb") as f:
        largest = max((int(line.split()[1]) for line in f if line.strip()), default=0)
    return "<u2" if max(largest, length - 1, *(x for x in further if x is not None)) < 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_pieces(docs: DataFrame, ranks_path: str, length: int, end_id: int | None, kind: str = "<u2") -> DataFrame:
    """doc_id, text_key, piece, n, ids (little-endian, of type ``kind``) of ``keyed`` documents with at least one token."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(ranks_path)
        for b in batches:
            out: dict[str, list] = {"doc_id": [], "text_key": [], "piece": [], "n": [], "ids": []}
            for doc, key, text in zip(b["doc_id"], b["text_key"], b["text"]):
                ids = encoding.encode_to_numpy(text, disallowed_special=()).astype(kind)
                if not len(ids):
                    continue
                if end_id is not None:
                    ids = np.append(ids, np.array([end_id], kind))
                for k, lo in enumerate(range(0, len(ids), length)):
                    part = ids[lo:lo + length]
                    for name, value in zip(out, (doc, key, k, len(part), part.tobytes())):
                        out[name].append(value)
            yield pd.DataFrame(out).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text_key", "text").mapInPandas(run, "doc_id long, text_key long, piece int, n int, ids binary")


class CapacityTree:
    """Counts of open rows by what they can still take; finds the least capacity of at least n."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, change: int) -> None:
        k = capacity + self.leaves
        while k:
            self.count[k] += change
            k >>= 1

    def least(self, n: int) -> int:
        """-1 if no open row takes n."""
        count, k = self.count, n + self.leaves
        if count[k]:
            return n
        while k > 1:
            if not k & 1 and count[k + 1]:  # a right neighbour holds larger capacities
                k += 1
                break
            k >>= 1
        else:
            return -1
        while k < self.leaves:
            k = 2 * k if count[2 * k] else 2 * k + 1
        return k - self.leaves


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Rows of piece numbers; equal sizes in their given order."""
    tree, open_rows, rows = CapacityTree(length), [[] for _ in range(length + 1)], []
    for p in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[p])
        room = tree.least(n)
        if room < 0:
            row, room = len(rows), length
            rows.append([])
        else:
            row = open_rows[room].pop()
            tree.add(room, -1)
        rows[row].append(p)
        if room > n:
            open_rows[room - n].append(row)
            tree.add(room - n, 1)
    return rows


PACKED = ("shard int, row int, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
          "doc_ids array<long>, text_keys array<long>, pieces array<int>")


def pack(docs: DataFrame, ranks_path: str, length: int = 2048, end_id: int | None = 50256, pad_id: int = 50256,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed rows: shard, row, n_tokens, input_ids, position_ids, cu_seqlens, doc_ids, text_keys, pieces.

    ``input_ids`` and ``position_ids`` are ``length`` unsigned 16-bit numbers
    (``matrix`` reads them), or 32-bit ones with a further column ``id_bytes`` of 4 if
    an id or ``length`` does not fit 16 bits; unused places hold ``pad_id`` and position 0. Positions
    begin at 0 with every segment; segment s lies between ``cu_seqlens[s]`` and
    ``cu_seqlens[s + 1]`` and is piece ``pieces[s]`` of the document, whose pieces in
    order give back all its ids (``unpack``). Each document with tokens ends with
    ``end_id`` unless that is None. NULL and empty texts have no tokens and no
    pieces; NULL ids and repeated rows are packed like any other. Counts the bytes of the
    corpus when called.
    """
    docs = keyed(docs, id_col, text_col)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    kind = number_type(ranks_path, length, end_id, pad_id)
    pieces = token_pieces(docs, ranks_path, length, end_id, kind)
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_key", "piece"), F.lit(shards)).cast("int"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in sorted_groups(batches, ["shard"]):
            yield _packed_rows(g, length, pad_id, kind)

    # pieces in a fixed order, so that a task that runs again packs the same rows
    packed = pieces.repartition("shard").sortWithinPartitions("shard", "doc_id", "text_key", "piece").mapInPandas(run, PACKED)
    return packed if kind == "<u2" else packed.withColumn("id_bytes", F.lit(4))


def _packed_rows(g: dict[str, np.ndarray], length: int, pad_id: int, kind: str) -> pd.DataFrame:
    out: dict[str, list] = {name.split()[0]: [] for name in PACKED.split(", ")}
    steps = np.arange(length, dtype=kind)
    for number, members in enumerate(best_fit_decreasing(g["n"], length)):
        ends = np.concatenate([[0], np.cumsum(g["n"][members])]).astype(np.int32)
        ids = b"".join(g["ids"][members])
        positions = np.concatenate([steps[:n] for n in g["n"][members]])
        blank = length - int(ends[-1])
        values = (g["shard"][0], number, int(ends[-1]), ids + np.full(blank, pad_id, kind).tobytes(),
                  positions.tobytes() + bytes(steps.itemsize * blank), ends,
                  [None if pd.isna(d) else int(d) for d in g["doc_id"][members]], g["text_key"][members], g["piece"][members])
        for name, value in zip(out, values):
            out[name].append(value)
    return pd.DataFrame(out)


def matrix(rows: list[bytes], length: int) -> np.ndarray:
    """Rows of ``input_ids`` or ``position_ids`` as one matrix; their bytes tell 16 from 32 bits."""
    kind = "<u4" if rows and len(rows[0]) == 4 * length else "<u2"
    return np.frombuffer(b"".join(rows), kind).reshape(-1, length)


def unpack(packed: DataFrame) -> DataFrame:
    """doc_id, text_key, ids (array<int>): the ids of every document, its pieces in order."""
    kind = "<u4" if "id_bytes" in packed.columns else "<u2"

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: dict[str, list] = {"doc_id": [], "text_key": [], "piece": [], "ids": []}
            for ids, ends, docs, keys, pieces in zip(b["input_ids"], b["cu_seqlens"], b["doc_ids"], b["text_keys"], b["pieces"]):
                row = np.frombuffer(ids, kind).astype(np.int32)
                for s in range(len(pieces)):
                    doc = None if pd.isna(docs[s]) else int(docs[s])
                    for name, value in zip(out, (doc, keys[s], pieces[s], row[ends[s]:ends[s + 1]])):
                        out[name].append(value)
            yield pd.DataFrame(out).astype({"doc_id": "Int64"})

    parts = packed.select("input_ids", "cu_seqlens", "doc_ids", "text_keys", "pieces").mapInPandas(
        cut, "doc_id long, text_key long, piece int, ids array<int>")
    ordered = parts.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts"))
    return ordered.select("doc_id", "text_key", F.flatten("parts.ids").alias("ids"))
