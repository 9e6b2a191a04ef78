"""What the corpus operators share: row keys, digests, stages.

Conventions of every operator in this package:

- a NULL text counts as the empty text; a row with a NULL id is returned, and never takes
  part in a comparison with other rows (it cannot be named as the smaller one);
- rows are told apart by (id, hash of the text), so rows that repeat an id with another
  text keep their own results, and fully repeated rows get equal results;
- only the named id and text columns are read; further columns, whatever their names,
  neither disturb an operator nor reach its result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwatch.session import persist_table

__all__ = ["WordHashes", "arrow_rows", "keyed", "mix64", "persist_table", "running_hash", "sha256_hex", "sorted_groups", "word_hash"]

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (NULL as empty) and text_key, under these names."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).withColumn(
        "text_key", F.xxhash64("text"))


def sha256_hex(data: bytes | str) -> str:
    return hashlib.sha256(data.encode("utf-8", "surrogatepass") if isinstance(data, str) else data).hexdigest()


def word_hash(word: bytes) -> int:
    """64 bits of a word, the same in every process."""
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = (x ^ (x >> _S30)) * _C1
    x = (x ^ (x >> _S27)) * _C2
    return x ^ (x >> _S31)


class WordHashes:
    """Hashes of words, remembered up to a fixed number of words."""

    def __init__(self, most: int = 400_000):
        self.most, self.known = most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = word_hash(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def running_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` consecutive entries (order matters)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n] + np.uint64(j + 1))
    return out


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Fewer rows in a batch for Python than usual, for jobs that run inside; the setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The groups of a partition that is sorted by ``keys``, column by column; a group may lie in several batches."""
    held: pd.DataFrame | None = None
    for b in batches:
        if held is not None:
            b = pd.concat([held, b], ignore_index=True)
        if not len(b):
            continue
        new = np.zeros(len(b), bool)
        columns = {c: b[c].to_numpy() for c in b.columns}
        for k in keys:
            new[1:] |= columns[k][1:] != columns[k][:-1]
        at = [0, *np.flatnonzero(new).tolist()]
        for lo, hi in zip(at, at[1:]):
            yield {c: v[lo:hi] for c, v in columns.items()}
        held = b.iloc[at[-1]:]
    if held is not None and len(held):
        yield {c: held[c].to_numpy() for c in held.columns}
