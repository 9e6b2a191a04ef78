"""Quality by the vote of the nearest labelled documents in a latent-semantic space.

A text is a bag of hashed terms: groups of three bytes, groups of four shapes (runs of
capitals, letters, digits or one sign), and words that repeat the word before them. A bounded
sample of labelled documents spans the latent space: the leading right singular vectors of its
weighted term matrix, found by subspace iteration in one task. The projection and the labelled
vectors are broadcast, both bounded by constants of this module; every document is projected,
its cosines with all labelled vectors are computed exactly in blocks, and the labels of the
nearest ones vote with a power of their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import keyed, persist_table

#: Bits of the slots for groups of bytes and of shapes; one more slot counts repeated words.
BYTE_BITS, SHAPE_BITS = 14, 12
TERMS = (1 << BYTE_BITS) + (1 << SHAPE_BITS) + 1
#: Bound of the labelled sample, dimensions of the latent space, and rounds of the subspace iteration.
MOST_LABELLED, DIMS, ROUNDS = 8_000, 32, 6
#: Neighbours that vote, the power of their similarity, and the score from which label 1 is predicted.
NEIGHBOURS, POWER, THRESHOLD = 25, 16, 0.7
#: Remainder of an id's crc32 modulo ``FOLDS`` that gives no label.
FOLDS, HELD_OUT = 4, 2
#: Rows of a dense block while fitting, documents of a block of cosines, positions hashed at a time.
FIT_ROWS, BLOCK, CHUNK = 256, 256, 1 << 18

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Shape of a byte: capital, letter (any byte of a character outside of ASCII), digit, or the sign itself.
_SHAPE = np.array([1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 or b >= 128 else 3 if 48 <= b <= 57 else b for b in range(256)], np.uint8)


def _groups(data: np.ndarray, width: int, bits: int) -> np.ndarray:
    """How often each slot occurs among the hashes of all runs of ``width`` bytes."""
    counts = np.zeros(1 << bits, np.int64)
    for start in range(0, len(data) - width + 1, CHUNK):
        part = data[start:start + CHUNK + width - 1].astype(np.uint64)
        code = np.zeros(len(part) - width + 1, np.uint64)
        for k in range(width):
            code = (code << np.uint64(8)) | part[k:k + len(code)]
        with np.errstate(over="ignore"):
            slots = (code * _MULTIPLIER) >> np.uint64(64 - bits)
        counts += np.bincount(slots.astype(np.int64), minlength=1 << bits)
    return counts


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a whole text and their weights (roots of counts, unit length); none for the empty text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    shape = _SHAPE[data]
    if len(shape):
        shape = shape[np.r_[True, shape[1:] != shape[:-1]]]
    words = text.split()
    counts = np.concatenate([_groups(data, 3, BYTE_BITS), _groups(shape, 4, SHAPE_BITS), [sum(map(eq, words, words[1:]))]])
    slots = np.flatnonzero(counts)
    weights = np.sqrt(counts[slots])
    length = np.sqrt((weights * weights).sum())
    return slots.astype(np.int32), (weights / length if length else weights).astype(np.float32)


def subspace(slots: list[np.ndarray], weights: list[np.ndarray], dims: int, size: int = TERMS) -> np.ndarray:
    """(size, dims or fewer): leading right singular vectors of the rows given, by subspace iteration in blocks."""
    def blocks() -> Iterator[np.ndarray]:
        for start in range(0, len(slots), FIT_ROWS):
            dense = np.zeros((min(FIT_ROWS, len(slots) - start), size), np.float32)
            for k in range(len(dense)):
                dense[k, slots[start + k]] = weights[start + k]
            yield dense

    width = min(dims + 16, size, max(1, len(slots)))
    basis = np.linalg.qr(np.random.default_rng(7).normal(size=(size, width)))[0].astype(np.float32)
    for _ in range(ROUNDS):
        basis = np.linalg.qr(sum(a.T @ (a @ basis) for a in blocks()).astype(float))[0].astype(np.float32)
    small = np.zeros((width, width))
    for a in blocks():
        seen = (a @ basis).astype(float)
        small += seen.T @ seen
    order = np.argsort(-np.linalg.eigh(small)[0], kind="stable")[:dims]
    return (basis.astype(float) @ np.linalg.eigh(small)[1][:, order]).astype(np.float32)


def latent(slots: np.ndarray, weights: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Unit vector of a text in the latent space, zero if nothing of it lies there."""
    v = (projection[slots].astype(float) * weights[:, None]).sum(0)
    length = np.sqrt((v * v).sum())
    return v / length if length > 1e-9 else np.zeros(len(v))


@dataclass
class Voters:
    """Labelled vectors, their labels (0 to 1), and the projection that made them."""
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def vote(self, rows: np.ndarray) -> np.ndarray:
        """Score of every row; one without a similar neighbour gets the share of label 1."""
        out = np.full(len(rows), self.labels.mean() if len(self.labels) else 0.0)
        k = min(NEIGHBOURS, len(self.labels))
        for start in range(0, len(rows) if k else 0, BLOCK):
            block = rows[start:start + BLOCK]
            full = np.zeros((BLOCK, rows.shape[1]))  # equal shapes round alike, wherever a row stands
            full[:len(block)] = block
            cosine = np.round(full @ self.vectors.T, 9)[:len(block)]
            near = np.sort(np.argpartition(-cosine, k - 1, axis=1)[:, :k], axis=1)
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0.0) ** POWER
            total = weight.sum(1)
            found = total > 0
            out[start:start + len(block)][found] = ((weight * self.labels[near]).sum(1)[found] / total[found])
        return np.clip(out, 0.0, 1.0)


def _remainder(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """(doc_id, label, slots, weights) of at most ``MOST_LABELLED`` documents, written down.

    The first ids by a hash, outside of the held-out class. One text per id: of rows that
    repeat an id, that with the smallest text hash. Labels that contradict each other are averaged.
    """
    named = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("double").alias("label")).filter(
        F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (_remainder("doc_id") != HELD_OUT))
    # labels without a document of the table must not use up the bound
    there = named.groupBy("doc_id").agg(F.avg("label").alias("label")).join(
        docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = persist_table(there.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(MOST_LABELLED))
    one = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text_key", "text")  # MOST_LABELLED ids at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, int] = {}  # per id the smallest text hash this task has seen
        for b in batches:
            b = b.sort_values("text_key").drop_duplicates("doc_id")
            b = b[[key < best.get(i, key + 1) for i, key in zip(b["doc_id"], b["text_key"])]]
            best.update(zip(b["doc_id"], b["text_key"]))
            found = [terms(t) for t in b["text"]]
            yield b[["doc_id", "text_key", "label"]].assign(slots=[s for s, _ in found], weights=[w for _, w in found])

    rows = one.mapInPandas(run, "doc_id long, text_key long, label double, slots array<int>, weights array<float>")
    single = rows.groupBy("doc_id").agg(F.min_by(F.struct("label", "slots", "weights"), "text_key").alias("one"))
    return persist_table(single.select("doc_id", "one.*"))


def fit(sample: DataFrame) -> Voters | None:
    """Projection and labelled vectors of a bounded sample, computed in one task; None for an empty sample."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        slots, weights = list(rows["slots"]), list(rows["weights"])
        projection = subspace(slots, weights, DIMS)
        vectors = np.stack([latent(s, w, projection) for s, w in zip(slots, weights)])
        return pd.DataFrame({"dims": [projection.shape[1]], "projection": [projection.tobytes()], "vectors": [vectors.tobytes()],
                             "labels": [rows["label"].to_numpy(float).tobytes()]})

    found = sample.groupBy(F.lit(0).alias("all")).applyInPandas(run, "dims int, projection binary, vectors binary, labels binary").collect()
    if not found:
        return None
    r = found[0]
    return Voters(np.frombuffer(r["projection"], np.float32).reshape(TERMS, r["dims"]), np.frombuffer(r["vectors"], float).reshape(-1, r["dims"]),
                  np.frombuffer(r["labels"], float))


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, held_out, score, predicted for every row of ``docs``.

    ``labels`` (doc_id, ``label_col`` 0 or 1) is read only outside of the held-out class of ids
    (crc32 of the id as text, modulo 4, is 2). A text without terms (NULL, empty) or without a
    neighbour at a positive cosine gets the share of label 1 in the sample; without labels every
    score is 0. ``predicted`` is 1 from a score of 0.7 on, 0.7 included. Rows with a NULL id are
    scored and never held out; repeated rows get equal scores; among neighbours of equal
    similarity at the edge of the vote the choice follows the fixed order of the sample. Whole
    texts are read, very long ones in pieces. Runs jobs when called: a bounded sample is
    written down and a model is fitted on it.
    """
    docs = keyed(docs, id_col, text_col)
    voters = fit(labelled_sample(docs, labels, label_col))
    model = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = model.value
        for b in batches:
            scores = np.zeros(len(b))
            if known is not None and len(b):
                scores = known.vote(np.stack([latent(*terms(t), known.projection) for t in b["text"]]))
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_key": b["text_key"], "held_out": b["held_out"], "score": scores,
                                "predicted": (scores >= THRESHOLD).astype(np.int32)})

    rows = docs.select("doc_id", "text_key", "text", F.coalesce(_remainder("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"))
    return rows.mapInPandas(run, "doc_id long, text_key long, held_out boolean, score double, predicted int")
