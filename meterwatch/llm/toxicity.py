"""Toxicity by non-negative positive-unlabelled learning.

Known positives are the confirmed toxic examples; everything else is unlabelled text, among
which toxic documents hide with the share ``prior``. Texts are sets of hashed words and
letter groups. A few classifiers are trained in numpy, one per task, each on its own part of a
bounded sample. The other parts give it markers: groups that are significantly more
frequent in toxic texts than in clean ones, whose frequency is that of the unlabelled texts
less the share of the toxic ones. On what the markers say of its own part, the classifier
minimises the class-prior-corrected risk

    prior * R+(toxic) + max(0, R-(unlabelled) - prior * R-(toxic)),

and where the second part would become negative, the step goes the other way. The mean of the
classifiers scores every document of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import keyed, persist_table

#: Size of the feature space; letters of a group.
SLOTS, GROUP = 1 << 18, 5
#: Bounds of the sample that classifiers are trained on, and their number.
MOST_POSITIVE, MOST_UNLABELLED, MEMBERS = 3_000, 9_000, 3
#: Deviations by which a marker must exceed its frequency in clean texts.
SIGNIFICANT = 4.0
#: Gradient steps, their size, and the weight that keeps coefficients small.
STEPS, RATE, SHRINK = 600, 0.05, 1e-4
#: Words of which a task remembers the slots.
REMEMBERED = 150_000
#: Every ``HELD_OUT``-th hash class of ids gives no label.
HELD_OUT = 5

_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_KNOWN: dict[bytes, np.ndarray] = {}


def word_slots(word: bytes) -> np.ndarray:
    """Slots of a word and of its groups of letters, its beginning marked."""
    text = "^" + word.decode("utf-8", "replace")
    groups = {text, *(text[i:i + GROUP] for i in range(max(1, len(text) - GROUP + 1)))}
    return np.array(sorted({zlib.crc32(g.encode("utf-8")) % SLOTS for g in groups}), np.int32)


def features(text: str) -> np.ndarray:
    """Distinct slots of a whole text; none without words."""
    words = set(text.encode("utf-8", "surrogatepass").translate(_SPLIT).split())
    if not words:
        return np.zeros(0, np.int32)
    if len(_KNOWN) > REMEMBERED:
        _KNOWN.clear()
    found = []
    for w in words:
        slots = _KNOWN.get(w)
        if slots is None:
            slots = _KNOWN[w] = word_slots(w)
        found.append(slots)
    return np.unique(np.concatenate(found))


def marker_weights(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Log ratios of the slots that mark toxic texts, 0 elsewhere."""
    p, u = max(1, len(positive)), max(1, len(unlabelled))
    count = lambda rows: np.bincount(np.concatenate([*rows, np.zeros(0, np.int32)]), minlength=SLOTS)
    in_p, in_u = count(positive), count(unlabelled)
    clean = np.maximum(in_u / u - prior * in_p / p, 0) / (1 - prior)
    significant = (in_p - p * clean) / np.sqrt(p * clean + 1) > SIGNIFICANT
    ratio = np.log((in_p / p + 1 / p) / (clean + 1 / p))
    return np.where(significant & (ratio > 0), ratio, 0.0)


def summary(slots: np.ndarray, weights: np.ndarray) -> tuple[float, float, float, float]:
    """What a classifier sees of a text: a constant, all its markers, its strongest one, its size."""
    found = weights[slots]
    return 1.0, float(np.log1p(found.sum())), float(found.max(initial=0.0)), float(np.log1p(len(slots)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Coefficients that minimise the non-negative risk (logistic loss, moment-scaled steps).

    Steps away from a negative risk make the path swing, so the best point of it is taken.
    """
    w = np.zeros(positive.shape[1])
    mean, square = np.zeros_like(w), np.zeros_like(w)
    best, lowest = w, np.inf
    for t in range(1, STEPS + 1):
        zp, zu = positive @ w, unlabelled @ w
        clean_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        risk = prior * np.logaddexp(0, -zp).mean() + max(0.0, clean_risk) + SHRINK * (w * w).sum()
        if risk < lowest:
            best, lowest = w, risk
        of_clean = unlabelled.T @ _sigmoid(zu) / len(zu) - prior * (positive.T @ _sigmoid(zp)) / len(zp)
        step = -prior * (positive.T @ _sigmoid(-zp)) / len(zp) + of_clean if clean_risk >= 0 else -of_clean
        step = step + 2 * SHRINK * w
        mean, square = 0.9 * mean + 0.1 * step, 0.999 * square + 0.001 * step * step
        w = w - RATE * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.999 ** t)) + 1e-8)
    return best


def _remainder(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(HELD_OUT))


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str) -> tuple[DataFrame, float]:
    """(kind, part, slots) of the sampled rows, written down, and the share of toxic labels.

    Only rows outside of the held-out class are read; of them the first ones by a
    hash of the id, ``MOST_POSITIVE`` toxic and ``MOST_UNLABELLED`` of any kind. Of rows
    that repeat an id, one is learned from: the one with the smallest hash of the text.
    """
    order = F.xxhash64("doc_id", F.lit(3))
    open_labels = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).alias("label")).filter(
        F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (_remainder("doc_id") != 0))
    share = open_labels.agg(F.avg((F.col("label") == 1).cast("double"))).first()[0]
    positive = open_labels.filter("label = 1").select("doc_id").distinct().orderBy(order, "doc_id").limit(MOST_POSITIVE)
    any_text = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & (_remainder("doc_id") != 0)).distinct().orderBy(
        order, "doc_id").limit(MOST_UNLABELLED)
    chosen = positive.withColumn("kind", F.lit(1)).unionByName(any_text.withColumn("kind", F.lit(0)))
    chosen = chosen.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MEMBERS)).cast("int"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[["kind", "part", "doc_id"]].assign(slots=[features(t) for t in b["text"]])

    # at most MOST_POSITIVE + MOST_UNLABELLED ids, and one text of each, however many rows repeat it
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("kind", "part", "doc_id").agg(
        F.min(F.struct("text_key", "text")).alias("first")).select("kind", "part", "doc_id", "first.text")
    return persist_table(rows.mapInPandas(run, "kind int, part int, doc_id long, slots array<int>")), share


def train(sample: DataFrame, prior: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each classifier: its marker slots, their weights and its coefficients."""
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        member = int(group["member"].iloc[0])
        group = group.sort_values(["doc_id", "kind"])
        own = (group["part"] == member).to_numpy()
        toxic = (group["kind"] == 1).to_numpy()
        pick = lambda mask: list(group["slots"].to_numpy()[mask])
        weights = marker_weights(pick(toxic & ~own), pick(~toxic & ~own), prior)
        seen = lambda mask: np.array([summary(s, weights) for s in pick(mask)])
        if not (toxic & own).any() or not (~toxic & own).any():
            return pd.DataFrame({"member": [], "slots": [], "weights": [], "coefficients": []})
        slots = np.flatnonzero(weights)
        return pd.DataFrame({"member": [member], "slots": [slots.astype(np.int32)], "weights": [weights[slots]],
                             "coefficients": [fit_nnpu(seen(toxic & own), seen(~toxic & own), prior)]})

    members = sample.withColumn("member", F.explode(F.array(*[F.lit(k) for k in range(MEMBERS)])))
    fitted = members.groupBy("member").applyInPandas(fit, "member int, slots array<int>, weights array<double>, coefficients array<double>")
    return [(np.array(r["slots"], np.int64), np.array(r["weights"]), np.array(r["coefficients"])) for r in fitted.orderBy("member").collect()]


def score_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, text_key, held_out, score, predicted for every row of ``docs``.

    ``labels`` (doc_id, ``label_col`` 0 or 1) is read only outside of the held-out
    class of ids (crc32 of the id as text, modulo 5, is 0); only toxic labels and
    their share are used. A text without words, a NULL id or a repeated row is
    scored like any other. Without toxic labels every score is 0. The score is the
    mean of the classifiers' probabilities; 0.5 or more predicts 1. Runs jobs when
    called: a bounded sample is written and classifiers are trained on it.
    """
    docs = keyed(docs, id_col, text_col)
    sample, share = training_sample(docs, labels, label_col)
    prior = min(0.9, share or 0.0)
    model = docs.sparkSession.sparkContext.broadcast(train(sample, prior) if prior > 0 else [])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        members = []
        for slots, weights, coefficients in model.value:
            full = np.zeros(SLOTS)
            full[slots] = weights
            members.append((full, coefficients))
        for b in batches:
            scores = np.zeros(len(b))
            for k, text in enumerate(b["text"]):
                found = features(text)
                if members:
                    scores[k] = np.mean([_sigmoid(np.dot(summary(found, full), c)) for full, c in members])
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_key": b["text_key"], "held_out": b["held_out"], "score": scores,
                                "predicted": (scores >= 0.5).astype(np.int32)})

    rows = docs.select("doc_id", "text_key", "text", F.coalesce(_remainder("doc_id") == 0, F.lit(False)).alias("held_out"))
    return rows.mapInPandas(score, "doc_id long, text_key long, held_out boolean, score double, predicted int")
