"""Fill-in-middle, whitening and the quality vote on small tables with every odd case."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterwatch.llm import fim, quality, whitening
from meterwatch.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm.test_ops import SCHEMA, corpus


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def data():
    marked = ["a\n<P>b\nc", "<", "<S", "x\n<M", "\n", "\n\n\n", "a\n", "\na", "one\ntwo\nthree\n", "é\n東京\n<P\n>\nS>\n<", "\r\n\x0b\x85 end"]
    long = [("line %d of a long text\n" % k) * 3 for k in range(20_000)]
    return [*corpus(), *enumerate([*marked, "".join(long)], start=1000)]


@pytest.fixture(scope="module")
def docs(spark, data):
    rows = [(i, t, "en", "w", 1, 2, "k") for i, t in data]
    odd = [(None, "a\nb\nc\n", None, None, None, None, None), (None, None, None, None, None, None, None), rows[5], rows[-2]]
    return spark.createDataFrame(rows + odd, SCHEMA).repartition(5)


# --- fill-in-middle ---------------------------------------------------------

def plain_fim(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0), (0, 50), (100, 100)])
def test_fim(spark, docs, data, rate, spm):
    found = fim.fill_in_middle(docs, 7, rate, spm).withColumn("back", fim.restored())
    texts = {named(i, t): t for i, t in [*data, (None, "a\nb\nc\n"), (None, None)]}
    rows = found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()
    assert len(rows) == len(data) + 4
    for r in rows:
        text = texts[named(r["doc_id"], r["back"])] or ""
        assert r["back"] == text
        assert tuple(r)[1:6] == plain_fim(r["doc_id"], text, 7, rate, spm)
    assert rate in (0, 60) or {r["form"] for r in rows} == {"plain", "spm" if spm == 100 else "psm", *(["spm"] if spm else [])}


def named(doc_id, text):
    return doc_id, sha(text or "")


def test_fim_slices(spark, docs, monkeypatch):
    """Small slices give the same rows as one."""
    whole = sorted(map(tuple, fim.fim_digest(docs).collect()), key=str)
    batch = next(iter(fim._slices(pa.RecordBatch.from_pydict({"text": ["a", "", "b" * 9]}))))
    assert batch.num_rows == 3
    monkeypatch.setattr(fim, "SLICE_BYTES", 4)
    parts = list(fim._slices(pa.RecordBatch.from_pydict({"text": ["aa", "", "b" * 9, "", "cc", "dd"]})))
    assert [p.num_rows for p in parts] == [2, 1, 3]
    assert sorted(map(tuple, fim.fim_digest(docs).collect()), key=str) == whole


def test_fim_empty_and_wrong_marks(spark, docs):
    assert fim.fim_digest(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, marks=("<P>", "<P>", "<M>"))
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, marks=("<P>", "S", "<M>"))
    own = fim.fill_in_middle(docs, marks=("<pre>", "<suf>", "<mid>"))
    back = own.select("output", fim.restored(marks=("<pre>", "<suf>", "<mid>")).alias("back"), "form").filter("form <> 'plain'")
    assert back.filter(F.length("output") != F.length("back") + 15).count() == 0


# --- whitening --------------------------------------------------------------

def plain_whitening(rows, components=16):
    """{row number: [(deviation, whitened)]}, n, explained with numpy's solver and Python's whole numbers."""
    usable = {k: v for k, v in enumerate(rows) if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)}
    x = {k: [int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v] for k, v in usable.items()}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = lambda v: np.array([(n * c - s) / n for c, s in zip(v, sums)])
    c = np.array([centred(v) for v in fit])
    cov = c.T @ c / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components].T
    deviation = {k: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for k, v in x.items()}
    return {k: (deviation[k], centred(v) @ vectors.T / np.sqrt(values)) for k, v in x.items()}, n, values / np.trace(cov)


def check_whitening(found, rows, components=16, atol=1e-7):
    plain, n, explained = plain_whitening(rows, components)
    table = {}
    for r in found.collect():
        table.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(table) == set(plain)
    signs = None
    for k, parts in table.items():
        assert sorted(parts) == list(range(1, len(explained) + 1))
        got = np.array([parts[j]["whitened"] for j in sorted(parts)])
        if signs is None and np.abs(plain[k][1]).min() > 1e-3:
            signs = np.sign(got * plain[k][1])
        r = parts[1]
        assert r["n"] == n and r["deviation"] == plain[k][0]
        assert np.allclose([parts[j]["explained"] for j in sorted(parts)], explained, rtol=1e-9)
        assert r["identity_error"] < 1e-6
    for k, parts in table.items():
        assert np.allclose(np.array([parts[j]["whitened"] for j in sorted(parts)]) * signs, plain[k][1], atol=atol), k


def test_whitening_query(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    found = QUERIES["op11_whitening"](spark, SF_DIR)
    table = {r["vec_id"]: r["embedding"] for r in vectors.collect()}
    rows = [table.get(k) for k in range(max(table) + 1)]
    check_whitening(found, rows)


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [list(map(float, rng.normal(size=5) * [5, 3, 2, 1, 0.5])) for _ in range(300)]
    rows += [rows[7]] * 400 + [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [1.0, float("inf"), 0.0, 0.0, 0.0], [0.0] * 5, [1e3, 0.0, 0.0, 0.0, 0.0]]
    odd = [(900 + k, [1.0, 2.0], 3) for k in range(5)]  # another length than most
    df = spark.createDataFrame([(k, v, 1) for k, v in enumerate(rows)] + odd, "vec_id long, embedding array<double>, component int").repartition(7)
    check_whitening(whitening.whiten(df), rows, atol=1e-6)
    assert whitening.whiten(df, 2).select("component").distinct().count() == 2
    nulls = spark.createDataFrame([(None, rows[0]), (None, rows[0])], "vec_id long, embedding array<double>").unionByName(df.select("vec_id", "embedding"))
    assert whitening.whiten(nulls).filter("vec_id is null").count() == 10
    assert whitening.whiten(df.limit(0)).count() == 0
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(9)], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0  # no spread, no component
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 1.0]) for k in range(9)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}


def test_whitening_far_entries(spark):
    """Entries beyond what a long holds stop at the edge; a deviation that no long holds is NULL, others stay exact."""
    rows = [[float(k), 0.0] for k in range(20)] + [[1e300, 1.0], [-1e300, 1.0], [1e9, 2.0]]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    found = whitening.whiten(df).collect()
    assert {r["vec_id"] for r in found} == set(range(23)) and all(r["deviation"] is None for r in found if r["vec_id"] in (20, 21))
    jvm = df.select(whitening.grid(F.col("embedding")).alias("x")).collect()
    assert [list(r["x"]) for r in jvm] == whitening._grid(np.array(rows)).tolist()
    centre = whitening.Centre(3, [10, 10 ** 19, 5])
    x = np.array([[3, 3 * 10 ** 18, 1], [4, 4 * 10 ** 18, 2], [10 ** 6, 3333333333333333333, 1]])
    exact = [sum((3 * v - s) ** 2 for v, s in zip(row, centre.sums)) for row in x.tolist()]
    assert centre.deviation(x) == [e if e < 2 ** 63 else None for e in exact] and exact[2] < 2 ** 63


@pytest.mark.parametrize("spectrum", [[5, 4, 3, 2, 1], [3, 3, 3, 1, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0], [7, 0, 0, 0, 0], [1, 1, 1, 1, 1],
                                      [1e12, 1, 1e-3, 0, 0], list(range(40, 0, -1))])
def test_leading_eigenpairs(spectrum):
    rng = np.random.default_rng(len(spectrum))
    q = np.linalg.qr(rng.normal(size=(len(spectrum),) * 2))[0]
    matrix = (q * np.array(spectrum, float)) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, axes = whitening.leading_eigenpairs(matrix, 16)
    want = [s for s in spectrum if s > 1e-13 * sum(spectrum)][:16]
    assert np.allclose(values, want, rtol=1e-10, atol=1e-12 * max(spectrum))
    assert np.allclose(axes @ axes.T, np.eye(len(values)), atol=1e-10)
    assert np.abs(matrix @ axes.T - axes.T * values).max() < 1e-12 * max(spectrum) * len(spectrum)


def test_count_above():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 8, 30):
        a = rng.normal(size=(size, size))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        for shift in [*rng.normal(size=10) * 3, *(e[:-1] + e[1:]) / 2, 1e9, -1e9]:
            assert whitening.count_above(a, shift) == (e > shift).sum()
    assert whitening.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1 and whitening.count_above(np.zeros((3, 3)), 0.0) == 0


# --- quality ----------------------------------------------------------------

def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def plain_vote(voters, text):
    """One text after the other, all cosines sorted."""
    v = quality.latent(*quality.terms(text or ""), voters.projection)
    cosine = [round(float(v @ w), 9) for w in voters.vectors]
    near = sorted(range(len(cosine)), key=lambda k: -cosine[k])[:quality.NEIGHBOURS]
    weight = [max(0.0, cosine[k]) ** quality.POWER for k in near]
    return sum(w * voters.labels[k] for w, k in zip(weight, near)) / sum(weight) if sum(weight) > 0 else voters.labels.mean()


def test_quality_terms():
    slots, weights = quality.terms("The the THE the the")
    assert np.isclose((weights.astype(float) ** 2).sum(), 1) and quality.TERMS - 1 in slots
    assert all(len(a) == 0 for a in quality.terms(""))
    text = "Some words. " * 60_000  # longer than a piece, which must not change the counts
    data = np.frombuffer(text.encode(), np.uint8)
    counts = quality._groups(data, 3, quality.BYTE_BITS)
    assert counts.sum() == len(data) - 2 and counts.max() >= 59_999
    assert quality._groups(data[:2], 3, 4).sum() == 0


def test_quality_subspace():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 50)) + 1e-3 * rng.normal(size=(300, 50))
    found = quality.subspace([np.arange(50)] * 300, list(a), 3, 50).astype(float)
    want = np.linalg.svd(a)[2][:3].T
    assert np.abs(np.linalg.svd(found.T @ want)[1] - 1).max() < 1e-5


def test_quality_query(spark):
    """Every row of the given table is what a plain vote says, and the held-out labels are met."""
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    voters = quality.fit(quality.labelled_sample(quality.keyed(docs), labels, "quality"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = {r["doc_id"]: r for r in QUERIES["op12_quality"](spark, SF_DIR.replace("0.001", "0.01")).collect()}
    assert set(found) == set(texts)
    near_edge = 0
    for i, r in found.items():
        assert r["held_out"] == held(i) and r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1
        near_edge += abs(r["score"] - plain_vote(voters, texts[i])) > 1e-6
    assert near_edge <= 3  # ties at the last neighbour
    marks = {r["doc_id"]: r["quality"] for r in labels.collect() if held(r["doc_id"])}
    low = [i for i, q in marks.items() if q == 0]
    assert sum(found[i]["predicted"] == 0 for i in low) >= 0.8 * len(low)
    assert sum(found[i]["predicted"] == 1 for i in marks if marks[i] == 1) >= 0.97 * (len(marks) - len(low))


def test_quality_odd_rows(spark, docs, data):
    labels = spark.createDataFrame([(i, int(k % 3 > 0), "x") for k, (i, _) in enumerate(data)] * 2 + [(None, 1, "x"), (3, None, "x"), (10**7, 0, "x")],
                                   "doc_id long, quality int, text string")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == len(data) + 4
    seen = {}
    for r in rows:
        assert 0 <= r["score"] <= 1 and seen.setdefault((r["doc_id"], r["text_key"]), r["score"]) == r["score"]
        assert r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"]))
    empty = [r["score"] for r in rows if r["doc_id"] == 3 or r["doc_id"] == 4]
    used = [int(k % 3 > 0) for k, (i, _) in enumerate(data) if not held(i)]
    assert np.allclose(empty, np.mean(used))
    none = quality.score_quality(docs, labels.limit(0))
    assert {(r["score"], r["predicted"]) for r in none.collect()} == {(0.0, 0)}
    assert quality.score_quality(docs.limit(0), labels).count() == 0


def test_quality_repeated_row_and_edge(spark):
    """A labelled row that repeats a thousand times counts once; a score of exactly the threshold predicts 1."""
    rows = [(1, "one two three")] * 1_000 + [(k, f"text number {k} of its own") for k in range(2, 40)] + [(1, "a different text of the same id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 40)] + [(2, 1)], "doc_id long, quality int")
    sample = quality.labelled_sample(quality.keyed(df), labels, "quality").collect()
    ids = [r["doc_id"] for r in sample]
    assert len(ids) == len(set(ids)) and set(ids) == {k for k in range(1, 40) if not held(k)}
    assert [r["label"] for r in sample if r["doc_id"] == 2] in ([0.5], [])
    voters = quality.Voters(np.eye(2, dtype=np.float32), np.array([[1.0, 0.0]] * 10), np.array([1.0] * 7 + [0.0] * 3))
    assert (voters.vote(np.array([[1.0, 0.0], [0.0, 0.0]])) >= quality.THRESHOLD - 1e-12).all()
