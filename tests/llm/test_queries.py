"""Registered queries against their SQL, and every stage of the pipeline against a plain version."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterwatch.llm import toxicity
from meterwatch.llm.queries import ORACLES, QUERIES, tokenizer_path
from meterwatch.llm.token_count import load_tokenizer
from tests.compare import differences
from tests.conftest import SF_DIR
from tests.llm import brute


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, key):
    assert differences(con, QUERIES[key](spark, SF_DIR), ORACLES[key]) == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, key):
    assert QUERIES[key](spark, SF_DIR).count() > 0


def test_names():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(None, "a row without an id", "en", "s", 19), (10**6, None, None, None, None)], docs.schema)
    docs = docs.unionByName(odd)
    rows = lambda df: {(r["doc_id"], r["text"]) for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]

    scores = {(r["doc_id"], r["text_key"]): r["predicted"] for r in toxicity.score_toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()}
    keyed = docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    kept = stages["toxicity"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert rows(kept) == {(r["doc_id"], r["text"]) for r in keyed if scores[(r["doc_id"], r["text_key"])] == 0}

    cut = stages["line_dedup"](spark, kept, SF_DIR)
    plain = brute.lines([r for r in rows(kept) if r[0] is not None], 10)
    assert {(i, t or "") for i, t in rows(cut) if i is not None} == {(i, t) for i, (_, _, t) in plain.items()}
    assert cut.columns == docs.columns and cut.filter("text is not null and n_chars <> char_length(text)").count() == 0

    single = stages["near_dedup"](spark, cut, SF_DIR)
    groups = brute.near([r for r in rows(cut) if r[0] is not None], 5, 80)
    assert {i for i, _ in rows(single) if i is not None} == {i for i, (_, c) in groups.items() if c == i}

    clean = stages["decontamination"](spark, single, SF_DIR)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute.leaks([r for r in rows(single) if r[0] is not None], items, 10)
    assert {i for i, _ in rows(clean) if i is not None} == {i for i, (_, hit, _) in found.items() if not hit}
    assert (None, "a row without an id") in rows(clean)

    library = load_tokenizer(tokenizer_path("word_bpe_49k.json"))
    texts = dict(rows(clean))
    for r in stages["bpe"](spark, clean, SF_DIR).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_repeated_rows_become_one(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 11)] * 3 + [(2, "a b c d e f", "en", "s", 11)], schema)
    assert dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF_DIR).count() == 1


def test_rows_without_an_id_are_judged(spark, tmp_path):
    """Toxic and leaked rows with a NULL id go, clean ones stay, also if their texts repeat."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    passage = " ".join(f"item{k}" for k in range(12))
    words = [f"{w}{k}" for k in range(40) for w in ("ab", "cd")]
    rows = [(k, " ".join([words[(7 * k + j) % 80] for j in range(30)] + ["vilely rotter"] * (k % 3 == 0)), "en", "s", k) for k in range(600)]
    toxic, clean, leaked = " ".join(words[:30] + ["vilely rotter"] * 3), " ".join(words[3:33]), f"so {passage} it is"
    odd = [(None, t, "en", "s", 1) for t in (toxic, clean, clean, leaked, None, "")] + [(9_000, leaked, "en", "s", 1)]
    docs = spark.createDataFrame(rows + odd, schema)
    spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(400)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = lambda df: sorted(r["text"] or "" for r in df.filter("doc_id is null").collect())
    assert texts(stages["toxicity"](spark, docs, str(tmp_path))) == sorted([clean, clean, leaked, "", ""])
    assert texts(stages["near_dedup"](spark, docs, str(tmp_path))) == sorted([toxic, clean, clean, leaked, "", ""])
    kept = stages["decontamination"](spark, docs, str(tmp_path))
    assert texts(kept) == sorted([toxic, clean, clean, "", ""]) and kept.filter("doc_id = 9000").count() == 0


def test_survivor_of_repeated_rows_is_ordered(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "a b c d e f", "en", s, 11) for s in ("z", "b", "y", "c")]
    for given in (rows, rows[::-1]):
        kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, spark.createDataFrame(given, schema).repartition(4), SF_DIR).collect()
        assert [tuple(r) for r in kept] == [(1, "a b c d e f", "en", "b", 11)]


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
