import json

import pytest

import corpus_pipeline
from __spark_entry__ import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = [docs]
    for _, apply in corpus_pipeline.STAGES[:-1]:
        seen.append(corpus_pipeline.stage(apply(spark, seen[-1], SF_DIR)))
    return seen


def test_stages_are_the_five_in_order_and_keep_the_columns(staged):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "tokens"]
    assert all(frame.columns == staged[0].columns for frame in staged)


def rows_of(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_each_stage_decides_as_its_operator(spark, staged):
    from stayline.llm import mixing, ngram_join, pii, toxicity

    raw, clean, unique, masked, mix = staged
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxicity.score_documents(raw, labels).collect()
    assert set(rows_of(clean)) == {r.doc_id for r in scored if not r.predicted}
    joined = ngram_join.join(clean).collect()
    assert set(rows_of(unique)) == {r.doc_id for r in joined if r.kept} and unique.count() == sum(r.kept for r in joined)
    before, after = rows_of(unique), rows_of(masked)
    assert before.keys() == after.keys()
    for key, r in after.items():
        text = before[key].text
        assert r.text == (pii.masked(text, pii.base_spans(text)) if text else text) and r.n_chars == len(r.text)
    levels = masked.withColumn("domain", corpus_pipeline.domain_of())
    copies = {r.doc_id: r.copies for r in mixing.copies(levels, corpus_pipeline.MIX).collect()}
    counts = {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert counts == {k: c for k, c in copies.items() if c}


def test_run_gives_a_row_per_row_of_the_mix(spark, staged):
    got = queries()["pipeline"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in staged[-1].select("doc_id").collect())
    assert json.dumps(corpus_pipeline.ORACLE_SQL) == "null"

CASES = "doc_id long, text string, lang string, source string, n_chars int, domain string, `__copy` string, doc string, tokens string, extra string"


def chained(spark, rows):
    docs = spark.createDataFrame([(*r, "m", "c", "d", "t", "e") for r in rows], CASES)
    columns = docs.columns
    for _, apply in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(apply(spark, docs, SF_DIR))
        assert docs.columns == columns
        assert all(tuple(r)[5:] == ("m", "c", "d", "t", "e") for r in docs.collect())
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)


def test_nulls_repeats_long_texts_and_other_columns_in_the_chain(spark):
    long = " ".join(f"word{k}" for k in range(60_000))
    rows = [(None, None, None, None, None), (1, "", "en", "src0", 0), (2, "one two three four five six", "en", "src1", 27)]
    rows += [rows[2], (3, long, None, "src0", len(long)), (4, "write to a.b@c.org now or never again", None, None, None)]
    docs, tokens = chained(spark, rows)
    assert tokens.count() == docs.count() <= 4 * len(rows)
    assert not any("a.b@c.org" in (r.text or "") for r in docs.collect())


def test_an_empty_table_in_the_chain(spark):
    docs, tokens = chained(spark, [])
    assert docs.count() == tokens.count() == 0
