import random
import zlib

import pytest

from stayline.llm import toxicity

DOCS = "doc_id long, text string, toxic int, score double"


def corpus(n=700):
    rng = random.Random(9)
    words = [a + b for a in ("ka", "lo", "mi", "tu", "re") for b in ("ran", "sel", "dor", "vin", "pol", "gat")]
    endings = ["a", "o", "en", "ix", "um", "est", "ara", "ion"]
    docs, labels = [], []
    for k in range(n):
        bad = rng.random() < 0.25
        parts = [" ".join(rng.choices(words, k=rng.randint(3, 12))) for _ in range(rng.randint(1, 12))]
        if bad:
            at = rng.randrange(len(parts))
            parts[at] += rng.choice([" nasty", " vilebad" + rng.choice(endings), " Nasty,"]) + " " + rng.choice(words)
        docs.append((k, ". ".join(parts) + ".", 5, 0.5))
        if k % 5 or k > 400:
            labels.append((k, int(bad)))
    return docs, labels, {k: v for k, v in labels}


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels, truth = corpus()
    docs += [(9001, None, 5, 0.5), (9002, "", 5, 0.5), (9003, "?! ...", 5, 0.5), (None, "nasty you are", 5, 0.5), (9004, docs[1][1], 5, 0.5)]
    docs += [(9005, "nasty word " + "karan losel midor. " * 20_000, 5, 0.5)]
    told = spark.createDataFrame([*labels, (9001, None), (None, 1), labels[0]], "doc_id long, toxic int")
    frame = spark.createDataFrame(docs, DOCS)
    return docs, truth, frame, told, {r.doc_id: r for r in toxicity.score_documents(frame, told).collect()}


def test_held_out_accuracy(scored):
    _, truth, _, _, got = scored
    held = [k for k in truth if got[k].held_out]
    assert len(held) > 80 and all((zlib.crc32(str(k).encode()) % 5 == 0) == got[k].held_out for k in truth)
    assert sum(got[k].predicted == truth[k] for k in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_defined_results(scored):
    docs, _, _, _, got = scored
    assert got[9001].score == got[9002].score == got[9003].score == 0
    assert got[None].predicted == 1 and got[9004].score == got[1].score and len(got) == len(docs)
    assert got[9005].predicted == 1


def test_labels_of_the_held_out_fifth_are_not_read(spark, scored):
    _, truth, frame, told, got = scored
    turned = told.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) toxic")
    assert {r.doc_id: r.score for r in toxicity.score_documents(frame, turned).collect()} == {k: r.score for k, r in got.items()}


def test_offending_sentences_are_located(spark, scored):
    _, _, frame, told, _ = scored
    model = toxicity.train(frame, told)
    text = "karan losel. You are nasty midor! Retun pol"
    row = spark.createDataFrame([(text,)], "text string").select(toxicity.offending_column(model)("text").alias("o")).first()
    assert [text[s.start : s.end] for s in row.o] == [" You are nasty midor"]


def test_filter_keeps_columns_and_clean_rows(scored):
    docs, _, frame, told, got = scored
    kept = toxicity.without_toxic(frame, told)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(k for k, r in got.items() if r.score < 0.5)


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text", 1, 0.0)], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, none).first().predicted == 0
    assert toxicity.score_documents(docs.limit(0), none).count() == 0
    one_sided = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, one_sided).first().predicted == 0


def test_scores_equal_a_plain_noisy_or():
    import math
    import re

    model = toxicity.Model(-6.0, {"nasty": 7.0, "vile-": 4.0, "karan": 0.2})
    scorer = toxicity.Scorer(model)
    rng = random.Random(4)
    for _ in range(300):
        words = rng.choices(["karan", "losel", "nasty", "vilebad", "Nasty", "tu"], weights=[4, 9, 1, 1, 1, 4], k=rng.randrange(0, 40))
        text = "".join(w + rng.choice([" ", " ", ". ", "! ", "\n"]) for w in words)
        clean = 1.0
        for part in re.split(r"[.!?\n]", text):
            told = {f for w in re.findall(r"\w+", part.lower()) for f in toxicity.features(w)}
            if re.search(r"\w", part):
                odds = model.bias + sum(model.weights.get(f, 0.0) for f in told)
                clean *= (1 + math.exp(model.bias)) / (1 + math.exp(odds))
        assert scorer.score(text) == pytest.approx(1 - clean, abs=1e-12)


def test_length_alone_makes_no_text_toxic():
    scorer = toxicity.Scorer(toxicity.Model(-6.55, {"nasty": 9.0}))
    one, many = "karan losel midor. ", "karan losel midor. " * 5_000
    assert scorer.score(one) == scorer.score(many) == 0
    assert scorer.score(one + "You nasty one. ") == pytest.approx(scorer.score(many + "You nasty one. "))
    assert scorer.score(one + "You nasty one. ") > 0.9


def test_one_long_text_leaves_the_others_in_the_sample(spark, scored):
    _, truth, frame, told, got = scored
    long = spark.createDataFrame([(10_001, "karan losel midor. " * 3_000_000, 5, 0.5)], DOCS)
    labels = told.unionByName(spark.createDataFrame([(10_001, 0)], "doc_id long, toxic int"))
    sample = toxicity.training_sample(frame.unionByName(long), labels)
    assert sample.count() == toxicity.training_sample(frame, told).count()
    model = toxicity.train(frame.unionByName(long), labels)
    scorer = toxicity.Scorer(model)
    texts = {r.doc_id: r.text for r in frame.collect()}
    toxic = [k for k, v in truth.items() if v]
    assert sum(scorer.score(texts[k]) >= 0.5 for k in toxic) >= 0.95 * len(toxic)
    with pytest.raises(ValueError, match="fits"):
        toxicity.train(frame, told, toxicity.Fit(chars=3))
