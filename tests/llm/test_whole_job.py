"""Inputs of which an operator must use every row, position, word or language."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import common, language, language_model, rules, toxicity
from tidewater.llm import textkernel as K


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship_package(spark)


def test_language_model_learns_at_every_position(spark):
    texts = [" ".join(f"w{random.Random(k * 100 + i).randrange(300)}" for i in range(12)) for k in range(20)]
    training = spark.createDataFrame([(t,) for t in texts], "text string")
    vocabulary = language_model._vocabulary(language_model.word_counts(training), 1000)
    model = language_model._train(training, vocabulary, rounds=2)
    met = []
    for chunk in K.chunks(pa.array(texts)):
        tokens = language_model.Tokens(chunk)
        met.append(language_model.history(tokens, vocabulary.classes(tokens)))
    rows = np.unique(np.concatenate(met))
    assert np.abs(model.weights[rows]).max(1).min() > 0  # no context met in training keeps its first weights


def test_toxicity_of_words_toxic_only_together(spark):
    r = random.Random(1)
    rows, labels = [], []
    for k in range(1600):
        first, second = r.choice(["alpha", "bravo"]), r.choice(["xylem", "yield"])
        text = [first, second, *(f"w{r.randrange(1500)}" for _ in range(6))]
        r.shuffle(text)
        rows.append((k, " ".join(text)))
        labels.append((k, int((first == "alpha") == (second == "xylem"))))
    scored = toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = [x for x in scored.collect() if x.held_out]
    assert np.mean([x.predicted == labels[x.doc_id][1] for x in held]) > 0.95


def test_every_language_has_a_reference(spark):
    codes = [f"l{i:02d}" for i in range(70)]
    speech = lambda code, seed: " ".join(random.Random(seed * 1000 + i).choice("aeiou") + code + str(random.Random(seed * 999 + i).randrange(15)) for i in range(90 + int(code[1:])))
    rows = [(k * 100 + j, speech(code, k * 100 + j), code) for k, code in enumerate(codes) for j in range(14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    assert {i: judged[i].language for i, _, _ in rows} == {i: code for i, _, code in rows}
    assert language.text_models(docs).languages == codes
    pages = spark.createDataFrame([(k, None, f"<p>{speech(code, k)}</p>") for k, code in enumerate(codes)], "page_id long, url string, html string")
    assert {r.page_id: r.lang for r in language.identify(pages, docs).collect()} == dict(enumerate(codes))
