"""Held-out accuracy, offsets and awkward rows of the toxicity field."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import language_crf, toxicity

from . import frames

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = toxicity.score_toxicity(docs, labels).join(docs, "doc_id").join(labels, "doc_id", "left")
    return found.select("doc_id", "held_out", "score", "predicted", "spans", "text", "toxic").collect()


def test_toxicity_is_told_on_held_out_documents(scored):
    held = [r for r in scored if r.held_out and r.toxic is not None]
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert len(toxic) > 60
    assert np.mean([r.predicted for r in toxic]) > 0.9 and np.mean([r.predicted for r in clean]) < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)


def test_spans_are_words_in_code_points(scored):
    said = {}
    for r in scored:
        assert all(0 <= a.start < a.end <= len(r.text) and 0.5 <= a.score <= 1 for a in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
        for s in r.spans:
            word = r.text[s.start:s.end].lower()
            said[word] = said.get(word, 0) + 1
    often = sorted(said, key=said.get, reverse=True)[:8]
    assert {"idiot", "moron"} & set(often) and all(w.isalpha() for w in often)


def test_scores_are_repeatable_and_ignore_other_columns(spark, scored):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    other = docs.repartition(5).withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    again = {r.doc_id: r.score for r in toxicity.score_toxicity(other, labels.repartition(3)).collect()}
    assert again == pytest.approx({r.doc_id: r.score for r in scored}, abs=1e-6)


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (2, 0)], "doc_id long, toxic int")
    frame = frames.awkward(spark)
    found = toxicity.score_toxicity(frame, labels).collect()
    assert len(found) == 8 and all(0 <= r.score <= 1 and not r.spans for r in found)
    assert {r.score for r in toxicity.score_toxicity(frame, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(frames.docs(spark).limit(0), labels).count() == 0


def test_copies_of_one_text_mark_no_words(spark):
    """Words of a text that was copied are no evidence, those that many toxic texts have are; long and empty texts are scored too."""
    rare = " ".join(f"rare{i}" for i in range(40))
    data = [(i, rare if i % 2 else f"some plain words number {i % 97} here", i % 2) for i in range(1_200)]
    data += [(2_000 + i, f"you of house {i % 89} {'vile' if i % 2 else 'kind'}ling {i % 53} by {i % 31}", i % 2) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(9_000, None), (9_001, ""), (9_002, "plain words " * 40_000 + "vileling"), (9_003, rare)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    sample, _, _ = toxicity._sample(docs, labels, 8_000, 5, 0, "doc_id", "text", "toxic")
    marks = toxicity.find_marks(sample)
    low = np.frombuffer(f"vileling {rare}".encode(), np.uint8)
    hashes, _ = toxicity.affix_hashes(low, toxicity.tokens(low, np.array([len(low)])), toxicity.MARKS)
    assert hashes[0, 0] in marks and not np.isin(hashes[1:, 0], marks).any()
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in toxicity.score_toxicity(docs, labels).filter("doc_id >= 9000").collect()}
    assert spans == {9_000: [], 9_001: [], 9_002: [(480_000, 480_008)], 9_003: []}


def test_lanes_equal_steps():
    rng = np.random.default_rng(2)
    lengths = np.array([3, 0, 700, 1, 9_000, 0, 64, 63, 65])
    scores = rng.normal(size=lengths.sum()) * 3
    model = toxicity.Model(None, rng.normal(size=(2, 2)), rng.normal(size=2), None)
    both = np.stack((np.zeros(len(scores)), scores), axis=1)
    expected, _, _ = language_crf.forward_backward(both, lengths, model.transitions, model.start)
    assert np.allclose(1 / (1 + np.exp(-toxicity.log_odds(scores, lengths, model))), expected[:, 1], atol=1e-5)
