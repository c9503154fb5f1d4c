import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeline.llm import language_crf, mixture, quality_model
from gaugeline.llm.queries import ORACLES, QUERIES

from . import brute, frames

FOLDER = "/root/testdata/sf0.01"


def test_quality_is_told_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = quality_model.score_quality(spark.read.parquet(f"{FOLDER}/documents.parquet"), labels)
    rows = scored.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    good = np.mean([r.predicted == r.quality for r in held])
    assert len(held) > 40 and good > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_scores_are_repeatable_and_ignore_other_columns(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    one = {r.doc_id: r.score for r in quality_model.score_quality(docs, labels).collect()}
    other = docs.repartition(7).withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    two = {r.doc_id: r.score for r in quality_model.score_quality(other, labels).collect()}
    assert one == pytest.approx(two, abs=1e-6)


def test_word_vectors_have_the_contexts_of_all_documents(spark):
    texts = [None, "", "one", "a b c a b", " a  c\n"] + [f"rare{i} word{i % 7} next{i % 3}" for i in range(3_000)]
    index = quality_model.index_signs().astype(np.int64)
    sums = np.zeros_like(index)
    for text in texts:
        own = [int(quality_model.word_rows(np.frombuffer(w.encode(), np.uint8), np.array([len(w)]))[0][0]) for w in (text or "").split()]
        for i, row in enumerate(own):
            for j in range(max(0, i - 2), min(len(own), i + 3)):
                sums[row] += index[own[j]] * (0, 2, 1)[abs(i - j)]
    expected = index / np.sqrt(quality_model.SIGNS) + sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-6)
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    first = quality_model.context_vectors(frame.repartition(5))
    assert np.allclose(first, expected, atol=1e-5) and (first == quality_model.context_vectors(frame.repartition(2))).all()


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (2, 0)], "doc_id long, quality int")
    frame = frames.awkward(spark)
    assert quality_model.score_quality(frame, labels).filter("score BETWEEN 0 AND 1").count() == 8
    same = quality_model.score_quality(frame, labels.limit(0))
    assert {r.score for r in same.collect()} == {0.5}
    assert quality_model.keep_quality(frame, labels.limit(0)).columns == frame.columns
    assert quality_model.score_quality(frames.docs(spark).limit(0), labels).count() == 0


def test_language_is_told_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = language_crf.identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 150 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_language_of_awkward_rows(spark):
    out = language_crf.identify_language(frames.awkward(spark)).collect()
    assert len(out) == 8 and {r.lang_pred for r in out if r.score == 0} == {"und"}
    only_digits = spark.createDataFrame([(1, "1 2 3", "en"), (2, "abc def", "en"), (3, "abc xyz", "en"), (4, "ab c", "en")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in language_crf.identify_language(only_digits).collect()}[1] == "und"
    assert language_crf.identify_language(frames.docs(spark).limit(0)).count() == 0


def test_switched_text_has_shares_of_both_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pick = {r.lang: r.text for r in docs.filter("lang IN ('en', 'fr') AND doc_id > 900 AND n_chars > 800").collect()}
    mixed = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(10**6)).withColumn("lang", F.lit(None).cast("string"))
                             .withColumn("text", F.lit(pick["en"][:700] + " " + pick["fr"][:700])))
    shares = language_crf.identify_language(mixed).filter("doc_id = 1000000").first().shares
    assert shares["en"] > 0.2 and shares["fr"] > 0.2 and shares["en"] + shares["fr"] > 0.9


def test_rare_language_is_a_label(spark):
    """One of the first texts by hash is not needed: each language has its own sample."""
    data = [(i, f"the words of text {i} are plain" if i % 1500 else f"zzyq qquv {i} vvxq zzuq", "en" if i % 1500 else "rare") for i in range(9_000)]
    out = language_crf.identify_language(spark.createDataFrame(data, "doc_id long, text string, lang string"), fit_rows=100)
    assert {r.lang_pred for r in out.filter("doc_id % 1500 = 0").collect()} == {"rare"}


def test_languages_share_the_sample():
    assert language_crf.share([10, 10, 5000, 9000], 100) == 40
    assert language_crf.share([5, 6], 100) >= 6
    assert language_crf.share([9] * 50, 10) == 1


def test_sent_pieces_are_bounded_and_cover_the_whole_text():
    texts = ["a few words", " ".join(f"w{i}" for i in range(200_000)), "é" * 300_000]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    sent = language_crf.pieces(data, np.array([len(t.encode()) for t in texts]), np.arange(3, dtype=np.uint64))
    assert sent[0] == texts[:1] and all(len(own) == language_crf.SENT for own in sent[1:])
    assert all(len(p.encode()) <= language_crf.PIECE_BYTES for own in sent for p in own)
    firsts = [int(p.split()[0][1:]) for p in sent[1]]
    assert max(firsts) > 100_000 and all(p == " ".join(f"w{i + k}" for k in range(language_crf.LENGTH)) for i, p in zip(firsts, sent[1]))


def test_forward_backward_equals_sums_over_all_paths():
    rng = np.random.default_rng(3)
    scores, lengths = rng.normal(size=(7, 2)), np.array([4, 0, 3])
    transitions, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    got, moves, _ = language_crf.forward_backward(scores, lengths, transitions, start)
    expected, pairs, row = np.zeros((7, 2)), np.zeros((2, 2)), 0
    for n in lengths:
        weights = {}
        for code in range(2 ** n):
            path = [(code >> i) & 1 for i in range(n)]
            weights[tuple(path)] = np.exp(sum(scores[row + i, p] for i, p in enumerate(path)) + (start[path[0]] if n else 0)
                                          + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        for path, weight in weights.items():
            share = weight / sum(weights.values())
            for i, p in enumerate(path):
                expected[row + i, p] += share
            for a, b in zip(path, path[1:]):
                pairs[a, b] += share
        row += n
    assert np.allclose(got, expected, atol=1e-5) and np.allclose(moves, pairs, atol=1e-4)


def test_mixture_meets_its_targets(spark):
    rows = frames.rows(8, 300)
    out = mixture.mix_sources(frames.docs(spark, 8, 300)).collect()
    sizes = {r[0]: len(brute.WORD.findall(r[1] or "")) for r in rows}
    source_of = {r[0]: r[3] for r in rows}
    assert {r.doc_id: r.size for r in out} == sizes
    total, targets, taken, most = sum(sizes.values()), {}, {}, {}
    for r in out:
        s = source_of[r.doc_id]
        targets[s], taken[s] = r.target, taken.get(s, 0) + r.taken
        most[s] = max(most.get(s, 0), r.size)
        assert r.taken <= 2 * r.size and r.target <= 2 * r.source_size + 1e-6
        assert r.source_size == sum(n for d, n in sizes.items() if source_of[d] == s)
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    assert all(abs(taken[s] - targets[s]) <= most[s] for s in targets)
    names = sorted((s for s in targets if s is not None)) + [None] * (None in targets)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    free = {s: targets[s] / weight[s] for s in names if targets[s] < 2 * next(r.source_size for r in out if source_of[r.doc_id] == s) - 1e-6}
    assert max(free.values()) == pytest.approx(min(free.values()))
    again = {r.doc_id: r.taken for r in mixture.mix_sources(frames.docs(spark, 8, 300).repartition(3)).collect()}
    assert again == {r.doc_id: r.taken for r in out}


def test_many_sources_are_joined_by_shuffle(spark, monkeypatch):
    expected = sorted(tuple(r) for r in mixture.mix_sources(frames.docs(spark, 8)).collect())
    monkeypatch.setattr(mixture, "BROADCAST_BYTES", 0)
    assert sorted(tuple(r) for r in mixture.mix_sources(frames.docs(spark, 8)).collect()) == expected


def test_mixture_of_awkward_rows(spark):
    out = mixture.mix_sources(frames.awkward(spark)).collect()
    assert len(out) == 8 and all(r.taken in (0, r.size, 2 * r.size) for r in out)
    assert mixture.mix_sources(frames.docs(spark).limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage keeps the columns and only removes what its operator says."""
    docs, before = spark.read.parquet(f"{FOLDER}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == before.columns
        texts = {r.doc_id: r.text for r in before.collect()}
        kept = {r.doc_id: r.text for r in docs.collect()}
        if name == "near_duplicates":
            groups = brute.near_duplicates(texts)
            assert set(kept) == {g for _, _, g in groups.values()}
        if name == "decontamination":
            items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
            assert set(kept) == {d for d, x in brute.contamination(texts, items).items() if not x[3]}
        if name == "personal_data":
            assert set(kept) == set(texts) and not any(brute.personal_data(t) for t in kept.values())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
    assert corpus_pipeline.STAGES[0][0] == "quality" and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("kind", ["awkward", "empty", "null texts"])
def test_whole_pipeline_of_awkward_tables(spark, tmp_path, kind):
    """Null and repeated ids, repeated rows, clashing extra columns, no rows: every stage keeps the columns and runs on the one before."""
    frame = frames.awkward(spark)
    docs = {"awkward": frame, "empty": frame.limit(0), "null texts": frame.withColumn("text", F.lit(None).cast("string"))}[kind]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.schema(docs.schema).parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == docs.count() <= (0 if kind == "empty" else 8)


def test_every_operator_has_a_query():
    assert [f"op{i}_" for i in range(1, 14)] == [q[:q.index("_") + 1] for q in QUERIES]
    assert set(ORACLES) <= set(QUERIES)
