import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import debruijn_dedup, jaccard_join, repeats, suffix_dedup
from gaugeline.llm.arrays import segments
from gaugeline.llm.components import components

from . import brute, frames


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, (bytes, bytearray)) else data.encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_equals_brute_force(spark, seed):
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), sha(bytes(r.kept)))
           for r in suffix_dedup.remove_repeats(frames.docs(spark, seed)).collect()}
    assert got == brute.suffix_dedup(frames.texts_of(frames.rows(seed)))


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_equals_brute_force(spark, seed):
    got = {r.doc_id: (r.n_words, r.n_removed, sha(r.kept)) for r in debruijn_dedup.remove_repeats(frames.docs(spark, seed)).collect()}
    assert got == brute.substring_dedup(frames.texts_of(frames.rows(seed)))


def test_split_tokens_are_compared_across_ranges(spark, monkeypatch):
    """With many ranges and a sample that holds everything, frequent minimizers are splitters."""
    monkeypatch.setattr(repeats, "RANGE_BYTES", 2_000)
    texts = frames.texts_of(frames.rows(3))
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(frames.docs(spark, 3)).collect()}
    assert got == {d: x[1] for d, x in brute.suffix_dedup(texts).items()}
    got = {r.doc_id: r.n_removed for r in debruijn_dedup.remove_repeats(frames.docs(spark, 3)).collect()}
    assert got == {d: x[1] for d, x in brute.substring_dedup(texts).items()}


def test_equal_windows_share_a_minimizer():
    rng = np.random.default_rng(1)
    lengths = rng.choice([0, 3, 9, 60], 40)
    tokens = rng.integers(0, 2, lengths.sum()).astype(np.uint64)
    found = segments(tokens, lengths, 8, 3)
    assert found.windows.sum() == np.maximum(lengths - 7, 0).sum()
    begins = np.cumsum(lengths) - lengths
    gram_of, content_of = {}, {}
    for doc, start, count, gram, content in zip(*found):
        at = begins[doc] + start
        assert content_of.setdefault((gram, content), tokens[at:at + count + 7].tobytes()) == tokens[at:at + count + 7].tobytes()
        for i in range(count):
            assert gram_of.setdefault(tokens[at + i:at + i + 8].tobytes(), gram) == gram


def test_multikey_sort_finds_all_but_the_first():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    place = np.arange(3900)
    got = suffix_dedup.multikey_sort(data, place, np.zeros(3900, np.int64), 12)
    seen: set = set()
    for i in place:
        key = data[i:i + 12].tobytes()
        assert got[i] == (key in seen)
        seen.add(key)


@pytest.mark.parametrize("remove, size", [(suffix_dedup.remove_repeats, "n_bytes"), (debruijn_dedup.remove_repeats, "n_words")])
def test_awkward_rows(spark, remove, size):
    """Each row of the input has a row; rows equal in id and text remove nothing from one another."""
    out = remove(frames.awkward(spark)).collect()
    assert len(out) == 8 and all(r.n_removed == 0 for r in out)
    assert sum(r[size] == 0 for r in out) == 3
    assert remove(frames.docs(spark).limit(0)).count() == 0


def test_the_earlier_text_is_that_of_the_smaller_id(spark):
    long = " ".join(f"word{i}" for i in range(60))
    frame = spark.createDataFrame([(5, long), (2, long), (9, long + " and more")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in debruijn_dedup.remove_repeats(frame).collect()} == {2: 0, 5: 60, 9: 60}


@pytest.mark.parametrize("seed", [1, 4])
def test_near_duplicates_equal_brute_force(spark, seed):
    got = {r.doc_id: (r.class_id, r.n_links, r.group_id) for r in jaccard_join.near_duplicates(frames.docs(spark, seed)).collect()}
    assert got == brute.near_duplicates(frames.texts_of(frames.rows(seed)))


def test_large_sets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    got = {r.doc_id: (r.class_id, r.n_links, r.group_id) for r in jaccard_join.near_duplicates(frames.docs(spark, 5)).collect()}
    assert got == brute.near_duplicates(frames.texts_of(frames.rows(5)))


@pytest.mark.parametrize("shared", [50, 85, 92])
def test_chains_are_compared_by_node_or_block(spark, monkeypatch, shared):
    """Each text shares words with the next one only, so the sets of a long chain have few candidate pairs."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    rows = [(i, " ".join(f"w{j}" for j in range(i * (100 - shared), i * (100 - shared) + 104))) for i in range(120)]
    rows += [(200 + i, " ".join(f"hot{j}" for j in range(100)) + f" end{i}") for i in range(30)]
    got = {r.doc_id: (r.class_id, r.n_links, r.group_id)
           for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_duplicates(dict(rows))


def test_a_pair_counts_in_its_first_common_node():
    rng = np.random.default_rng(3)
    lists = [[100 * t + int(v) for t, v in enumerate(row) if v < 3] for row in rng.integers(0, 4, (40, 6))]
    for here in range(500, 503):
        mine = [x for x in lists if here in x]
        got = jaccard_join.meet_here(pa.array(mine, pa.list_(pa.int64())), here)
        for i, a in enumerate(mine):
            for j, b in enumerate(mine):
                assert i == j or got[i, j] == (min(set(a) & set(b)) == here)


def test_prefixes_are_shortened_where_it_costs_least():
    pairs = {(t, d): (10_000 if t < 4 else 10) * (9 - d) for t in range(32) for d in range(1, 9)}
    depths = jaccard_join.plan_prefixes(pairs, 0.8, 0.9999)
    assert 1 - np.prod([1 - 0.8 ** d for d in depths]) >= 0.9999
    assert min(depths[:4]) == jaccard_join.DEPTH > min(depths[4:])
    assert jaccard_join.plan_prefixes({}, 0.8, 0.9999) and set(jaccard_join.plan_prefixes({}, 1.0, 0.9999)) == {jaccard_join.DEPTH}


def test_near_duplicates_of_awkward_rows(spark):
    frame = frames.awkward(spark)
    out = jaccard_join.near_duplicates(frame).collect()
    assert len(out) == 8
    assert {r.class_id for r in out if r.doc_id == 3} == {2}
    kept = jaccard_join.first_copies(frame)
    assert kept.columns == frame.columns
    texts = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert texts.count((2, "one two three four five six")) == 1 and not any(d == 3 for d, _ in texts)
    assert jaccard_join.near_duplicates(frames.docs(spark).limit(0)).count() == 0


def test_recall_decides_the_depth_of_prefixes():
    assert jaccard_join.prefix_depth(0.8, 0.9999) == 6
    assert jaccard_join.prefix_depth(0.8, 0.5) > 6


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 90, 95: 90, 90: 90}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_kept_text_is_valid_where_nothing_goes(spark):
    out = suffix_dedup.remove_repeats(spark.createDataFrame([(1, "äöü")], "doc_id long, text string"))
    assert out.select(F.col("kept").cast("string")).first()[0] == "äöü"
