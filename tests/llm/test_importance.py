"""Resampling against zlib's CRCs and a plain sort."""

import hashlib
import math
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeline.llm import importance

from . import frames

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def features(text, least, most):
    words = WORD.findall((text or "").translate(SMALL))
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) for k in range(least, most + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, percent, min_words, least=1, most=1, buckets=10_000, seed=2024):
    own, wanted = np.zeros(buckets), np.zeros(buckets)
    for texts, counts in (([r[1] for r in rows], own), (target, wanted)):
        for text in texts:
            for crc in features(text, least, most)[1]:
                counts[crc % buckets] += 1
    s, t = own.sum(), wanted.sum()
    gain = [math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(own, wanted)]
    out = []
    for key, text, *_ in rows:
        n_words, found = features(text, least, most)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[c % buckets] for c in found)
        out.append([key, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))])
    enough = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1:4]))
    places = {id(r): i + 1 for i, r in enumerate(enough[:len(enough) * percent // 100])}
    return sorted((tuple([*r, places.get(id(r))]) for r in out), key=str)


def run(docs, target, **options):
    return sorted((tuple(r) for r in importance.resample(docs, target, **options).collect()), key=str)


TARGET = ["w1x W2x w3x passages of the bench", "w1x w1x w1x", None, "", "é ü w399x"]


def test_resampling_equals_a_plain_sort(spark):
    rows = frames.rows(3, 200)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert run(frames.docs(spark, 3, 200), target) == brute(rows, TARGET, 10, 20)
    options = {"percent": 37, "min_words": 3, "least": 1, "most": 3, "buckets": 97, "seed": 7}
    assert run(frames.docs(spark, 3, 200).repartition(9), target, **options) == brute(
        rows, TARGET, 37, 3, 1, 3, 97, 7)


def test_resampling_of_awkward_rows(spark):
    target = spark.createDataFrame([("two words",)], "text string")
    frame = frames.awkward(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert run(frame, target, percent=100, min_words=0) == brute(rows, ["two words"], 100, 0)
    assert run(frames.docs(spark).limit(0), target) == []
    assert run(frame, target.limit(0), percent=50, min_words=1) == brute(rows, [], 50, 1)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 3000)), min_size=1, max_size=20))
def test_crc_of_any_substring_comes_from_two_prefixes(data, cuts):
    running = importance.running_crcs(np.frombuffer(data, np.uint8))
    pairs = [sorted((min(a, len(data)), min(b, len(data)))) for a, b in cuts]
    start, end = np.array(pairs).T
    assert importance.substring_crcs(running, start, end).tolist() == [zlib.crc32(data[a:b]) for a, b in pairs]
