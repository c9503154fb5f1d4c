"""Product codes against rounds in plain Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from gaugeline.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    kept = sorted(((i is None, i or 0, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)),
                  key=lambda r: r[:3])
    if not kept:
        return []
    length = len(kept[0][2])
    good = [(r, [math.floor(1024 * float(np.float32(x))) for x in r[2]]) for r in kept if len(r[2]) == length and length % parts == 0]
    width = length // parts
    cut = [[v[p * width:(p + 1) * width] for _, v in good] for p in range(parts)]
    books = [own[:entries] for own in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut[p]:
                groups.setdefault(nearest(x, books[p])[1], []).append(x)
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    found = {id(r): [nearest(cut[p][n], books[p]) for p in range(parts)] for n, (r, _) in enumerate(good)}
    out = [(None if r[0] else r[1], r[3], "".join(f"{i:02x}" for _, i in found[id(r)]) if id(r) in found else None,
            sum(g for g, _ in found[id(r)]) if id(r) in found else None) for r in kept]
    sums = {}
    for _, label, _, error in out:
        if error is not None:
            sums[label] = sums.get(label, 0) + error
    return sorted(((i, label, code, error, sums.get(label), digest) for i, label, code, error in out), key=str)


def awkward(seed=1, n=400):
    rng = random.Random(seed)
    rows = [(i * 3 % 1201, [rng.choice([-1.5, -0.25, 0.1, rng.gauss(0, 1)]) for _ in range(8)], rng.choice([1, 1, 1, 2, None])) for i in range(n)]
    rows += [rows[5], rows[5], (7, None, 1), (8, [1.0] * 7 + [None], 1), (9, [float("nan")] * 8, 2), (10, [float("inf")] * 8, 2), (11, [0.5] * 4, 3),
             (12, [], None), (None, [0.25] * 8, None), (None, [0.25] * 8, 1), (5, [0.0] * 8, 2), (5, [-0.0] * 8, 2), (13, [1e30] * 8, 1)]
    return rows


def run(frame, **options):
    return sorted((tuple(r) for r in vector_codes.encode(frame, **options).collect()), key=str)


@pytest.mark.parametrize("entries", [1, 16, 256])
def test_codes_equal_plain_rounds(spark, entries):
    rows = [r for r in awkward() if not (r[1] and max((abs(x) for x in r[1] if x is not None), default=0) == 1e30)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(7), entries=entries) == brute(rows, entries=entries)


def test_awkward_vectors(spark):
    rows, frame = awkward(), spark.createDataFrame(awkward(), SCHEMA)
    clash = frame.selectExpr("*", *[f"'clash' AS {c}" for c in ("id", "code", "numbers", "pivots", "usable", "vector", "error")])
    found = run(clash.repartition(3))
    assert found == run(frame) and len(found) == len(rows) - 4
    empty = {r[0]: r for r in found if r[2] is None}
    assert set(empty) == {11, 12, 13} and all(r[3] is None for r in empty.values())
    assert run(frame.limit(0)) == [] and run(frame.filter("embedding IS NULL")) == []
    assert {r[2] for r in run(frame.filter("size(embedding) = 0"))} == {"00000000"}
    odd = run(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], SCHEMA))
    assert [r[2:5] for r in odd] == [(None, None, None)]


def test_bounds_never_prune_the_nearest():
    rng = np.random.default_rng(4)
    cases = [(rng.integers(-3, 3, (500, 4)), rng.integers(-3, 3, (60, 4))), (np.arange(500)[:, None] << 20, (np.arange(90)[:, None] * 3) << 20)]
    big = vector_codes.component_limit(16)
    cases.append((rng.integers(-big, big, (300, 16)), rng.integers(-big, big, (256, 16))))
    for rows, entries in cases:
        pivots = vector_codes.pick_pivots(entries)
        known, own = (vector_codes.to_pivots(x, pivots).astype(np.float32) for x in (rows, entries))
        index, gap = vector_codes.nearest(rows, known, entries, own)
        every = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (gap == every.min(axis=1)).all()
