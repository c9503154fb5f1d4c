"""Small frames for tests."""

import datetime as dt
import math
import random

START = dt.datetime(2024, 1, 1)


def hour(n):
    return START + dt.timedelta(hours=n)


def sparse_series(seed=1, stations=3, hours=200, keep=0.5, known=0.5):
    """Rows (station_id, hour, x, y) with gaps and unknown values."""
    rng = random.Random(seed)
    rows = []
    for s in range(stations):
        for h in range(hours):
            if rng.random() < keep:
                rows.append((f"S{s}", hour(h), round(rng.uniform(0, 30), 2) if rng.random() < known else None,
                             round(rng.uniform(0, 5), 2) if rng.random() < known / 3 else None))
    rng.shuffle(rows)
    return rows


SPARSE = "station_id string, hour timestamp, x double, y double"


def close(a, b, tolerance=1e-9):
    if a is None or b is None or (isinstance(b, float) and math.isnan(b)):
        return a is None and (b is None or math.isnan(b))
    return abs(a - b) <= tolerance * max(1.0, abs(a), abs(b))
