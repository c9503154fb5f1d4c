"""Functions travel to workers by value: executors need not have the package."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from gaugeline.session import build_session
from gaugeline.llm.queries import QUERIES
spark = build_session("travel", "local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
                                               "spark.checkpoint.dir": {folder!r}, "spark.sql.execution.arrow.maxRecordsPerBatch": "64"}})
spark.sparkContext.setLogLevel("OFF")

def missing(batches):
    import importlib.util
    for batch in batches:
        assert importlib.util.find_spec("gaugeline") is None
        yield batch

assert spark.range(4).mapInArrow(missing, "id long").count() == 4
for name, query in QUERIES.items():
    print(name, len(query(spark, "/root/testdata/sf0.001").collect()), flush=True)
"""


def test_operators_run_where_workers_lack_the_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root, folder=str(tmp_path / "shared"))], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=900)
    rows = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert len(rows) == 13 and set(rows.values()) == {"200", "500"}, done.stderr[-2000:]
