"""Functions of tasks travel with the job: workers that cannot import the package run every query."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys

sys.path.insert(0, {root!r})
from checks.compare import session

spark = session(2)


def importable(_):
    try:
        import scrubline
    except ImportError:
        return ["no"]
    return ["yes"]


assert spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect() == ["no"]
import corpus_pipeline
from scrubline.llm.queries import QUERIES

for name, query in QUERIES.items():
    print(name, query(spark, {folder!r}).count(), flush=True)
print("pipeline", corpus_pipeline.run(spark, {folder!r}).count())
"""


def test_workers_need_no_install(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=root, folder="/root/testdata/sf0.001"))
    # Workers start in the folder of the driver and would find the package there.
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split("\n")) > 14
