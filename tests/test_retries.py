"""Observed counts must not change when tasks fail and run again."""

from __future__ import annotations

import json
import os
import subprocess
import sys

# Its own process: the number of task attempts is fixed when a session starts.
SCRIPT = """
import json, sys
from pyspark import TaskContext
from pyspark.sql import Observation, functions as F
from triptych.session import get_session

spark = get_session("retries", master="local[4,4]", **{
    "spark.ui.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "100"})
spark.sparkContext.setLogLevel("OFF")

def fail_twice(batches):
    task, seen = TaskContext.get(), 0
    for batch in batches:
        yield batch
        seen += len(batch)
        if task.attemptNumber() < 2 and task.partitionId() % 2 == 0 and seen > 300:
            raise RuntimeError("lost")

rows = spark.range(0, 4000, 1, 8)
result = []
for order in ("observed first", "failing first"):
    seen = Observation()
    if order == "observed first":
        out = rows.observe(seen, F.count(F.lit(1)).alias("rows")).mapInPandas(fail_twice, "id long")
    else:
        out = rows.mapInPandas(fail_twice, "id long").observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").parquet(sys.argv[1])
    result.append((seen.get["rows"], spark.read.parquet(sys.argv[1]).count()))
print(json.dumps(result))
"""


def test_counts_survive_failed_tasks(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path / "out")],
        capture_output=True,
        text=True,
        timeout=300,
        env={**os.environ, "PYTHONPATH": root},
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.strip().splitlines()[-1]) == [[4000, 4000], [4000, 4000]]
