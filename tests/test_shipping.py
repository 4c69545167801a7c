"""Code that runs in Python workers must not need the package to be installed there."""

import subprocess
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from sparkcdc.operators import batches
from sparkcdc.operators.segments import Measure, _Summary


def test_worker_code_travels_by_value(tmp_path):
    measures = [Measure("s", 10, True)]

    def count(values):
        return int(_Summary.of_rows({"s": values}, measures).counts[0])

    (tmp_path / "fn.bin").write_bytes(cloudpickle.dumps(count))
    script = "import pickle; print(pickle.load(open('fn.bin', 'rb'))([4, 4, 4, 9, 1]))"
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin"})
    # 4 4 | 4 | 9 1: three starts.
    assert done.stdout.strip() == "3" and count([4, 4, 4, 9, 1]) == 3


def test_input_order_and_partition_count_do_not_matter(spark):
    ticks = spark.createDataFrame(
        [(1, 10, 12, [10]), (2, 13, 15, [13]), (3, 16, 16, [])], "tick_id bigint, xmin bigint, xmax bigint, xip array<bigint>"
    )
    events = spark.range(60).select(F.col("id").alias("ev_id"), (F.col("id") % 8 + 9).alias("ev_txid"))
    answers = [
        {tuple(r) for r in batches.assign_batches(events.repartition(n).orderBy(F.rand(n)), ticks.repartition(n)).collect()} for n in (1, 3, 9)
    ]
    assert answers[0] == answers[1] == answers[2]
