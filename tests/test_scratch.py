"""Intermediate tables have an owner that deletes them."""

import os
import subprocess
import sys

from tablewright.operators import outliers
from tablewright.session import scratch_scope, stored_table

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_scope_deletes_what_was_stored_inside(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    df = spark.range(100).selectExpr("id", "double(id % 7) AS a", "double(id) AS b")
    before = set(os.listdir(folder))
    outside = stored_table(df, "outside")
    with scratch_scope():
        assert outliers.isolation_forest(df, ["a", "b"], "id", trees=5, sample=16, seed=1).count() == 100
        assert len(set(os.listdir(folder)) - before) > 1
    left = set(os.listdir(folder)) - before
    assert {name.split("-")[0] for name in left} <= {"outside", "checkpoints"} and outside.count() == 100


SCRIPT = """
import sys
from tablewright.session import local_session, scratch_path
from tablewright.operators import outliers, ranks
from tablewright.plans import StatisticalConfig, prepare_statistical

spark = local_session(2, "scratch", **({"spark.checkpoint.dir": sys.argv[1]} if len(sys.argv) > 1 else {}))
df = spark.range(60).selectExpr("id", "double(id % 7) AS a", "double(id) AS b", "id % 2 AS y")
flow = prepare_statistical(df, StatisticalConfig(["a", "b"], [], "y", key=["id", "y"], trees=5, sample=16, exact=True))
assert flow.table.count() > 50
assert ranks.checkpointed(df).count() == 60
print(scratch_path(spark, "x").rsplit("/", 1)[0])
spark.stop()
"""


def run(*arguments):
    done = subprocess.run([sys.executable, "-c", SCRIPT, *arguments], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split()[-1]


def test_nothing_is_left_after_the_process(tmp_path):
    assert run(str(tmp_path)) == str(tmp_path)
    assert os.listdir(tmp_path) == []
    default = run()  # what the machine sets, or a folder that goes with the process
    before = set(os.listdir(default)) if os.path.exists(default) else set()
    assert run() and (set(os.listdir(default)) if os.path.exists(default) else set()) == before
