"""The token sink: each row arrives once, though tasks fail and jobs are run again; receipts tell whole deliveries."""

import glob
import json
import os
import subprocess
import sys
import uuid

import pytest

from conftest import ROOT
from leadflow.operators.tokens import profile_tokens
from leadflow.session import checkpoint_dir
from leadflow.sources import token_sink as T

#: Run in a session of its own, since only "local[n, failures]" runs a failed task again.
RETRIES = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from leadflow.operators.tokens import profile_tokens
from leadflow.sources import token_sink as T
spark = SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
df = spark.createDataFrame([(i, i * 2, None) for i in range(500)], "user_id long, installs long, t1_no string")
T.push(profile_tokens(df, "user_id", ["installs", "t1_no"]), "r1", "failing_receiver:take", {out!r} + "/receipts", batch=30)
print(T.receipt(spark, {out!r} + "/receipts", "r1"))
"""
RECEIVER = """
import os, uuid
from leadflow.sources.token_sink import to_folder
OUT = {out!r}
def take(key, rows):
    open(f"{{OUT}}/calls/{{uuid.uuid4().hex}}", "w").write(key)
    to_folder(OUT + "/box")(key, rows)
    from pyspark import TaskContext
    # each task's second batch fails once, after it has arrived
    t = TaskContext.get()
    calls = take.seen = getattr(take, "seen", 0) + 1
    mark = f"{{OUT}}/failed-{{t.partitionId()}}"
    if calls >= 2 and not os.path.exists(mark):
        open(mark, "w").close()
        raise RuntimeError("the receiver broke off")
"""


@pytest.fixture
def out(spark):
    path = f"{checkpoint_dir(spark)}/outbox-{uuid.uuid4().hex}"
    os.makedirs(f"{path}/calls")
    return path


def arrived(out):
    return sorted((r["user_id"], r["token"], r["value"]) for f in glob.glob(f"{out}/box/*.jsonl") for r in map(json.loads, open(f)))


def tokens(spark, n=50):
    df = spark.createDataFrame([(i, i * 2, None) for i in range(n)], "user_id long, installs long, t1_no string")
    return profile_tokens(df, "user_id", ["installs", "t1_no"])


def wanted(n):
    return sorted([(i, "banner_installs", str(2 * i)) for i in range(n)] + [(i, "banner_t1_no", "") for i in range(n)])


def test_rows_arrive_once_and_a_repeated_run_changes_nothing(spark, out):
    t = tokens(spark)
    with pytest.raises(T.UndeliveredError):
        T.receipt(spark, f"{out}/receipts", "r1")
    T.push(t, "r1", f"{out}/box", f"{out}/receipts", batch=7)
    assert arrived(out) == wanted(50) and T.receipt(spark, f"{out}/receipts", "r1")["rows"] == 100
    files = sorted(os.listdir(f"{out}/box"))
    T.push(t.repartition(3), "r1", f"{out}/box", f"{out}/receipts", batch=7)  # dealt otherwise before, the same batches
    assert sorted(os.listdir(f"{out}/box")) == files
    T.push(t, "r2", f"{out}/box", f"{out}/receipts", batch=7)  # another run is delivered anew
    assert len(arrived(out)) == 200


def test_failed_tasks_are_run_again_without_doubles(spark, out):
    with open(f"{out}/failing_receiver.py", "w") as f:
        f.write(RECEIVER.format(out=out))
    done = subprocess.run([sys.executable, "-c", RETRIES.format(root=ROOT, out=out)], capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": f"{out}:{ROOT}"})
    assert "'rows': 1000" in done.stdout, done.stderr[-2000:]
    assert len(glob.glob(f"{out}/failed-*")) >= 3  # tasks did fail
    keys = [open(f).read() for f in glob.glob(f"{out}/calls/*")]
    assert len(keys) > len(set(keys)) and len(set(keys)) == len(glob.glob(f"{out}/box/*.jsonl"))
    assert arrived(out) == wanted(500)


def test_a_job_that_fails_leaves_no_receipt(spark, out):
    os.makedirs(f"{out}/box")
    bad = f"{out}/box/{T.batch_key('r1', [])}"
    assert not os.path.exists(bad)
    with pytest.raises(Exception, match="no_such_module"):
        T.push(tokens(spark), "r1", "no_such_module:take", f"{out}/receipts")
    with pytest.raises(T.UndeliveredError):
        T.receipt(spark, f"{out}/receipts", "r1")
    T.push(tokens(spark), "r1", f"{out}/box", f"{out}/receipts")
    assert arrived(out) == wanted(50)


def test_options_and_no_rows(spark, out):
    T.push(tokens(spark).limit(0), "r0", f"{out}/box", f"{out}/receipts")
    assert T.receipt(spark, f"{out}/receipts", "r0") == {"run": "r0", "rows": 0, "batches": 0}
    with pytest.raises(Exception, match="are needed"):
        tokens(spark).write.format(T.FORMAT).mode("append").save()
    with pytest.raises(Exception, match="appended"):
        tokens(spark).write.format(T.FORMAT).mode("overwrite").options(run="r", to=out).save()
