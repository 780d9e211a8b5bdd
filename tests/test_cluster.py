"""Python in tasks finds the package where neither PYTHONPATH nor the working folder has it."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession, functions as F
from skyledger.operators.resolve import resolve
from skyledger.schema import PATHS, RECORD
import json
def record(model):
    out = {{}}
    for p in PATHS:
        a, _, b = p.partition(".")
        if b:
            out.setdefault(a, {{}})[b] = None
        else:
            out[a] = [] if a.startswith("operational") else None
    return json.dumps(out | {{"status": "valid", "model": model}})
spark = SparkSession.builder.master("local[1]").config("spark.sql.shuffle.partitions", "1").config("spark.ui.enabled", "false").getOrCreate()
rows = [("k", i, str(i), record(m), False) for i, m in enumerate(("a", "b", "a"))]
df = spark.createDataFrame(rows, "source_id string, _ord int, raw string, json string, bad boolean")
df = df.withColumn("record", F.from_json("json", RECORD))
r = resolve(df.select("source_id", "_ord", "raw", "record", "bad")).first()
print("RESULT", r.record.model, r.skipped, r.failed)
"""


def test_tasks_find_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "RESULT a 1 1" in done.stdout, done.stderr[-2000:]
