"""Workers that cannot import the package still run its functions."""

from __future__ import annotations

import os
import pathlib
import subprocess
import sys

from tests.llm.conftest import SMALL

ROOT = str(pathlib.Path(__file__).resolve().parents[2])
SCRIPT = f"""
import sys
sys.path.append({ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
from orderlens.llm.queries import QUERIES
for name in ("op1_toxicity", "op2_token_counts", "op9_html_text", "op10_lm_scores", "op11_conversation_repair", "op12_periodic_runs", "op13_quality_rules"):
    assert QUERIES[name](spark, {SMALL!r}).count() > 0
print("done")
"""


def test_functions_travel_by_value(tmp_path):
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.stdout.strip().endswith("done"), run.stderr[-2000:]
