"""Every operator and the pipeline with workers that cannot import this package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")

def missing(batches):
    import importlib.util
    assert importlib.util.find_spec("registra") is None
    yield from batches

spark.range(1).mapInArrow(missing, "id long").collect()
sys.path.insert(0, sys.argv[1])
from registra.llm.catalogue import QUERIES
for name in sys.argv[3:]:
    QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("done", name)
"""
GROUPS = [
    ["op1_sentencepiece", "op2_secrets", "op3_simhash", "op4_exact_dedup", "op5_pii"],
    ["op6_decontaminate", "op7_lm_score", "op8_language_id", "op9_token_records", "op10_passages"],
    ["op11_quality", "op12_hard_negatives", "op13_collocations", "pipeline"],
]


@pytest.mark.parametrize("names", GROUPS)
def test_nothing_has_to_be_installed_on_executors(tmp_path, names):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    args = [sys.executable, str(script), str(ROOT), str(tmp_path / "shared"), *names]
    ran = subprocess.run(args, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert ran.stdout.split() == [w for n in names for w in ("done", n)], ran.stderr[-3000:]
