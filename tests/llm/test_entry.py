"""The registered queries as the driver calls them: the entry module loaded by its
path, from another folder, in workers that cannot import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", "{root}/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
assert len(names) == 14, names
documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
for name in names:
    rows = entry.queries()[name](spark, "/root/testdata/sf0.001").count()
    assert rows == documents or name in ("op3_packing", "op11_chat_format", "op12_spelling_variants",
                                      "op13_collocations", "pipeline") and rows, (name, rows)
print("all ran")
"""


def test_queries_run_where_workers_cannot_import_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]
