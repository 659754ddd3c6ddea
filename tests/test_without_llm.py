"""The rest of the library imports and registers its queries without the llm subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_imports_without_llm(tmp_path):
    shutil.copytree(ROOT / "locuspark", tmp_path / "locuspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = (
        "import __spark_entry__ as e\n"
        "q = e.queries(); assert 'repeat_composition' in q and not any(k.startswith('op1_') for k in q) and 'pipeline' not in q\n"
        "assert set(e.oracle_sql()) <= set(q)\n"
    )
    if os.path.isdir("/root/testdata/sf0.001"):  # some queries run, the flagship among them
        code += (
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '2').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "assert e.entry(s).count() > 0\n"
            "for k in ('j1_overlap_join', 'w1_merge_intervals', 'a23_order_statistics', 's20_skip_records', 'w6_exponential_smoothing'): assert q[k](s, '/root/testdata/sf0.001').count() > 0, k\n"
        )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=600, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_llm():
    for p in (ROOT / "locuspark").rglob("*.py"):
        if "llm" not in p.parts:
            assert "locuspark.llm" not in p.read_text(), p
