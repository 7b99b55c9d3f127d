"""The entry module loaded by file path from another folder: executor-side
Python (model callables) must work without the package on sys.path."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location('entry_mod', {os.path.join(ROOT, '__spark_entry__.py')!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
assert m.entry(s).count() == 8
assert m.queries()['analysis_run'](s, '/root/testdata/sf0.001').count() > 0
print('ENTRY_OK')
"""


def test_entry_by_path_from_other_folder():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as d:
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=d, env=env, capture_output=True,
                             text=True, timeout=600)
    assert "ENTRY_OK" in out.stdout, out.stderr[-2000:]
