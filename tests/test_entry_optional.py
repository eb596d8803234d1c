"""The entry point works where the optional parts are not there."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


CODE = """
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
print(len(q), "pipeline" in q, set(o) <= set(q))
from quarry.session import local_session
spark = local_session(2, 2)
print(q["dedup_keep_last"](spark, e.SMOKE_DIR).count())
spark.stop()
"""


def run(copy) -> list[str]:
    out = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, check=True)
    return out.stdout.split()[-4:]


def test_without_optional_parts(tmp_path):
    """The whole repository without the optional folders, corpus_pipeline.py in place: the core keys are there and run."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "__pycache__", ".git", "spark-warehouse"))
    assert (copy / "corpus_pipeline.py").exists() and not (copy / "quarry" / "llm").exists()
    n, pipeline, known, rows = run(copy)
    assert int(n) >= 49 and pipeline == "False" and known == "True" and int(rows) > 0


def test_without_the_pipeline_file(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(ROOT, "quarry"), copy / "quarry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    n, pipeline, known, _ = run(copy)
    assert int(n) >= 49 and pipeline == "False" and known == "True"
