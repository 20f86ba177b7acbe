import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 40
    assert set(e.oracle_sql()) <= set(e.queries())


def test_everything_else_works_without_the_llm_folders(tmp_path):
    import shutil

    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'vec_topk' in q and not any(x.startswith('op') for x in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path / "r")})
