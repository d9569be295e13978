"""The entry points, with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

import __spark_entry__

ROOT = os.path.dirname(os.path.abspath(__spark_entry__.__file__))


def test_entry_runs(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["lang", "source", "chars", "doc_id"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_the_corpus_operators(tmp_path):
    shutil.copytree(f"{ROOT}/tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "tessera/llm/__pycache__").mkdir(parents=True)  # what a deleted folder may leave behind
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'richest_per_key' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)
