import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_corpus_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not any(k.startswith('op') for k in q) and set(e.oracle_sql()) <= set(q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, check=True, timeout=120)


def test_other_import_errors_are_not_swallowed(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__"))
    if os.path.isdir(tmp_path / "repo/nightwave/llm"):
        with open(tmp_path / "repo/nightwave/llm/queries.py", "a") as f:
            f.write("\nimport no_such_module\n")
        done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
        assert done.returncode and "no_such_module" in done.stderr


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 15 and sum(r.n_events for r in rows) == 208 and round(sum(r.total_s for r in rows), 2) == 269.29
