import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent


def names(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, env=env, check=False)
    assert done.returncode == 0, done.stderr
    return [set(x.split()) for x in done.stdout.splitlines()[-2:]]


@pytest.mark.parametrize("also", [[], ["corpus_pipeline.py"]])
def test_the_rest_stands_without_the_training_data_operators(tmp_path, also):
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm", "spark-warehouse", *also)
    shutil.copytree(REPO, tmp_path / "repo", ignore=skip)
    assert (tmp_path / "repo" / "corpus_pipeline.py").exists() != bool(also)
    queries, sql = names(tmp_path / "repo")
    assert "w5_maximise" in queries and not any(q.startswith("op") for q in queries) and "pipeline" not in queries
    assert sql < queries


def test_an_operator_that_cannot_be_imported_takes_nothing_else_down(tmp_path):
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    (tmp_path / "repo" / "utterloom" / "llm" / "queries.py").write_text("import no_such_module_here\n")
    queries, _ = names(tmp_path / "repo")
    assert "w5_maximise" in queries and not any(q.startswith("op") for q in queries)


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
