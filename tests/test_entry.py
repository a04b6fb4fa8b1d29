import os
import re
import shutil
import subprocess
import sys

import pytest

import __spark_entry__
from tests.conftest import ROOT


def test_entry_gives_rows_of_a_stable_schema(spark):
    first, second = __spark_entry__.entry(spark), __spark_entry__.entry(spark)
    assert first.schema == second.schema and first.count() > 0


def test_every_oracle_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(__spark_entry__.queries()) > 90


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_library_works_without_the_training_data_folders(tmp_path, pipeline):
    """With the two folders gone, and corpus_pipeline.py left or gone: it imports, and the rest's tests are found."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    shutil.rmtree(copy / "webloom" / "llm", ignore_errors=True)
    shutil.rmtree(copy / "tests" / "llm", ignore_errors=True)
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), any(n.startswith('op') for n in q), 'pipeline' in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[0]) > 80 and int(out[1]) > 70 and out[2:] == ["False", "False"]
    found = subprocess.run([sys.executable, "-m", "pytest", "--co", "-q", "-p", "no:cacheprovider", "tests"], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stdout[-2000:]


def test_nothing_else_imports_the_training_data_package():
    for folder, _, names in os.walk(os.path.join(ROOT, "webloom")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert not re.search(r"webloom\.llm|from \.+llm|import llm", f.read()), name
