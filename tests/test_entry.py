import importlib.util
import os
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parent.parent


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_problems_have_found_queries():
    names = set(entry.queries())
    core = {"p1_found", "p2_found", "p4_found"}
    assert core <= names
    if importlib.util.find_spec("tessella.llm"):
        assert {f"p{n}_found" for n in range(1, 10)} <= names


def test_core_does_not_import_the_subpackage():
    for path in (REPO / "tessella").rglob("*.py"):
        if "llm" not in path.relative_to(REPO / "tessella").parts:
            assert "llm" not in path.read_text(), path


def test_leftovers_of_a_deleted_subpackage_do_no_harm(tmp_path):
    """Without its files but with its cache folder, the subpackage is an empty namespace package."""
    shutil.copytree(REPO / "tessella", tmp_path / "tessella", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "tessella" / "llm" / "__pycache__").mkdir(parents=True)
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and 'p3_found' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_core_stands_alone():
    code = "import sys; sys.modules['tessella.llm'] = None; import tessella.plans.catalogue as c; assert c.MODULES"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
