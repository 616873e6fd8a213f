"""The library without the operators on training data."""

import subprocess
import sys
from pathlib import Path
from shutil import copytree, ignore_patterns

REPO = Path(__file__).resolve().parent.parent

SCRIPT = """
import __spark_entry__ as entry_point
from sluicebox.session import build_session

assert entry_point.llm_queries is None and entry_point.corpus_pipeline is None
assert entry_point.queries().keys() == entry_point.shop_queries().keys() == entry_point.oracle_sql().keys()
spark = build_session(master="local[2]", conf={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
assert entry_point.entry(spark).count() == 4
"""


def test_queries_without_the_operators_on_training_data(tmp_path):
    """With their folder gone, with the pipeline's file still there, or with an empty folder left over."""
    copy = tmp_path / "repo"
    copytree(REPO, copy, ignore=ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache"))
    assert (copy / "corpus_pipeline.py").exists() == (REPO / "corpus_pipeline.py").exists()
    (copy / "script.py").write_text(SCRIPT)
    for left_over in (False, True):
        if left_over:
            (copy / "sluicebox/llm/__pycache__").mkdir(parents=True)
        done = subprocess.run([sys.executable, "script.py"], cwd=copy, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
