"""The driver's functions with the corpus operators taken away."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SAYS = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), sum(n[:2] == 'op' for n in q), 'pipeline' in q)"


def names(root):
    out = subprocess.run([sys.executable, "-B", "-c", SAYS], cwd=root, capture_output=True, text=True, check=True).stdout
    return out.split()


def test_queries_without_the_corpus_operators(tmp_path):
    everything = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "all", ignore=everything)
    parts = [p for p in ("lakecast/llm", "tests/llm") if (ROOT / p).exists()]
    expected = names(tmp_path / "all")
    # The copy without them is made anew, with and without the pipeline's file.
    for i, left_out in enumerate(({"llm"}, {"llm", "corpus_pipeline.py"})):
        shutil.copytree(ROOT, tmp_path / str(i), ignore=lambda folder, found, gone=left_out: {*everything(folder, found), *(gone & set(found))})
        count, numbered, pipeline = names(tmp_path / str(i))
        assert numbered == "0" and pipeline == "False"
        assert int(count) == int(expected[0]) - (int(expected[1]) + (expected[2] == "True") if parts else 0)
