"""The entry point with and without the optional parts of the repository."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), 'pipeline' in q, any(k.startswith('op1_') for k in q))"


def _copy(at: Path) -> Path:
    shutil.copytree(ROOT / "bidbox", at / "bidbox", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, at / name)
    return at


def _found(at: Path) -> list[str]:
    return subprocess.run([sys.executable, "-c", COUNT], cwd=at, capture_output=True, text=True, check=True).stdout.split()


def test_entry_without_the_optional_parts(tmp_path):
    whole = _copy(tmp_path / "whole")
    without = tmp_path / "without"
    shutil.copytree(whole, without, ignore=shutil.ignore_patterns("llm"))
    n, pipeline, first = _found(without)
    assert (pipeline, first) == ("False", "False") and int(n) > 150
    if (whole / "bidbox/llm").exists() and (whole / "corpus_pipeline.py").exists():
        m, pipeline, first = _found(whole)
        assert (pipeline, first) == ("True", "True") and int(m) > int(n)
        (whole / "corpus_pipeline.py").unlink()
        assert _found(whole)[1:] == ["False", "True"]
