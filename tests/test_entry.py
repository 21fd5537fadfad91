"""The entry point without the optional packages."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["public_tokenizers", "ahocorasick", "corpus_pipeline", "tidewater.llm"])
def test_core_queries_load_without(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as E; "
            "from tidewater.plans.queries import QUERIES; assert set(E.queries()) >= set(QUERIES); "
            "print(len(E.queries()) == len(QUERIES), set(E.oracle_sql()) <= set(E.queries()))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[-1:] == ["True"], out.stderr[-500:]
    if missing == "public_tokenizers":
        assert out.stdout.split() == ["True", "True"]
