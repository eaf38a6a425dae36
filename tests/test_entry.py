"""The driver contract holds with and without the training-data subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(before: str) -> list[str]:
    code = f"import sys; {before}; import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    queries, sql = (line.split() for line in out.stdout.splitlines()[-2:])
    assert set(sql) <= set(queries)
    return queries


def test_without_the_subpackage_the_rest_is_listed():
    names = _names("sys.modules['starloom.llm'] = None")
    assert "tenure_ranking" in names and not any(n.startswith("op") for n in names if n[2:3].isdigit())
    assert _names("sys.modules['corpus_pipeline'] = None") == names
    assert set(names) <= set(_names("pass"))


def test_a_library_that_only_the_subpackage_needs_may_be_missing():
    names = _names("sys.modules['starloom.llm'] = None")
    for library in ("xxhash", "regex", "sentencepiece", "tokenizers", "public_tokenizers"):
        assert _names(f"sys.modules['{library}'] = None") == names
