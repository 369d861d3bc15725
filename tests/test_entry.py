"""The entry without the parts that may be left out."""

import os
import re
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def listed(*missing):
    """Names of all queries where some modules cannot be imported."""
    code = f"""
import sys
for name in {missing!r}:
    sys.modules[name] = None
import __spark_entry__ as e
print(*e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


def test_table_queries_stay_without_the_corpus_part_or_its_libraries():
    whole = listed()
    assert "basic_drift" in whole
    for missing in (("plumbline.llm", "corpus_pipeline"), ("xxhash",), ("zstandard",)):
        # The pipeline stays where none of its own stages needs what is missing.
        assert listed(*missing) - {"pipeline"} == {name for name in whole if not re.match(r"op\d+_|pipeline", name)}
