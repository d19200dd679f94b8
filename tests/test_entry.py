"""The entry module without the optional subpackage."""

import json
import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_operators(tmp_path):
    """A copy that lacks both folders of the subpackage, and the pipeline or not, has all other queries."""
    copy = tmp_path / "copy"
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache"))
    code = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"

    def names():
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": ""})
        return json.loads(out.stdout.splitlines()[-1])

    found = names()
    assert {"us_prices_daily", "ca_prices_fallback", "stream_gated_append"} <= set(found[0]) and set(found[1]) <= set(found[0])
    assert not any(n.startswith("op") and n[2].isdigit() for n in found[0]) and "pipeline" not in found[0]
    if (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").unlink()
        assert names() == found
