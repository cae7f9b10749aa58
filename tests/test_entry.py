"""The contract without the part on text."""

import json
import os
import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_without_the_text_operators(tmp_path):
    """With the text folders gone, and the pipeline there or not, the other queries are registered."""
    leave = shutil.ignore_patterns("llm", ".git", "*.json", "__pycache__")
    code = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    for pipeline in (True, False):
        copy = str(tmp_path / f"copy{pipeline}")
        shutil.copytree(ROOT, copy, ignore=leave)
        if not pipeline and os.path.exists(f"{copy}/corpus_pipeline.py"):
            os.remove(f"{copy}/corpus_pipeline.py")
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout
        names, known = json.loads(out.splitlines()[-1])
        assert "daily_risk" in names and set(known) <= set(names)
        assert not [n for n in names if n.startswith("op") and n[2:3].isdigit() or n == "pipeline"]
