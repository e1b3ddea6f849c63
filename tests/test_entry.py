"""The entry file without the operators for training data."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_operators(tmp_path):
    for gone in ("empty folder", "no folder", "no pipeline either"):
        own = tmp_path / gone.replace(" ", "_")
        shutil.copytree(os.path.join(ROOT, "slicehouse"), own / "slicehouse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), own)
        shutil.copy(os.path.join(ROOT, "bench.py"), own)
        if gone == "empty folder":
            (own / "slicehouse" / "llm" / "__pycache__").mkdir(parents=True)
        pipeline = os.path.join(ROOT, "corpus_pipeline.py")
        if gone != "no pipeline either" and os.path.exists(pipeline):
            shutil.copy(pipeline, own)
        code = "import __spark_entry__ as e, bench; print(len(e.queries()), 'pipeline' in e.queries(), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))"
        said = subprocess.run([sys.executable, "-c", code], cwd=own, capture_output=True, text=True, timeout=120, check=True).stdout.split()
        assert int(said[0]) >= 59 and said[1:] == ["False", "False"], gone
