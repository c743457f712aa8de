"""What the entry module registers with and without the training-data operators."""

import json
import os
import shutil
import subprocess
import sys

import pytest
from oracle import ROOT

LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def _registered(at):
    found = subprocess.run([sys.executable, "-c", LIST], cwd=at, capture_output=True, text=True, check=True)
    return json.loads(found.stdout)


@pytest.mark.parametrize("gone", [("docsearch/llm",), ("corpus_pipeline.py",), ("docsearch/llm", "corpus_pipeline.py")])
def test_the_catalogue_stands_without_the_training_data_operators(tmp_path, gone):
    left_out = {os.path.join(ROOT, path) for path in gone}

    def ignored(folder, names):
        return [n for n in names if n in (".git", "__pycache__") or os.path.join(folder, n) in left_out]

    at = tmp_path / "copy"
    shutil.copytree(ROOT, at, ignore=ignored)
    names, sql = _registered(at)
    whole, whole_sql = _registered(ROOT)
    ours = [n for n in whole if not n.startswith("op") or not n[2:3].isdigit()]
    assert [n for n in names if n in ours and n != "pipeline"] == [n for n in ours if n != "pipeline"]
    assert "pipeline" not in names
    assert set(sql) == set(names) & set(whole_sql)
    if "docsearch/llm" in gone:
        assert not [n for n in names if n not in ours]
