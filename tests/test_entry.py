"""The entry module in a tree without the training-data part."""

import os
import pathlib
import shutil
import subprocess
import sys

from tests.conftest import SMALL

REPO = pathlib.Path(__file__).resolve().parent.parent


def test_everything_else_works_without_the_training_data_part(tmp_path):
    shutil.copytree(REPO / "tillcast", tmp_path / "tillcast", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *[f for f in os.listdir(REPO) if f == "corpus_pipeline.py"]):
        shutil.copy(REPO / name, tmp_path)
    code = ("import __spark_entry__ as e; from tillcast.session import build_session; q = e.queries(); "
            "assert not any(k.startswith('op') or k == 'pipeline' for k in q) and set(e.oracle_sql()) <= set(q); "
            f"s = build_session('local[2]', shuffle_partitions=2); print('rows', q['k2_insert_depts'](s, '{SMALL}').count())")
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                         env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert "rows 25" in run.stdout, run.stderr[-2000:]
