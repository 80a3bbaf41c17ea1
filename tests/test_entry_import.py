"""The entry module must import in a fresh process with no session, also when
pyspark is loaded from its zip archive (no jars beside it, no JVM)."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark

ROOT = Path(__file__).resolve().parents[1]


def _fresh(extra_path):
    env = os.environ | {"PYTHONPATH": os.pathsep.join([*extra_path, str(ROOT)])}
    code = ("import __spark_entry__ as E, pyspark; q = E.queries(); s = E.oracle_sql();"
            "assert set(s) <= set(q) and len(s) >= 35; print(pyspark.__file__)")
    p = subprocess.run([sys.executable, "-c", code], env=env, cwd="/", text=True,
                       capture_output=True, timeout=120)
    assert p.returncode == 0, p.stderr
    return p.stdout


def test_import_without_a_session():
    _fresh([])


def test_import_with_zipped_pyspark_first():
    lib = Path(pyspark.__file__).parent / "python" / "lib"
    if ".zip" in pyspark.__file__:
        lib = Path(pyspark.__file__.split("pyspark.zip")[0])
    zips = [str(p) for p in sorted(lib.glob("*.zip"))]
    assert "pyspark.zip" in _fresh(sorted(zips, key=lambda z: "py4j" in z))
