"""Python workers get the functions with the query, wherever the session was started."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from tidemark.session import local_session
import __spark_entry__ as entry
spark = local_session(2)
rows = entry.queries()["d20_p_values"](spark, "/root/testdata/sf0.001").collect()
assert 0 < rows[0]["pearson_p"] < 1
assert entry.queries()["j8_inquiry_anomalies"](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_workers_need_no_package(tmp_path):
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
