"""The shared folder comes from the session; a temp folder only when unset."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false"){{conf}}.getOrCreate()
from ratelake.session import ensure_checkpoint_dir, shared_path
print("DIR", ensure_checkpoint_dir(spark))
print("PATH", shared_path(spark, "x"))
"""


def _run(conf: str) -> dict[str, str]:
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="ratelake-conf-"))
    out = subprocess.run(
        [sys.executable, "-c", _SCRIPT.format(conf=conf)],
        env=env, capture_output=True, text=True, timeout=300,
    ).stdout
    return dict(line.split(" ", 1) for line in out.splitlines() if line.startswith(("DIR ", "PATH ")))


def test_checkpoint_dir_from_the_session_setting():
    shared = tempfile.mkdtemp(prefix="ratelake-shared-")
    got = _run(f'.config("spark.checkpoint.dir", {shared!r})')
    assert shared in got["DIR"] and got["PATH"].startswith(got["DIR"])


def test_checkpoint_dir_falls_back_only_when_unset():
    got = _run("")
    assert "ratelake-ckpt-" in got["DIR"] and got["PATH"].startswith(got["DIR"])
