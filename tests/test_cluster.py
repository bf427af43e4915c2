"""Running away from the repository and off local mode."""

import os
import subprocess
import sys
from types import SimpleNamespace as Obj

import pytest

from claimlens import session as S

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workers_import_the_package_from_any_folder(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
import __spark_entry__ as E
row = E.queries()["t1_province_claim_chi2"](spark, "/root/testdata/sf0.001").first()
print("P", row["p_value"])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "\nP " in "\n" + out.stdout, out.stderr[-800:]


def test_an_unset_checkpoint_folder_is_an_error_off_local_mode():
    none = Obj(isEmpty=lambda: True)
    sc = Obj(master="spark://host:7077", getConf=lambda: Obj(get=lambda *a: None),
             _jsc=Obj(sc=lambda: Obj(getCheckpointDir=lambda: none)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_dir(Obj(conf=Obj(get=lambda *a: None), sparkContext=sc))
