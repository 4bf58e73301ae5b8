"""Folders of stored steps and the package on the workers."""

import os
import subprocess
import sys
import urllib.parse

from cardledger.session import job_folder, materialize, shared_dir

SF_DIR = "/root/testdata/sf0.001"


def local(path):
    return urllib.parse.urlparse(path).path


def test_a_job_leaves_nothing_behind(spark):
    before = set(os.listdir(local(shared_dir(spark))))
    with job_folder(spark) as folder:
        stored = materialize(spark.range(10), "step")
        assert os.listdir(local(folder)) and stored.count() == 10
    assert set(os.listdir(local(shared_dir(spark)))) == before


def test_workers_get_the_package_wherever_the_driver_starts(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', {str(tmp_path / 'shared')!r}).getOrCreate()\n"
        f"print('rows', e.queries()['post_sequential'](s, {SF_DIR!r}).count())"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=False
    )
    assert "rows 1500" in done.stdout, done.stderr[-2000:]
