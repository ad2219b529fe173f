"""The shared folder and the package handed to the executors."""

import os
import subprocess
import sys
import zipfile

import pytest

from cardwarden import session


class FakeContext:
    master, applicationId = "yarn", "app-1"

    def __init__(self):
        self.added = []

    def addPyFile(self, path):
        self.added.append(path)


class FakeSession:
    """A cluster session as far as these functions look at one."""

    def __init__(self, **settings):
        self.settings = settings
        self.conf = self
        self.sparkContext = FakeContext()

    def get(self, key, default):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_cluster_names_the_shared_folder():
    shared = FakeSession(**{"spark.checkpoint.dir": "hdfs://shared/checkpoints/"})
    first, second = (session.scratch(shared, "stream") for _ in range(2))
    assert first.startswith("hdfs://shared/checkpoints/stream-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch(FakeSession(), "stream")


def test_package_is_shipped_once():
    cluster = FakeSession()
    session.tune(session.tune(cluster))
    (archive,) = cluster.sparkContext.added
    with zipfile.ZipFile(archive) as package:
        assert "cardwarden/sources/workbook.py" in package.namelist()
    assert cluster.settings["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_python_workers_find_the_package(tmp_path):
    """Started elsewhere, the workers know the package only from what the session ships."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from cardwarden.session import local_session
spark = local_session(2)
print(entry.queries()["workbook_terminals"](spark, "/root/testdata/sf0.001").count())
"""
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert done.stdout.split()[-1:] == ["10"], done.stderr[-2000:]
