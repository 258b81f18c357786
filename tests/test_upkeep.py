"""Clean-up of what nothing reads any more, and workers without the package."""

from __future__ import annotations

import os
import subprocess
import sys
import tomllib
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from lapseflow import session
from lapseflow.plans.inputs import LOADED, moment
from lapseflow.session import clear_staged, scratch_path, stored
from lapseflow.sinks import dim_table

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """A shared folder of one test's own."""
    monkeypatch.setattr(session, "shared_folder", lambda spark: f"file://{tmp_path}/shared")
    return tmp_path / "shared" / "lapseflow"


def days(n: int) -> datetime:
    return datetime.now() + timedelta(days=n)


def test_old_staged_frames_go_and_streams_stay(spark, shared):
    assert clear_staged(spark, days(1)) == 0
    old, young = stored(spark.range(3), "old"), stored(spark.range(4), "young")
    for name in ("streams/mine", "someone-elses", f"streams-{'0' * 31}"):
        (shared / name).mkdir(parents=True)
    aged = next(shared.glob("old-*"))
    os.utime(aged, (0, 0))
    os.utime(shared / "streams", (0, 0))
    assert old.count() == 3 and clear_staged(spark, days(-1)) == 1
    assert not aged.exists() and young.count() == 4
    assert clear_staged(spark, days(1)) == 1
    assert sorted(p.name for p in shared.iterdir()) == ["someone-elses", "streams", f"streams-{'0' * 31}"]


def test_a_dimension_loses_what_no_version_needs(spark):
    path = scratch_path(spark, "test-upkeep")

    def load(*members, **options):
        rows = spark.createDataFrame([(m,) for m in members], "tld STRING")
        return dim_table.grow(spark, path, rows, "tld", moment(LOADED), whole=2, **options)

    assert dim_table.drop_unread(spark, path, days(1)) == 0
    load("a")
    # The first try of this load loses its version to the other, so its folder is left over.
    lost = [True]
    load("c", before_claim=lambda: lost and lost.pop() and load("b"))
    load("d")
    before = sorted((r.id, r.name) for r in dim_table.read(spark, path).collect())
    folders = lambda end: [p for p in Path(f"{path.removeprefix('file:')}{end}").iterdir() if not p.name.startswith(".")]
    now = dim_table.versions(spark, path)
    assert len(folders("")) > len(now) and dim_table.drop_unread(spark, path, days(-1)) == 0
    gone = len(folders("")) - len(now) + len(folders("-versions")) - len(now)
    assert dim_table.drop_unread(spark, path, days(1)) == gone > 0
    assert {p.name for p in folders("")} == {f for _, _, f in now} and len(folders("-versions")) == len(now)
    assert sorted((r.id, r.name) for r in dim_table.read(spark, path).collect()) == before
    after = load("a", "e")
    assert sorted(r.name for r in after.collect()) == ["a", "b", "c", "d", "e"]
    assert len({r.id for r in after.collect()}) == 5 and dim_table.versions(spark, path)[0][0] == now[0][0] + 1


def test_workers_get_the_package(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from lapseflow import session
spark = session.local_session("2", spark__checkpoint__dir="file://{tmp_path}/shared")
def name(batches):
    import lapseflow.schemas as found
    for batch in batches:
        yield batch.assign(at=found.__file__)
def where():
    return spark.range(1).mapInPandas(name, "id bigint, at string").first().at
try:
    where()
    print("no need")
except Exception as error:
    print("No module named 'lapseflow'" in str(error))
session.send_package(spark)
print("lapseflow.zip" in where())
"""
    plain = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=plain, capture_output=True, text=True, timeout=120)
    assert ran.stdout.split() == ["True", "True"], ran.stderr[-2000:]


def test_a_local_session_without_a_shared_folder_gets_one(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from lapseflow import session
spark = session.local_session("2")
folder = session.shared_folder(spark)
print(session.stored(spark.range(3), "three").count(), folder == session.shared_folder(spark))
"""
    # An empty folder of settings, so that none of this machine's hold.
    bare = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=bare, capture_output=True, text=True, timeout=120)
    assert ran.stdout.split() == ["3", "True"], ran.stderr[-2000:]


def test_the_project_file_names_what_the_package_imports():
    project = tomllib.loads((ROOT / "pyproject.toml").read_text())["project"]
    assert project["name"] == "lapseflow" and any(d.startswith("pyspark") for d in project["dependencies"])
