"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Folders of local sessions without that setting, by application.
_LOCAL: dict[str, str] = {}


def local_session(cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lapseflow")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.applicationId in _LOCAL:
        return _LOCAL[spark.sparkContext.applicationId]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    # Spark doesn't let a running session change that setting, so it is remembered here.
    folder = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="lapseflow-")
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/lapseflow/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a frame that several branches of one job read: each branch then scans
    files instead of repeating the work, and lost executors cost only a re-read.
    ``options`` are the Parquet writer's.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_older(spark: SparkSession, path: str, before: datetime, wanted: Callable[[str], bool]) -> int:
    """Delete what lies in ``path``, was last written before ``before`` and has a wanted name; how many went."""
    files, root = file_system(spark, path)
    if not files.exists(root):
        return 0
    old = [s.getPath() for s in files.listStatus(root) if s.getModificationTime() < before.timestamp() * 1000]
    return sum(bool(files.delete(place, True)) for place in old if wanted(place.getName()))


_STAGED = re.compile(r".+-[0-9a-f]{32}")


def clear_staged(spark: SparkSession, before: datetime) -> int:
    """Delete the staged frames below the shared folder that were written before ``before``; how many went.

    Choose ``before`` so that no job, and no frame that was handed out, is older and still in use: their tasks may
    run again. The state of streams stays, and so does anything that :func:`scratch_path` didn't name.
    """
    path = f"{shared_folder(spark)}/lapseflow"
    return delete_older(spark, path, before, lambda name: _STAGED.fullmatch(name) is not None)


def send_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a cluster that doesn't have it installed.

    The archive lies in the shared folder, so executors that join later find it as well.
    """
    home, packed = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for module in sorted(home.rglob("*.py")):
            archive.write(module, module.relative_to(home.parent).as_posix())
    path = f"{scratch_path(spark, 'package')}/lapseflow.zip"
    files, place = file_system(spark, path)
    out = files.create(place, False)
    out.write(packed.getvalue())
    out.close()
    spark.sparkContext.addPyFile(path)
