"""The stored domain table: appended domains, and a log of what lookups changed, bucketed alike.

Both are Parquet folders that Spark knows as tables, clustered and sorted by name and tld into equally
many buckets. A read joins the table to the newest change of each domain bucket by bucket: neither side is
shuffled, whatever their sizes. A domain's bucket is also its partition, so that a load looks
for its keys in the buckets they fall in only.

Domains are only ever appended. Answers go to the log, one partition per run: their cost follows the
answers and not the table, writers never touch each other's files, and a run that is repeated
replaces its own partition only, once its new files are complete. Folding the log merges it into one more
partition beside the runs and then names it, with the runs it covers, in a list of folds; until
that last small write nothing is different, and runs that came in meanwhile are not covered. Covered runs are
deleted later (:func:`drop_covered`), when no reader can still be at work on them.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapseflow import schemas
from lapseflow.operators.enrich import apply_answers, dated_answers, merge_answers
from lapseflow.operators.ingest import DOMAIN_KEY, in_layout
from lapseflow.session import stored

# Bucket count of a small table; a large one takes as many as give files of about 1 GB.
BUCKETS = 8
_DOMAINS = f"{schemas.DOMAIN}, bucket INT"
_CHANGES = f"{schemas.CHANGE}, run STRING"
_FOLDS = "fold STRING, covered STRING, number BIGINT"
_FOLD = "fold-"
# Bucket counts of tables seen by this process; a table's never changes.
_KNOWN: dict[str, int] = {}


def bucket_of(buckets: int) -> Column:
    """The bucket of a domain, as Spark's own bucketing numbers it."""
    return F.pmod(F.hash(*DOMAIN_KEY), F.lit(buckets)).cast("int")


def _read_or_empty(spark: SparkSession, path: str, layout: str) -> DataFrame:
    try:
        return spark.read.schema(layout).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], layout)


def buckets_of(spark: SparkSession, path: str, buckets: int = BUCKETS) -> int:
    """How many buckets the table at ``path`` has; a new one gets ``buckets`` and keeps them."""
    if path in _KNOWN:
        return _KNOWN[path]
    place, layout = f"{path}-layout", "buckets INT"
    found = _read_or_empty(spark, place, layout).first()
    if found is None:
        try:
            spark.createDataFrame([(buckets,)], layout).coalesce(1).write.parquet(place)
        except AnalysisException as error:
            # Another writer was first, and its count holds.
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        found = spark.read.schema(layout).parquet(place).first()
    return _KNOWN.setdefault(path, found.buckets)


def _table(spark: SparkSession, path: str, layout: str, partition: str, buckets: int) -> str:
    """The session's name for a bucketed folder, which other sessions may have changed meanwhile."""
    name = f"lapseflow_{md5(path.encode()).hexdigest()}"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({layout}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
        f"PARTITIONED BY ({partition}) CLUSTERED BY ({', '.join(DOMAIN_KEY)}) SORTED BY ({', '.join(DOMAIN_KEY)}) "
        f"INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    spark.catalog.refreshTable(name)
    return name


def _domains(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str:
    return _table(spark, path, _DOMAINS, "bucket", buckets_of(spark, path, buckets))


def _changes(spark: SparkSession, path: str) -> str:
    return _table(spark, f"{path}-changes", _CHANGES, "run", buckets_of(spark, path))


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """The domains as they were inserted, without later answers."""
    return spark.table(_domains(spark, path))


def candidates(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """The stored domains that may equal some of ``rows``: those in the buckets that the rows fall in.

    The files of other buckets aren't opened. What comes to the driver is a number per bucket at most.
    """
    hit = rows.select(bucket_of(buckets_of(spark, path)).alias("bucket")).distinct().collect()
    return read_domains(spark, path).where(F.col("bucket").isin([r.bucket for r in hit]))


def append_domains(rows: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Append new rows, gathered by bucket so that a load adds one file to each bucket it hits."""
    spark = rows.sparkSession
    name, n = _domains(spark, path, buckets), buckets_of(spark, path, buckets)
    placed = in_layout(rows.withColumn("bucket", bucket_of(n)), _DOMAINS)
    placed.repartition(n, *DOMAIN_KEY).write.mode("append").insertInto(name)


def _log(answers: DataFrame, path: str, run: str) -> None:
    spark = answers.sparkSession
    gathered = answers.repartition(buckets_of(spark, path), *DOMAIN_KEY)
    in_layout(gathered.withColumn("run", F.lit(run)), _CHANGES).write.mode("overwrite").insertInto(_changes(spark, path))


def append_changes(answers: DataFrame, path: str, run: str, as_of: Column) -> None:
    """Log the latest answers of one run; the same run again replaces what it logged."""
    if run.startswith(_FOLD):
        raise ValueError(f"the name of a run can't begin with {_FOLD!r}")
    _log(dated_answers(answers, as_of), path, run)


def _last_fold(spark: SparkSession, path: str) -> tuple[int, str | None, DataFrame]:
    """Number and name of the last fold, and the runs it covers; 0, None and nothing before the first."""
    folds = _read_or_empty(spark, f"{path}-folds", _FOLDS)
    # Of two folds with one number, made at the same time, either is whole.
    last = folds.orderBy(F.desc("number"), "fold").first()
    number, fold = (last.number, last.fold) if last else (0, None)
    mine = folds.where((F.col("number") == number) & (F.col("fold") == fold)).where("covered IS NOT NULL")
    return number, fold, mine.select(F.col("covered").alias("run"))


def _open(spark: SparkSession, path: str) -> DataFrame:
    """The last fold and the runs that it doesn't cover."""
    _, fold, covered = _last_fold(spark, path)
    log = spark.table(_changes(spark, path))
    runs = log.where(~F.col("run").startswith(_FOLD) | (F.col("run") == F.lit(fold)))
    # Names of runs that haven't been deleted yet: few, and narrow.
    return runs if fold is None else runs.join(F.broadcast(covered), "run", "left_anti")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The newest change of each domain; runs that a fold covers are not read again."""
    return merge_answers(_open(spark, path).drop("run"))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The domains with the newest answer of every source; both sides are joined where they lie."""
    return apply_answers(read_domains(spark, path), read_changes(spark, path), measured=False)


def fold_changes(spark: SparkSession, path: str) -> None:
    """Merge the log, so that a read has one row per changed domain and a short tail of runs."""
    number, _, covered = _last_fold(spark, path)
    now = _open(spark, path)
    # Runs that come in from here on are left to the next fold.
    seen = stored(now.select("run").distinct(), "runs")
    fold = f"{_FOLD}{uuid.uuid4().hex}"
    _log(merge_answers(now.join(F.broadcast(seen), "run", "left_semi").drop("run")), path, fold)
    # Runs that were deleted need no entry any more.
    kept = spark.table(_changes(spark, path)).select("run").distinct().join(covered, "run", "left_semi")
    runs = seen.where(~F.col("run").startswith(_FOLD)).unionByName(kept)
    name = F.lit(fold).alias("fold")
    lines = runs.select(name, F.col("run").alias("covered")).unionByName(
        spark.range(1).select(name, F.lit(None).cast("string").alias("covered"))
    )
    lines.coalesce(1).write.parquet(f"{path}-folds/number={number + 1}", mode="append")


def drop_covered(spark: SparkSession, path: str, before: datetime) -> int:
    """Delete what the last fold made needless and nobody has written to since ``before``; how many folders went.

    That are the runs it covers and earlier folds, with their lists. Choose ``before`` so that no read
    that began earlier is still running, nor a fold that hasn't been named yet. A run that
    went can't be repeated any more: its answers would count as new ones.
    """
    number, fold, covered = _last_fold(spark, path)
    if fold is None:
        return 0
    # Names of runs, not rows.
    gone = {r.run for r in covered.collect()}
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    unescaped = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def folders(place: str):
        root = jvm.org.apache.hadoop.fs.Path(place)
        files = root.getFileSystem(conf)
        for status in files.listStatus(root) if files.exists(root) else ():
            key, _, value = status.getPath().getName().partition("=")
            if value and status.getModificationTime() < before.timestamp() * 1000:
                yield files, status.getPath(), unescaped(value)

    dropped = 0
    for files, place, run in folders(f"{path}-changes"):
        if run in gone or (run.startswith(_FOLD) and run != fold):
            dropped += bool(files.delete(place, True))
    for files, place, own in folders(f"{path}-folds"):
        if int(own) < number:
            dropped += bool(files.delete(place, True))
    return dropped
