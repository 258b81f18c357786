"""Term search over stored trigram postings.

Every distinct label stands under each of its letter triples, in partitions by triple. A label like a
term shares so many of the term's triples that it must stand under one of the rarest of them: only
these postings are read, and what they give is compared with the term itself. Terms are a
table, so a thousand of them take the same plan as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapseflow.functions.text import trigrams
from lapseflow.operators.joins import is_small
from lapseflow.operators.search import SIMILAR
from lapseflow.session import stored

# Partitions of a small index; a large one takes as many as give files of about 1 GB.
PARTS = 64
_POSTINGS = "gram STRING, name STRING, size INT, part INT"
_GRAMS = "gram STRING, names BIGINT"


def _part(parts: int):
    return F.pmod(F.hash("gram"), F.lit(parts)).cast("int")


def build_index(names: DataFrame, path: str, label: str = "name", parts: int = PARTS) -> None:
    """Store the postings of all distinct labels, and how many labels each triple has. Null labels have none."""
    spark = names.sparkSession
    labels = names.select(F.col(label).alias("name")).where("name IS NOT NULL").distinct()
    grams = trigrams(F.col("name"))
    postings = labels.select("name", F.size(grams).alias("size"), F.explode(grams).alias("gram")).withColumn("part", _part(parts))
    # A common triple may fill several files; within each, triples lie together.
    dealt = postings.hint("rebalance", "part").sortWithinPartitions("part", "gram")
    dealt.select("gram", "name", "size", "part").write.partitionBy("part").parquet(f"{path}/postings")
    counts = spark.read.schema(_POSTINGS).parquet(f"{path}/postings").groupBy("gram").agg(F.count("name").alias("names"))
    counts.withColumn("parts", F.lit(parts)).write.parquet(f"{path}/grams")


def _asked(spark: SparkSession, path: str, terms: DataFrame, threshold: float) -> DataFrame:
    """(term, gram, part, size): the triples of each term under which all labels like it can be found.

    A label that shares ``need`` of a term's ``size`` triples has one of any ``size - need + 1`` of them.
    """
    grams = trigrams(F.col("term"))
    asked = terms.select(F.lower("term").alias("term")).where("term IS NOT NULL").distinct()
    each = asked.select("term", F.size(grams).alias("size"), F.explode(grams).alias("gram"))
    known = spark.read.schema(f"{_GRAMS}, parts INT").parquet(f"{path}/grams")
    rarest = W.partitionBy("term").orderBy(F.coalesce("names", F.lit(0)), "gram")
    need = F.ceil(F.lit(threshold) * F.col("size") - 1e-9)
    ranked = each.join(known, "gram", "left").withColumn("at", F.row_number().over(rarest))
    # Triples that no label has end here.
    few = ranked.where((F.col("at") <= F.col("size") - need + 1) & F.col("names").isNotNull())
    return few.select("term", "gram", F.pmod(F.hash("gram"), F.col("parts")).cast("int").alias("part"), "size")


def candidates(spark: SparkSession, path: str, terms: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """Distinct (term, name) pairs among which are all whose similarity reaches ``threshold``."""
    asked = stored(_asked(spark, path, terms, threshold), "asked")
    # A number per partition of the index at most.
    parts = [r.part for r in asked.select("part").distinct().collect()]
    postings = spark.read.schema(_POSTINGS).parquet(f"{path}/postings").where(F.col("part").isin(parts))
    wanted = asked.withColumnRenamed("size", "wanted")
    found = postings.join(F.broadcast(wanted) if is_small(wanted) else wanted, ["part", "gram"])
    # Sizes too far apart can't share enough.
    near = F.least("size", "wanted") >= F.lit(threshold) * F.greatest("size", "wanted") - 1e-9
    return found.where(near).select("term", "name").distinct()


def search_index(spark: SparkSession, path: str, terms: DataFrame, top: int = 10, threshold: float = SIMILAR) -> DataFrame:
    """The labels of the index that look like each ``term`` of a table, best first, as ``term_search`` finds them.

    Ties in similarity go to the smaller edit distance, then to the label.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie above 0 and be 1 at most")
    own, other = trigrams(F.col("name")), trigrams(F.col("term"))
    shared = F.size(F.array_intersect(own, other))
    similarity = shared / (F.size(own) + F.size(other) - shared)
    hits = (
        candidates(spark, path, terms, threshold)
        .select("name", "term", similarity.alias("similarity"))
        .where(F.col("similarity") >= threshold)
        .withColumn("distance", F.levenshtein("term", F.lower("name")))
    )
    best = W.partitionBy("term").orderBy(F.desc("similarity"), "distance", "name")
    return hits.withColumn("position", F.row_number().over(best)).where(F.col("position") <= top)
