from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lapseflow.llm import mixing as d

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rake(cells, goals, budget, tolerance):
    """Probabilities, and how many sweeps they took."""
    total = sum(cells.values())
    mass, sweeps, moved = {c: n / total for c, n in cells.items()}, 0, 1
    while moved > tolerance:
        before, sweeps = mass, sweeps + 1
        for k, goal in enumerate(goals):
            sums = defaultdict(float)
            for c, m in mass.items():
                sums[c[k]] += m
            mass = {c: min(m * goal[c[k]] / sums[c[k]] if sums[c[k]] else 0, cells[c] / total / budget) for c, m in mass.items()}
        moved = max(abs(sum(mass[c] - before[c] for c in cells if c[k] == v)) for k, goal in enumerate(goals) for v in goal)
    return {c: 1.0 if not cells[c] else min(1, budget * mass[c] * total / cells[c]) for c in cells}, sweeps


def test_raking_equals_brute_force(spark):
    cells = {(s, x, t): (i * 37 + 11) % 50 * 10 for i, (s, x, t) in enumerate((s, x, t) for s in "abcde" for x in "xyz" for t in "12")}
    goals = []
    for k in range(3):
        own = defaultdict(float)
        for c, n in cells.items():
            own[c[k]] += n
        roots = {v: n**0.5 for v, n in own.items()}
        goals.append({v: r / sum(roots.values()) for v, r in roots.items()})
    df = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens bigint")
    targets = {n: d.targets(df, n, 0.5) for n in d.DIMENSIONS}
    got = {(r["source"], r["lang"], r["topic"]): r["probability"] for r in d.rake(df, targets).collect()}
    want, sweeps = rake(cells, goals, d.BUDGET, d.TOLERANCE)
    assert sweeps > 1 and all(abs(got[c] - want[c]) < 1e-9 for c in cells)


def test_marginals_are_met(spark):
    # Without cells at their limit the sample's expected shares are the targets.
    df = spark.createDataFrame(
        [(s, x, t, n) for s, n in (("a", 500), ("b", 300)) for x in "xy" for t in "12"], "source string, lang string, topic string, tokens bigint"
    )
    goals = {
        "source": spark.createDataFrame([("a", 0.4), ("b", 0.6)], "source string, target double"),
        "lang": spark.createDataFrame([("x", 0.55), ("y", 0.45)], "lang string, target double"),
        "topic": spark.createDataFrame([("1", 0.5), ("2", 0.5)], "topic string, target double"),
    }
    raked = d.rake(df, goals, budget=0.3, tolerance=1e-6)
    assert all(abs(r["target"] - r["reached"]) < 1e-3 for r in d.deviations(raked, goals, 0.3).collect())
    got = raked.withColumn("kept", F.col("tokens") * F.col("probability"))
    total = got.agg(F.sum("kept")).first()[0]
    assert abs(total - 0.3 * 3200) < 1
    for name, goal in goals.items():
        want = {r[0]: r[1] for r in goal.collect()}
        assert all(abs(r["k"] / total - want[r[name]]) < 1e-3 for r in got.groupBy(name).agg(F.sum("kept").alias("k")).collect())


def test_targets_out_of_reach_are_reported(spark):
    # Nine tenths of the sample can't come from a tenth of the tokens.
    cells = spark.createDataFrame([("a", 900), ("b", 100)], "source string, tokens bigint")
    goals = {"source": spark.createDataFrame([("a", 0.1), ("b", 0.8), ("c", 0.1)], "source string, target double")}
    raked = d.rake(cells, goals, budget=0.5)
    got = {r["value"]: (r["target"], round(r["reached"], 6)) for r in d.deviations(raked, goals, 0.5).collect()}
    assert got == {"a": (0.1, 0.1), "b": (0.8, 0.2), "c": (0.1, 0.0)}
    assert {r["source"]: round(r["probability"], 6) for r in raked.collect()} == {"a": round(0.05 / 0.9, 6), "b": 1.0}
    with pytest.warns(UserWarning, match="after 1 sweeps"):
        d.rake(cells, goals, most=1)
    none = d.deviations(cells.limit(0).withColumn("probability", F.lit(1.0)), goals)
    assert {r["reached"] for r in none.collect()} == {0.0}


def test_sample_follows_the_probabilities(spark, prose):
    rows = [(i, prose(i, 20 + i % 7), "en" if i % 3 else "de", "hot" if i % 10 else f"s{i % 20}", 0) for i in range(2000)]
    got = d.mixed(spark.createDataFrame(rows, SCHEMA))
    tokens = {i: len(t.split()) for i, t, *_ in rows}
    sample = got.collect()
    assert all(r["n_tokens"] == tokens[r["doc_id"]] for r in sample)
    kept, total = sum(r["n_tokens"] for r in sample), sum(tokens.values())
    weighted = sum(r["n_tokens"] / r["probability"] for r in sample)
    assert abs(weighted / total - 1) < 0.1 and 0.3 * total < kept < 0.55 * total


def test_odd_rows(spark, odd_texts):
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "", 0) for i, t in enumerate(odd_texts)]
    rows += [(None, "a b", "en", "x", 0), (8, "same row", "en", "x", 0), (8, "same row", "en", "x", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "doc_id AS topic", "doc_id AS tokens", "doc_id AS probability", "doc_id AS mass")
    got = d.mixed(docs, budget=1.0, temperature=1.0).collect()
    # The mix as it is and the whole budget keep everything.
    assert sorted((r["doc_id"] for r in got), key=str) == [0, 1, 2, 3, 4, 8, 8, None]
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {0: 0, 1: 0, 2: 0, 3: 2, 4: 30_000, 8: 2, None: 2}
    assert d.mixed(docs.limit(0)).count() == 0
    assert d.mixed(spark.createDataFrame([(1, None, "en", "x", 0)], SCHEMA)).count() == 1
