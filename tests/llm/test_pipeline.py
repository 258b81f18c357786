from __future__ import annotations

import re
from pathlib import Path

import corpus_pipeline
import pytest

from lapseflow.llm import mixing, near_duplicates, quality, tokens
from lapseflow.llm.registry import table


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Input and output of every stage."""
    docs = table(spark, folder, "documents")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, folder), name)
        found[name] = docs, out
        docs = out
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_ids(stages):
    for name, (before, after) in stages.items():
        assert set(before.columns) <= set(after.columns)
        assert name == "mixing" or before.columns == after.columns
        old, new = texts(before), texts(after)
        assert set(new) <= set(old) and len(new) == after.count()
        assert name == "line_dedup" or all(new[i] == old[i] for i in new)


def test_quality_takes_the_rejected(spark, folder, stages):
    before, after = stages["quality"]
    scores = quality.quality_scores(before, table(spark, folder, "labels"))
    assert {r["doc_id"] for r in scores.where("predicted = 1").collect()} == set(texts(after))


def test_lines_stay_once(stages):
    before, after = stages["line_dedup"]
    seen = set()
    for text in (t for _, t in sorted(texts(after).items())):
        lines = [" ".join(x.lower().split()) for x in text.split("\n") if len(x.split()) >= 3]
        assert len(lines) == len(set(lines)) and not seen & set(lines)
        seen |= set(lines)
    old = {" ".join(x.lower().split()) for t in texts(before).values() for x in t.split("\n") if len(x.split()) >= 3}
    assert seen <= old


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    got = near_duplicates.near_duplicates(before)
    assert {r["doc_id"] for r in got.where("kept").collect()} == set(texts(after))
    sets = {}
    for i, text in texts(after).items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = [i for i in sets if sets[i]]
    assert not any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for k, i in enumerate(ids) for j in ids[:k])


def test_contaminated_documents_go(spark, folder, stages):
    before, after = stages["decontamination"]
    windows = set()
    for r in table(spark, folder, "benchmark").collect():
        w = tokens.spelled(r["text"], tokens.ALNUM)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    clean = set()
    for i, text in texts(before).items():
        w = tokens.spelled(text, tokens.ALNUM)
        if not any(tuple(w[k : k + 10]) in windows for k in range(len(w))):
            clean.add(i)
    assert set(texts(after)) == clean


def test_sample_has_its_probabilities(stages):
    _, after = stages["mixing"]
    assert after.where("probability <= 0 OR probability > 1").count() == 0
    assert after.where(mixing.uniform("doc_id") >= after["probability"]).count() == 0


def test_run_gives_the_last_stage(spark, folder, stages):
    assert texts(corpus_pipeline.run(spark, folder)) == texts(stages["mixing"][1])


def test_odd_and_empty_documents(spark, make, folder, odd_texts, tmp_path):
    target = tmp_path / "tables"
    make([]).write.parquet(f"{target}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, folder, name).limit(0).write.parquet(f"{target}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(target)).count() == 0
    docs = make([*enumerate(odd_texts), (3, odd_texts[-1]), (None, "no id at all"), (None, None)], clashing=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(target))
        assert out.columns == docs.columns
        docs = corpus_pipeline.stored(out, "odd")
    left = sorted((r["doc_id"] for r in docs.collect()), key=str)
    assert left.count(None) == 2 and {0, 1, 2, 3} <= set(left)
    assert corpus_pipeline.sampled(spark, docs, str(target)).count() >= 0


def test_the_package_stands_alone():
    root = Path(corpus_pipeline.__file__).parent
    for path in (root / "lapseflow").rglob("*.py"):
        if "llm" not in path.parts:
            assert "lapseflow.llm" not in path.read_text()
