from __future__ import annotations

import collections

import corpus_pipeline
import pytest

from coursegrain.llm import toxicity
from coursegrain.llm.common import read, stored

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returned, the documents first."""
    found = [read(spark, SMALL, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], SMALL)))
    return found


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near-dedup", "suffix dedup", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_all_but_the_last_return_documents(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes and df.count() > 0


def test_rejected_documents_are_the_toxic_ones(spark, stages):
    marks = toxicity.classify(stages[0], read(spark, SMALL, "labels"))
    clean = {r.doc_id for r in marks.where("predicted = 0").collect()}
    assert {r.doc_id for r in stages[1].collect()} == clean


def test_later_passages_of_lines_go(stages):
    """Of three lines in a row, all but the first occurrence, by id and place."""
    given = sorted((r.doc_id, r.text) for r in stages[1].collect())
    seen, want = set(), {}
    for doc_id, text in given:
        lines = text.split("\n")
        held = [i for i, x in enumerate(lines) if x.strip()]
        gone = set()
        for places in zip(held, held[1:], held[2:]):
            passage = tuple(lines[i] for i in places)
            gone |= set(places) if passage in seen else set()
            seen.add(passage)
        want[doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    assert len(want) == len(given)
    assert {r.doc_id: r.text for r in stages[2].collect()} == want


def test_nulls_and_empty_tables_through_all_stages(spark, stages):
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, None, "s", None), (None, "short text", "en", None, 10)]
    for rows in ([], odd, odd * 2):
        docs = spark.createDataFrame(rows, stages[0].schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SMALL))
        # All texts differ from each other but for the repeats.
        assert docs.select("doc_id").distinct().count() == (3 if rows else 0), name


def test_one_of_each_group_stays(stages):
    from test_dedup import classes_by_brute_force

    texts = {r.doc_id: r.text for r in stages[2].collect()}
    roots = classes_by_brute_force(texts)
    assert {r.doc_id for r in stages[3].collect()} == set(roots.values())


def test_no_long_string_is_left_twice(stages):
    from test_dedup import cut_by_brute_force

    given = [(r.doc_id, r.text) for r in stages[3].collect()]
    want = cut_by_brute_force([t.encode() for _, t in given], corpus_pipeline.PASSAGE)
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    assert texts == {i: w[3].decode(errors="replace") for (i, _), w in zip(given, want)}


def test_everything_is_packed(spark, stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in stages[4].collect()}
    fill = collections.Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and sum(n < 2048 for n in fill.values()) <= len(fill)
    assert corpus_pipeline.run(spark, SMALL).count() == len(rows)


def test_entry_works_without_the_subpackage(tmp_path):
    """What stays after both are deleted still imports."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    shutil.copytree(root / "coursegrain", tmp_path / "coursegrain", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert 'pipeline' not in e.queries() and len(e.queries()) > 100"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "", "PYTHONPATH": str(tmp_path)}, check=True)
