from __future__ import annotations

import pytest

from coursegrain.sources import contracts, files

TEXTS = ["plain", 'say "hi", ok', "two\nlines", "", None, "trailing \\", "'q'", "a,b"]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(TEXTS)], "n int, s string")


def test_csv_round_trip(spark, texts, tmp_path, rows):
    path = files.publish(texts, str(tmp_path), "d", "t")
    assert path.endswith("/d/t/data")
    back = files.scan(spark, path, texts.schema, multiline=True)
    # NULL and empty text are both written empty and read as NULL.
    assert rows(back) == rows(texts.replace({"": None}, subset="s"))


def test_single_file_and_file_count(spark, texts, tmp_path):
    many = texts.repartition(4)
    for options, count in (({}, None), ({"single_file": True}, 1), ({"files": 3}, 3)):
        files.publish(many, str(tmp_path), "d", "t", **options)
        parts = list((tmp_path / "d/t/data").glob("part-*.csv"))
        assert len(parts) == (count or len(parts))


def test_parquet_tier(spark, texts, tmp_path, rows):
    path = files.publish(texts, str(tmp_path), "d", "t", fmt="parquet")
    assert rows(files.scan(spark, path, texts.schema, fmt="parquet")) == rows(texts)


def test_malformed_values_become_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,b\n1,true\nx,maybe\n")
    found = files.scan(spark, str(tmp_path), contracts.T.StructType.fromDDL("n int, b boolean"))
    assert [tuple(r) for r in found.collect()] == [(1, True), (None, None)]


def test_header_is_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("other,b\n1,2\n")
    schema = contracts.T.StructType.fromDDL("n int, b int")
    with pytest.raises(Exception, match="header"):
        files.scan(spark, str(tmp_path), schema).collect()
    assert tuple(files.scan(spark, str(tmp_path), schema, check_header=False).first()) == (1, 2)


def test_missing_input(spark, tmp_path):
    schema = contracts.T.StructType.fromDDL("n int")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.scan(spark, str(tmp_path / "none"), schema)
    assert files.try_scan(spark, str(tmp_path / "none"), schema) is None


def test_inferred_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,s\n1,x\n")
    assert files.scan(spark, str(tmp_path)).dtypes == [("n", "int"), ("s", "string")]


def test_report_is_readable(spark, texts, tmp_path):
    path = files.write_report(texts, str(tmp_path), "d", "t", "quality")
    assert path.endswith("/d/t/reports/quality") and spark.read.json(path).count() == len(TEXTS)


WIDTHS = {
    "contentobjects": 25, "audiovideoprocessed": 10, "discussionforums": 17, "gradeobjects": 31,
    "organizationalunits": 14, "quizobjects": 37, "releaseconditionsobjects": 14,
    "roledetails": 31,
}


def test_contract_widths():
    assert {name: len(s.raw_schema) for name, s in contracts.TABLES.items()} == WIDTHS


@pytest.mark.parametrize("spec", contracts.TABLES.values(), ids=lambda s: s.table)
def test_settings_name_real_columns(spec):
    clean = set(spec.clean_schema.names)
    used = {
        *spec.keys, *spec.null_columns, *spec.iso_columns, *spec.outlier_columns,
        *spec.clamped, *spec.dropped, *spec.redacted,
    }
    assert used <= clean
    assert not set(spec.dropped) & set(spec.published_schema.names)
    kinds = {f.name: f.dataType.typeName() for f in spec.clean_schema}
    assert {kinds[c] for c in spec.null_columns + spec.redacted} <= {"string"}
    assert {kinds[c] for c in spec.iso_columns} <= {"timestamp"}
    assert kinds["org_unit_id"] == "long" if "org_unit_id" in kinds else True


def test_white_space_around_values_is_published(spark, tmp_path):
    df = spark.createDataFrame([("  a ", 1), ("\t", 2)], "t string, i int")
    path = files.publish(df, str(tmp_path), "d", "t")
    assert sorted(map(tuple, files.scan(spark, path, df.schema).collect())) == [("\t", 2), ("  a ", 1)]


def test_parts_that_have_not_come_are_rows(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("n\n1\n2\n")
    schema = contracts.T.StructType.fromDDL("n int")
    inputs = {"a": (str(tmp_path / "a.csv"), schema), "b": (str(tmp_path / "b.csv"), schema)}
    assert rows(files.input_status(spark, inputs)) == [("a", True, 2), ("b", False, None)]


def test_contract_report(spark, tmp_path):
    (tmp_path / "a.csv").write_text('day,n,extra\n2020-01-02,1,x\nsoon,x,\n,"2",y\n')
    schema = contracts.T.StructType.fromDDL("n int, day date, gone string")
    found = [tuple(r) for r in files.contract_report(spark, str(tmp_path), schema).collect()]
    assert found == [
        ("n", "int", 0, 1, "moved", 3, 1),
        ("day", "date", 1, 0, "moved", 2, 1),
        ("gone", "string", 2, None, "missing", None, None),
        ("extra", None, None, 2, "unexpected", 2, 0),
    ]


def test_contract_report_of_a_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,s\n")
    schema = contracts.T.StructType.fromDDL("n int, s string")
    found = [tuple(r)[4:] for r in files.contract_report(spark, str(tmp_path), schema).collect()]
    assert found == [("ok", 0, 0), ("ok", 0, 0)]
