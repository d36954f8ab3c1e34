"""Landing folders whose files differ in schema."""

import pytest

from shopledger.sources.landing import DriftingLanding, file_schemas, list_files, load_by_schema, load_report, schema_groups
from shopledger.sources.reader import load_parquet, rescue

DECLARED = {"id": "bigint", "amount": "decimal(10,2)", "note": "string"}


def _land(spark, folder, *statements):
    for sql in statements:
        spark.sql(sql).coalesce(1).write.mode("append").parquet(folder)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "with space" / "t.parquet")
    _land(
        spark,
        path,
        "SELECT 1L AS id, CAST(1.50 AS DECIMAL(10,2)) AS amount, 'a' AS note",
        "SELECT 2L AS id, CAST(2.50 AS DECIMAL(10,2)) AS amount, 'b' AS note",
        "SELECT '3' AS id, 'many' AS amount, 'c' AS note",
        "SELECT 4 AS id, 'd' AS note, DATE'2024-01-01' AS late",
        "SELECT 5L AS id, 5.255D AS amount",
    )
    return path


def test_files_alike_are_one_group(spark, folder):
    listed = list_files(spark, folder)
    assert listed.count() == 5
    schemas = [r.columns for r in file_schemas(listed).collect()]
    assert sorted(len([s for s in schemas if s == t]) for t in set(schemas)) == [1, 1, 1, 2]
    groups = schema_groups(spark, folder)
    assert sorted(map(len, groups)) == [1, 1, 1, 2]
    assert sum(groups, []) and all(f.endswith(".parquet") for g in groups for f in g)


def test_every_row_comes_through_with_what_did_not_fit(spark, folder):
    from decimal import Decimal as D

    loaded = load_by_schema(spark, folder, DECLARED)
    assert [c for c, _ in loaded.dtypes] == [*DECLARED, "_rescued_data"]
    assert _rows(loaded) == _rows(spark.createDataFrame([
        (1, D("1.50"), "a", None), (2, D("2.50"), "b", None), (3, None, "c", '{"amount":"many"}'),
        (4, None, "d", '{"late":"2024-01-01"}'), (5, None, None, '{"amount":"5.255"}'),
    ], loaded.schema))
    # one scan for each schema, and no column of other files in any of them
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 4
    # where types agree it equals the load that merges schemas
    files = [f for g in schema_groups(spark, folder) if len(g) == 2 for f in g]
    same = rescue(spark.read.parquet(*files), DECLARED)
    assert _rows(same) == [r for r in _rows(loaded) if r[0] in (1, 2)]


def test_merging_the_schemas_of_these_files_fails(spark, folder):
    with pytest.raises(Exception, match="(?i)merge"):
        load_parquet(spark, folder).collect()


def test_one_file_and_no_file(spark, tmp_path):
    empty = tmp_path / "none"
    empty.mkdir()
    loaded = load_by_schema(spark, str(empty), DECLARED)
    assert loaded.collect() == [] and loaded.columns == [*DECLARED, "_rescued_data"]
    _land(spark, str(tmp_path / "one"), "SELECT 1L AS id WHERE false")
    assert load_by_schema(spark, str(tmp_path / "one"), DECLARED).collect() == []


def test_the_report_counts_rows_and_names_columns(spark, folder, tmp_path):
    root = str(tmp_path / "with space")
    _land(spark, f"{root}/clean.parquet", "SELECT 1L AS id, 'x' AS note")
    landing = DriftingLanding(spark, root, {"t": DECLARED, "clean": {"id": "bigint", "note": "string"}, "void": {"id": "bigint"}})
    (tmp_path / "with space" / "void.parquet").mkdir()
    found = {r.table_name: (r.rows, r.rescued_rows, r.rescued_columns) for r in load_report(landing, ["t", "clean", "void"]).collect()}
    assert found == {"t": (5, 3, "amount,late"), "clean": (1, 0, ""), "void": (0, 0, "")}
