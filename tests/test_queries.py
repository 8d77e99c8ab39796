"""Every query against its SQL on sf0.01; the training-data queries are tested in tests/llm."""

import os

import pytest
from oracle import compare

SF = "/root/testdata/sf0.01"


def names():
    from tidegrid.plans.queries import QUERIES

    return sorted(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", names())
def test_query(spark, name):
    said = compare(spark, name, SF)
    assert said.startswith(("equal", "rows")), said
    assert not said.endswith(" 0")


def test_series_gap_counts_leaves_out_sensors_without_gaps(spark, tmp_path):
    import duckdb

    # a: no gap; b: one slot missing; null: no reading joins its grid
    rows = [("a", 0), ("a", 15), ("a", 30), ("b", 0), ("b", 30), (None, 0)]
    values = ", ".join(f"({k}, TIMESTAMP '2024-01-01' + INTERVAL {m} MINUTE, 1, {repr(s) if s else 'NULL'}, 1.5, '{{\"k\": 1}}')" for k, (s, m) in enumerate(rows))
    duckdb.sql(f"COPY (SELECT v.event_id::BIGINT AS event_id, v.ts, v.user_id::BIGINT AS user_id, v.event_type::VARCHAR AS event_type, v.value::DOUBLE AS value, v.props FROM (VALUES {values}) v(event_id, ts, user_id, event_type, value, props)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    assert compare(spark, "series_gap_counts", str(tmp_path)) == "equal 2"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["series_gap_counts", "features"])
@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_the_grid_does_not_depend_on_the_folder(spark, tmp_path, name, folder):
    (tmp_path / folder).mkdir()
    os.symlink(f"{SF}/events.parquet", tmp_path / folder / "events.parquet")
    assert compare(spark, name, str(tmp_path / folder)).startswith("equal")
