import pytest

from mentionwise.sinks.writers import load_warehouse, read_version

TOTALS = "year string, month string, day string, player string, total int"


def test_a_failed_strict_load_leaves_the_table(spark, tmp_path):
    target = str(tmp_path / "warehouse")
    load_warehouse(spark.createDataFrame([("2022", "08", "09", "A", 2)], TOTALS), target, strict=True)
    with pytest.raises(Exception):
        load_warehouse(spark.createDataFrame([("2022", "08", "10", None, 1)], TOTALS), target, strict=True)
    assert [r["total"] for r in read_version(spark, target).collect()] == [2]
