"""Store files sized by AQE, reads of named folders, CSV types against Spark's own inference."""

from __future__ import annotations

import os
from datetime import date, timedelta

import pytest

from retention.session import scratch_path
from retention.sources.raw import infer_csv_schema, read_csv_inferred
from retention.sources.store import FeatureStore


def feature_rows(spark, days, n):
    return spark.range(n * days).selectExpr("cast(id % {0} as string) customer_id".format(n), "sha2(cast(id as string), 512) pad",
                                            "date_add(date'2024-01-01', cast(id div {0} as int)) snapshot_date".format(n)).repartition(12)


def files_by_date(root):
    return {d: len([f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")]) for d in os.listdir(root) if d.startswith("snapshot_date=")}


def test_files_follow_the_advisory_size(spark):
    """Two sizes of dates: small ones have a file each, of 100 as of 3; a large one is split."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256k")
    try:
        for days, n, least, most in ((3, 200, 1, 2), (100, 20, 1, 2), (1, 12_000, 4, 16)):
            store = FeatureStore(spark, scratch_path(spark, "t-files"))
            store.store_features(feature_rows(spark, days, n))
            found = files_by_date(store.features_root)
            assert len(found) == days and least <= min(found.values()) and max(found.values()) <= most, (days, found)
            assert store.load_features_range("2024-01-01", "2024-12-31").count() == days * n
    finally:
        spark.conf.set(name, before)


def test_reads_name_the_folders_they_want(spark):
    store = FeatureStore(spark, scratch_path(spark, "t-reads"))
    store.store_features(feature_rows(spark, 10, 5))
    day = lambda i: (date(2024, 1, 1) + timedelta(days=i)).isoformat()
    one = store.load_features(day(4))
    assert one.count() == 5 and {f.rsplit("/", 2)[1] for f in one.inputFiles()} == {f"snapshot_date={day(4)}"}
    assert one.first().snapshot_date.isoformat() == day(4)
    some = store.load_features_range(day(2), day(5))
    assert some.count() == 20 and len({f.rsplit("/", 2)[1] for f in some.inputFiles()}) == 4
    for none in (store.load_features("2030-01-01"), store.load_features_range("2030-01-01", "2031-01-01")):
        assert none.columns == one.columns and none.count() == 0


CSV = {
    "whole": "a,b,c\n1,2147483648,-5\n,3,+7\n9,4,\n",
    "mixed": "a,b,c,d\n1,2024-01-01,true,x\n2.5,2024-01-02 03:04:05,FALSE,1\n1e3,2024-01-03,,\n",
    "empty": "a,b\n,\n,\n",
    "texts": "a,b,c\n01x,2024-13-01,yes\n5,2024-01-01,true\n",
    "dates": "a,b\n2024-01-01,1\n2024-02-29,2024-01-01\n",
}


@pytest.mark.parametrize("name", CSV)
def test_csv_types_equal_sparks(spark, tmp_path, name):
    folder = tmp_path / name
    folder.mkdir()
    lines = CSV[name].strip("\n").split("\n")
    for k, part in enumerate((lines[1::2], lines[2::2])):  # several files: the result is merged
        (folder / f"p{k}.csv").write_text("\n".join([lines[0], *part]) + "\n")
    want = spark.read.option("header", True).option("inferSchema", True).csv(str(folder)).schema
    got = infer_csv_schema(spark, str(folder))
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in want]
    typed = read_csv_inferred(spark, str(folder))
    assert typed.schema == got and typed.count() == len(lines) - 1
