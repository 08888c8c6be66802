"""Layout by several columns: rows stay whole, files hold short stretches of each column."""

import pytest
from pyspark.sql import functions as F

from siltstone.operators import layout
from siltstone.plans.spec import SpecError


def frame(spark, n=20_000):
    """Two columns without relation, one of them text; a third of the rows share an address."""
    address = F.format_string("10.%d.%d.7", F.col("h") % 200 + 10, F.shiftright("h", 9) % 256)
    df = spark.range(n).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 30)))
    return df.select("id", (F.col("id") * 1000).alias("at"), F.when(F.col("id") % 3 == 0, "10.9.9.9").otherwise(address).alias("address"))


def test_morton_keys_interleave_the_ranks(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)] + [(None, 3), (9, None)], "x int, y int")
    found = df.select("x", "y", layout.morton_key(df, {"x": [1, 2, 3], "y": [1, 2, 3]}, bits=2).alias("k")).collect()
    for x, y, k in found:
        a, b = min(x or 0, 3), min(y or 0, 3)
        assert k == (a >> 1) << 3 | (b >> 1) << 2 | (a & 1) << 1 | b & 1


def test_all_rows_stay_and_a_shared_value_is_no_single_file(spark, tmp_path):
    df = frame(spark)
    both, time = str(tmp_path / "both"), str(tmp_path / "time")
    layout.clustered(df, ["at", "address"], 64).write.parquet(both)
    layout.clustered(df, ["at"], 64).write.parquet(time)
    stored = spark.read.parquet(both)
    assert stored.columns == df.columns and stored.exceptAll(df).isEmpty() and df.exceptAll(stored).isEmpty()
    sizes = [r.rows for r in layout.file_ranges(stored, ["at"]).collect()]
    assert len(sizes) == 64 and max(sizes) < 20_000 / 64 * 3
    wanted = {"at": (0, 10_000_000), "address": ("10.50.0.0", "10.60.0.0")}
    assert layout.files_touched(stored, wanted) < layout.files_touched(spark.read.parquet(time), wanted)
    assert layout.files_touched(stored, {"address": ("10.50.0.0", "10.60.0.0")}) <= 32
    assert layout.files_touched(spark.read.parquet(time), {"address": ("10.50.0.0", "10.60.0.0")}) == 64


def test_filters_reach_the_scan_of_a_layout(spark, tmp_path):
    layout.clustered(frame(spark, 500), ["at", "address"], 4).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t")).filter("at < 1000 AND address > '10.5'").select("id")
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(at,1000)" in text and "GreaterThan(address,10.5)" in text


def test_edges(spark):
    empty = frame(spark).limit(0)
    assert layout.clustered(empty, ["at", "address"], 4).count() == 0
    nulls = spark.createDataFrame([(None, None)] * 5 + [(1, None), (None, "a"), (1, "a")], "k int, v string")
    assert layout.clustered(nulls, ["k", "v"], 3).exceptAll(nulls).isEmpty() and layout.clustered(nulls, ["k", "v"], 3).count() == 8
    same = spark.createDataFrame([(float("nan"), 1, {"a": 1}), (0.0, 1, {"a": 1})], "f double, n int, m map<string, int>")
    assert layout.clustered(same, ["f", "n"], 2).count() == 2
    for columns, reason in (([], "each once"), (["k", "k"], "each once"), (["z"], "no columns")):
        with pytest.raises(SpecError, match=reason):
            layout.clustered(nulls, columns, 2)
    with pytest.raises(SpecError, match="do not fit"):
        layout.morton_key(nulls, {"k": [1], "v": ["a"]}, bits=32)
