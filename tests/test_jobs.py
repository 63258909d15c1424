import glob
import random
import subprocess
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import jobs, layout, ranks
from tidemark.plans import catalog


def test_ranks_agree_with_a_window(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice([1, 2, 2, 3, None])) for k in range(200)] + [(500 + k, "hot", 7) for k in range(100)]
    df = spark.createDataFrame(rows, "k long, g string, v int")
    got = {r.k: (r["rank"], r.dense_rank, r.reached) for r in ranks.value_ranks(df, "g", "v").collect()}
    over = "OVER (PARTITION BY g ORDER BY v DESC NULLS LAST)"
    want = df.selectExpr("k", f"rank() {over} AS a", f"dense_rank() {over} AS b", f"count(*) {over} AS c").collect()
    assert got == {r.k: (r.a, r.b, r.c) for r in want}
    assert ranks.value_ranks(df.limit(0), "g", "v").count() == 0


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_quantiles_agree_with_the_built_in_one(spark, share):
    rng = random.Random(5)
    rows = [(g, rng.choice([None, 1.0, 2.5, rng.uniform(0, 9)])) for g in "abc" for _ in range(37)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.q for r in ranks.quantiles(df, "g", "v", share, "q").collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", share).alias("q")).collect() if r.q is not None}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-9 for g in got)


@pytest.mark.parametrize("listed", [[], [None], [1, None], [1, 1, 5], [9]])
def test_not_in_is_that_of_sql(spark, listed):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    values = spark.createDataFrame([(x,) for x in listed], "v long")
    left.createOrReplaceTempView("l")
    values.createOrReplaceTempView("r")
    want = sorted(str(x.k) for x in spark.sql("SELECT * FROM l WHERE k NOT IN (SELECT v FROM r)").collect())
    assert sorted(str(x.k) for x in ranks.not_in(left, "k", values, "v").collect()) == want


def test_an_incremental_model_replaces_touched_periods_only(spark, tmp_path):
    rows = [(k, f"2024-01-{1 + k % 5:02d} 00:00:0{k % 9}", k % 5) for k in range(40)]
    source = spark.createDataFrame(rows, "k long, at string, period int").withColumn("at", F.col("at").cast("timestamp"))
    model = jobs.IncrementalModel(spark, str(tmp_path / "m"), "period", "at", lambda df: df.groupBy("period").agg(F.count("*").alias("n")))
    files = lambda p: set(glob.glob(f"{tmp_path}/m/rows/period={p}/*.parquet"))
    model.run(source.limit(0))
    model.run(source.filter("period < 4"))
    before = {p: files(p) for p in range(5)}
    model.run(source)
    assert files(0) == before[0] and files(3) == before[3] and files(4) and not before[4]
    model.run(source)
    got = {r.period: r.n for r in model.read("period int, n long").collect()}
    assert got == {p: 8 for p in range(5)}


def test_versions_are_loaded_once(spark):
    empty = spark.createDataFrame([], "k long, v string, valid_from string, valid_to string, version int, is_current boolean")
    step = lambda target, rows, day: jobs.load_versions(target, spark.createDataFrame(rows, "k long, v string"), ["k"], ["v"], F.lit(day))
    one = step(empty, [(1, "a"), (2, None), (2, None)], "d1")
    two = step(one, [(1, "b"), (2, None), (3, "c")], "d2")
    three = step(two, [(1, "b"), (2, "x")], "d3")
    got = [tuple(r) for r in three.collect()]
    want = [(1, "a", "d1", "d2", 1, False), (1, "b", "d2", None, 2, True), (2, None, "d1", "d3", 1, False), (2, "x", "d3", None, 2, True), (3, "c", "d2", None, 1, True)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_expiry_keeps_undated_rows(spark):
    df = spark.createDataFrame([(1, 2020), (2, 2024), (3, None)], "k long, y int")
    assert sorted(r.k for r in jobs.without_expired(df, "y", F.lit(2022)).collect()) == [2, 3]


def test_tiers_are_written_with_their_codecs(spark, tmp_path):
    df = spark.createDataFrame([(k, a) for k, a in enumerate([0, 364, 365, 1459, 1460, None])], "k long, age int")
    folders = jobs.archive(df, str(tmp_path), F.col("age"))
    got = {tier: sorted(r.k for r in spark.read.schema(df.schema).parquet(path).collect()) for tier, path in folders.items()}
    assert got == {"hot": [0, 1], "warm": [2, 3], "cold": [4, 5]}
    for tier, _, codec in jobs.TIERS:
        metas = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folders[tier]}/*.parquet")]
        assert {m.row_group(0).column(0).compression.lower() for m in metas if m.num_row_groups} == {codec}


def groups_met(path, column, low, high):
    """Row groups whose least and greatest values let them hold a value of the range, and all row groups."""
    met = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = next(c.statistics for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == column)
            total += 1
            met += stats.min <= high and stats.max >= low
    return met, total


def test_z_order_skips_by_either_column(spark, tmp_path):
    rng = random.Random(9)
    df = spark.createDataFrame([(rng.randrange(1000), rng.randrange(1000)) for _ in range(20_000)] + [(None, 5), (5, None)], "a long, b long").orderBy(F.rand(1))
    layout.write_z_ordered(df, str(tmp_path / "z"), ["a", "b"], 16)
    layout.write_sorted(df, str(tmp_path / "s"), ["a"], 16)
    assert spark.read.parquet(str(tmp_path / "z")).exceptAll(df).count() == 0 == df.exceptAll(spark.read.parquet(str(tmp_path / "z"))).count()
    by_b = [groups_met(str(tmp_path / kind), "b", 300, 320) for kind in ("z", "s")]
    assert by_b[1][0] == by_b[1][1] and by_b[0][0] <= by_b[0][1] // 2
    by_a = groups_met(str(tmp_path / "z"), "a", 300, 320)
    assert by_a[0] <= by_a[1] // 2


def test_sorted_files_have_bloom_filters_and_narrow_groups(spark, tmp_path):
    df = spark.range(5000).selectExpr("id AS k", "cast(pmod(hash(id), 900) AS long) AS c")
    layout.write_sorted(df, str(tmp_path / "p"), ["k"], 8, bloom=["c"])
    assert groups_met(str(tmp_path / "p"), "k", 100, 220)[0] <= 2
    file = pq.ParquetFile(sorted(glob.glob(f"{tmp_path}/p/*.parquet"))[0])
    assert file.metadata.row_group(0).num_rows > 0
    raw = Path(sorted(glob.glob(f"{tmp_path}/p/*.parquet"))[0]).read_bytes()
    assert len(raw) > 8 * file.metadata.num_rows // 2


def test_compaction_writes_as_few_files_as_the_bytes_need(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id AS k", "md5(cast(id AS string)) AS s")
    df.repartition(20).write.parquet(str(tmp_path / "small"))
    n, size = layout.stored_bytes(spark, str(tmp_path / "small"))
    assert n == 20 and size > 500_000
    layout.compact(spark, str(tmp_path / "small"), str(tmp_path / "large"), df.schema, file_bytes=size // 3)
    assert layout.stored_bytes(spark, str(tmp_path / "large"))[0] in (3, 4)
    assert spark.read.parquet(str(tmp_path / "large")).count() == 20_000


def test_recommendations_name_parts_for_every_customer(spark):
    root = "/root/testdata/sf0.001"
    got = catalog.queries()["J37_als_recommender"](spark, root).collect()
    buyers = spark.read.parquet(f"{root}/orders.parquet").join(spark.read.parquet(f"{root}/lineitem.parquet"), F.expr("l_orderkey = o_orderkey"))
    assert {r.user for r in got} == {r[0] for r in buyers.select("o_custkey").distinct().collect()}
    parts = {r[0] for r in buyers.select("l_partkey").distinct().collect()}
    assert all(r.item in parts for r in got) and {r["rank"] for r in got} == {1, 2, 3}


def test_registration_needs_no_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 300"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])
