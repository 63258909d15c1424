"""Faults that once dropped or brought back data."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.changes import apply_changes, merge_by_key, update_columns, upsert
from tidemark.sources import external, files, publish
from tidemark.streaming.run import each_batch, file_stream

LOG = "before struct<k: int, v: string>, after struct<k: int, v: string>, op string, ts_ms long, offset long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_null_delete_flag_keeps_the_row(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "x", None), (2, "y", True), (3, "z", False)], "k int, v string, gone boolean")
    assert rows(merge_by_key(target, source, ["k"], "gone")) == [(1, "x"), (3, "z")]


def test_update_to_null(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(update_columns(target, updates, ["k"], ["v"])) == [(1, None), (2, "b")]


def test_changed_key_ends_the_old_one(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    log = spark.createDataFrame([((1, "a"), (9, "a"), "u", 1, 0)], LOG)
    assert rows(apply_changes(target, log, ["k"])) == [(9, "a")]


def test_null_op_is_an_upsert_and_deletes_delete(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    log = spark.createDataFrame([(None, (3, "c"), None, 1, 0), ((2, "b"), None, "d", 1, 1)], LOG)
    assert rows(apply_changes(target, log, ["k"])) == [(1, "a"), (3, "c")]


def test_upsert_refuses_two_rows_of_a_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="come once"):
        upsert(target, twice, ["k"]).collect()
    assert rows(upsert(target, twice.limit(1), ["k"])) == [(1, "b")]


def test_summary_forgets_emptied_groups_and_redoes_null_ones(spark, tmp_path):
    def build(df):
        return df.groupBy("p", "d").agg(F.sum("x").alias("x"))

    summary = publish.StoredSummary(spark, str(tmp_path), "p", "p int, d string, x long", build)
    first = spark.createDataFrame([(1, "d1", 1), (1, "d2", 2), (2, "d3", 3), (0, None, 3)], "p int, d string, x int")
    summary.refresh(first)
    later = spark.createDataFrame([(1, "d1", 1), (0, None, 30)], "p int, d string, x int")
    changed = spark.createDataFrame([(1,), (2,), (0,)], "p int")
    summary.refresh_touched(later, changed)
    assert rows(summary.read().select("d", "x")) == [("d1", 1), (None, 30)]


def test_delta_store_replays_empties_and_compacts(spark, tmp_path):
    empty = spark.createDataFrame([], "k int, v string")
    store = publish.DeltaStore(spark, str(tmp_path), LOG, lambda log: apply_changes(empty, log, ["k"]))
    store.add(spark.createDataFrame([(None, (1, "a"), "c", 1, 0)], LOG), 0)
    store.add(spark.createDataFrame([((1, "a"), None, "d", 2, 0)], LOG), 1)
    assert rows(store.read()) == []
    store.add(spark.createDataFrame([(None, (2, "b"), "c", 3, 0)], LOG), 2)
    store.add(spark.createDataFrame([(None, (2, "b"), "c", 3, 0)], LOG), 2)  # a replay
    assert rows(store.read()) == [(2, "b")]


def test_sums_survive_compaction_and_a_replay(spark, tmp_path):
    store = publish.DeltaStore(spark, str(tmp_path), "k int, n long", lambda r: publish.merge_partials(r, ["k"], ["n"]))
    for batch in (0, 1, 1):
        store.add(spark.createDataFrame([(1, 5)], "k int, n long"), batch)
    store.compact(1)
    store.add(spark.createDataFrame([(1, 2), (2, 1)], "k int, n long"), 2)
    assert rows(store.read()) == [(1, 12), (2, 1)]


def test_bad_rows_are_kept_apart_and_blank_lines_are_none(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('k,v\n1,a\n\nx,b\n2,"two\nlines"\n')
    found = files.read_with_rejects(spark, str(path), "k int, v string")
    good = found.filter(F.col(files.CORRUPT).isNull()).select("k", "v")
    assert rows(good) == [(1, "a"), (2, "two\nlines")]
    assert found.filter(F.col(files.CORRUPT).isNotNull()).count() == 1


def test_malformed_messages_are_rejected_with_their_text(spark):
    texts = spark.createDataFrame([('{"a": 1}',), ("{torn",), (None,), ('{"a": "x"}',)], "value string")
    found = external.parse_json_value(texts, "a int")
    assert sorted(r.rejected for r in found.collect() if r.rejected is not None) == ["", '{"a": "x"}', "{torn"]


def test_stream_of_a_folder_with_a_slash_and_of_one_file(spark, tmp_path):
    spark.range(5).repartition(1).write.parquet(f"{tmp_path}/in")
    seen = []
    each_batch(file_stream(spark, f"{tmp_path}/in/", "id long"), lambda df, _: seen.append(df.count()), f"{tmp_path}/c")
    assert sum(seen) == 5
    one = next((tmp_path / "in").glob("part-*.parquet"))
    each_batch(file_stream(spark, str(one), "id long"), lambda df, _: seen.append(df.count()), f"{tmp_path}/c2")
    assert sum(seen) == 10


def test_rows_of_any_status_are_appended(spark, tmp_path):
    import __spark_entry__ as driver

    kinds = [(1, "F"), (2, None), (3, "X")]
    data = [(k, 1, s, 1.0, None, None) for k, s in kinds]
    from tidemark.sources.tables import SCHEMAS

    spark.createDataFrame(data, SCHEMAS["orders"]).write.parquet(f"{tmp_path}/orders.parquet")
    got = driver.queries()["A17_append_write"](spark, str(tmp_path))
    assert rows(got) == [("F", 1), ("X", 1), (None, 1)]
