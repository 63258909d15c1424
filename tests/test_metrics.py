from datetime import datetime

from compare import duck

from tidemark.plans import catalog

ROOT = "/root/testdata/sf0.001"


def days(user, kind, *listed):
    return [(user, kind, datetime(2024, 1, day, 12)) for day in listed]


def test_churn_risk_counts_every_visit(spark, tmp_path):
    """Events of any kind, or of none, are visits: they open and close gaps as purchases do."""
    rows = [
        *days(1, "purchase", 1, 20), *days(1, "view", 7, 14),  # purchases far apart, visits between
        *days(2, "view", 1, 12),  # never buys
        *days(3, "click", 1), *days(3, "purchase", 10), *days(3, "error", 12),
        *days(4, "view", 1, 8, 8), *days(5, "view", 1, 9),  # seven days, and one more
        *days(6, "view", 4), *days(7, None, 1, 15), (8, "view", None), *days(8, "view", 1, 3),
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    events = spark.createDataFrame([(k, ts, user, kind, 1.0, "{}") for k, (user, kind, ts) in enumerate(rows)], schema)
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(map(tuple, catalog.queries()["I37_churn_risk"](spark, str(tmp_path)).collect()))
    assert got == [(2, 11), (3, 9), (5, 8), (7, 14)]

    con = duck(ROOT)
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert sorted(con.execute(catalog.check_sql()["I37_churn_risk"]).fetchall()) == got
