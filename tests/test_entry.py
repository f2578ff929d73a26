import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and "accepted_count" in df.columns


def test_every_query_has_oracle_or_is_analytic():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    # the optional training-data queries are tested in their own folder
    analytic = {k for k in set(q) - set(sql) if k != "pipeline" and not re.match(r"op\d+_", k)}
    assert not analytic


def test_stream_equals_batch(spark):
    q = entry.queries()
    a = q["route_stream"](spark, SF)
    b = q["route_reviews"](spark, SF)
    assert sorted(a.columns) == sorted(b.columns)
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count()
