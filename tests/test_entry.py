import os

import pytest

import __spark_entry__


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_entry_in_any_session(spark):
    spark.conf.unset("spark.sql.session.timeZone")
    out = __spark_entry__.entry(spark)
    assert out.columns[:2] == ["bucket_start", "hashtag"] and out.count() > 0
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
