"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry_mod
from tramflow.plans import catalog


def test_entry_returns_fact_with_stable_schema(spark):
    df = entry_mod.entry(spark)
    assert df.schema.simpleString() == "struct<StopNo:int,VehicleNumber:string,Date:date,DepTime:string,Delay:int>"
    assert df.count() > 0


def test_every_query_has_an_oracle():
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert len(catalog.queries()) >= 40
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(qs) and set(sqls) <= set(qs)
