import pytest

from bookloom.plans import catalogue
from oracle import same

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalogue.all_oracles()))
def test_plan_agrees_with_sql(spark, name):
    same(spark, SF, catalogue.all_queries()[name], catalogue.all_oracles()[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
