import pytest

from leafmill.plans import registry

from .compare import same

@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, data, name):
    same(spark, data, registry.queries()[name], registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, data, name):
    df = registry.queries()[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry(spark, data):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert not set(__spark_entry__.oracle_sql()) - set(__spark_entry__.queries())
