"""Every registered catalog query against its SQL over the same tables."""

import pytest

from quadrangle.plans import catalog_queries as q
from quadrangle.plans import site_queries, store_queries  # noqa: F401  (they register more)


@pytest.mark.parametrize("name", list(q.oracle_sql()))
def test_same_as_sql(name, same_as_sql):
    same_as_sql(q.queries()[name], q.oracle_sql()[name])


@pytest.mark.parametrize("name", [n for n in q.queries() if n not in q.oracle_sql()])
def test_has_rows(name, spark, sf_dir):
    assert q.queries()[name](spark, sf_dir).take(1)


@pytest.mark.parametrize("name", ["q_consolidation_plan", "q_missing_export_batches", "q_argmax_candidate", "q_reject_reasons"])
def test_number_of_partitions_does_not_matter(name, spark, sf_dir):
    found = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(str, q.queries()[name](spark, sf_dir).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).take(1)
