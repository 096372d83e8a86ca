"""Pages made from a small file reach many tasks."""

from tidemill import catalog
from tidemill.plans import testbed

SF = "/root/testdata/sf0.001"


def test_pages_with_tables_are_dealt_to_many_tasks(spark):
    pages = catalog.queries()["html_tables"](spark, SF)
    assert pages.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert pages.count() == testbed.table(spark, SF, "customer").count()
