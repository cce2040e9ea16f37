"""The JVM compiles methods of at most 8,000 bytes of code: no stage of any query may have a larger one."""

import pytest

from webstrata.plans.page_queries import QUERIES

LIMIT = 8000


@pytest.fixture
def one_plan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def largest_method(spark, df):
    package = getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$")
    stages = getattr(package, "MODULE$").codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max((stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())), default=0)


def test_methods_are_small_enough_to_be_compiled(spark, sf_dir, one_plan):
    sizes = {name: largest_method(spark, query(spark, sf_dir)) for name, query in QUERIES.items()}
    assert {name: n for name, n in sizes.items() if n > LIMIT} == {}
    assert max(sizes.values()) > 3000  # the measure works
