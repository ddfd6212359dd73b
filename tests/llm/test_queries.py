import pytest
from catalog.check import difference, duck
from viewpulse.llm.queries import QUERIES
from viewpulse.llm.sql import ORACLES


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, sf, name):
    ours = QUERIES[name](spark, sf).toPandas()
    assert len(ours)
    assert difference(ours, duck(sf).execute(ORACLES[name]).df()) is None


def test_one_query_for_every_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


def test_workers_need_no_package_on_their_path(spark, sf):
    assert QUERIES["op2_simhash"](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
