import pytest
from conftest import TESTDATA
from oracle import connect, differences

from meetmart.llm.queries import QUERIES, SQL

SF = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_row_has_its_result(spark, name):
    tables = {"op3": ("pages", "page_id"), "op7": ("embeddings", "vec_id"), "op13": ("conversations", "conv_id")}
    table, key = tables.get(name.split("_")[0], ("documents", "doc_id"))
    given = spark.read.parquet(f"{SF}/{table}.parquet").select(key)
    got = QUERIES[name](spark, SF)
    if name.startswith("op11"):
        assert got.where("step = 5").groupBy("part").count().where("count <> 120").count() == 0
        last = got.where("filter_order = 'ABCDE'").selectExpr("sum(removed) + sum(if(step = 5, kept, 0))").first()[0]
        assert last == given.count()
        return
    if name.startswith("op13"):
        assert got.where("depth = 0").first().n_convs == given.distinct().count()
        return
    if name.startswith("op7"):
        given, key = given.where("vec_id % 20 = 0"), "query_id"
    assert {r[0] for r in got.select(key).collect()} == {r[0] for r in given.collect()}
