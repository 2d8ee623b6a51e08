"""The stated columns of the queries, and their entry in the driver's contract."""

import __spark_entry__ as entry
from locuslathe.llm import queries

SF = "/root/testdata/sf0.001"


def test_columns(spark):
    want = {
        "p2_found": ["record_id"],
        "p4_found": ["record_id", "group_id"],
        "p6_ids": ["doc_id", "ids"],
        "p7_found": ["doc_id", "item_id"],
        "p8_found": ["doc_id", "char_from", "char_to"],
    }
    for name, cols in want.items():
        df = entry.queries()[name](spark, SF)
        assert df.columns == cols, name
        assert df.count() > 0 or name == "p7_found"


def test_every_query_is_entered():
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.SQL) <= set(entry.oracle_sql())


def test_every_document_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = entry.queries()["p6_ids"](spark, SF)
    assert ids.count() == docs.count() and ids.where("ids is null").count() == 0
