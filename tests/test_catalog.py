from tidewater import catalog
from tidewater.config import TableSettings


def test_setup_is_idempotent_and_describable(spark, scratch):
    s = TableSettings(schema="tw_test", table="created_users")
    catalog.setup_schema(spark, s, location=f"{scratch}/tbl")
    catalog.setup_schema(spark, s, location=f"{scratch}/tbl")
    assert "tw_test" in [r[0] for r in catalog.show_schemas(spark).collect()]
    assert "created_users" in [r.tableName for r in catalog.show_tables(spark, "tw_test").collect()]
    cols = [r.col_name for r in catalog.describe_table(spark, "tw_test", "created_users").collect()]
    assert cols[:2] == ["id", "first_name"]
    view = spark.createDataFrame([tuple(["1"] + [None] * 10)],
                                 ", ".join(f"{c} string" for c in cols[:11]))
    catalog.publish_view(spark, view, "tw_test", "created_users")
    assert spark.table("tw_test.created_users").count() == 1
