from pyspark.sql import functions as F

from tillworks.operators import constraints
from tillworks.schemas import SALES_SILVER_SPEC, TABLE_SPECS


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_row_checks(spark):
    df = spark.createDataFrame([("a", None, 1.0), (None, "x" * 51, 1e9), ("b", "ok", 99999999.99)], "k string, v string, m double")
    assert found(constraints.not_null_violations(df, ["k", "v"], ["k"])) == [("not_null:k", "?"), ("not_null:v", "a")]
    assert found(constraints.varchar_violations(df, {"v": 50, "k": 9}, ["k"])) == [("varchar:v", "?")]
    assert found(constraints.decimal_overflow(df, ["m"], ["k"])) == [("decimal:m", "?")]


def test_unique_ignores_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), ("b", 1)], "k string, n int")
    assert found(constraints.unique_violations(df, ["k", "n"], "pk")) == [("pk", "a/1", 2)]


def test_foreign_keys(spark):
    fact = spark.createDataFrame([("a", 1), ("a", 2), ("hot", 1), ("hot", 1), (None, 1)], "product_key string, date_key int")
    dims = {
        "dim_product": spark.createDataFrame([("a",)], "product_key string"),
        "dim_date": spark.createDataFrame([(1,)], "date_key int"),
    }
    references = {"product_key": "dim_product", "date_key": "dim_date"}
    assert found(constraints.foreign_key_orphans(fact, dims, references)) == [("fk:date_key", "2", 1), ("fk:product_key", "hot", 2)]
    assert found(constraints.foreign_key_accepted(fact, dims, references)) == [("a", 1)]


def test_serving_form(spark, sale):
    from tillworks.operators.cleanse import standardize

    served = constraints.to_serving(standardize(sale({})), SALES_SILVER_SPEC)
    assert served.schema["unit_price"].dataType.simpleString() == "decimal(10,2)"
    assert constraints.to_serving(served.drop("processed_at"), SALES_SILVER_SPEC).columns == SALES_SILVER_SPEC.schema.names
    long_name = served.withColumn("product_name", F.repeat(F.lit("x"), 101))
    assert long_name.where(constraints.acceptable(long_name, SALES_SILVER_SPEC)).count() == 0
    assert served.where(constraints.acceptable(served, SALES_SILVER_SPEC)).count() == 1


def test_every_reference_names_a_table():
    for spec in TABLE_SPECS.values():
        assert set(spec.references.values()) <= set(TABLE_SPECS)
        assert set(spec.not_null) | set(spec.max_length) | set(spec.money) <= set(spec.schema.names)
