import pytest
from pyspark.sql import types as T

from adledger import registry


def test_sizes_and_types():
    schema = registry.schema_for("insights")
    classes = registry.field_classes("insights")
    assert len(schema) == 42
    assert {c: len(n) for c, n in classes.items()} == {
        "float": 9, "int": 5, "date": 2, "str": 14, "nested": 12
    }
    assert schema["spend"].dataType == T.DoubleType()
    assert schema["clicks"].dataType == T.LongType()
    assert schema["date_stop"].dataType == T.DateType()
    assert schema["actions"].dataType.simpleString() == "array<struct<action_type:string,value:bigint>>"
    assert schema["website_ctr"].dataType.simpleString() == "array<struct<action_type:string,value:double>>"
    assert schema["spend"].metadata["comment"]


def test_required_columns_and_unknown_schema():
    kpi = registry.schema_for("kpi_mapping")
    assert [f.name for f in kpi.fields if not f.nullable] == ["user_friendly_name", "meta_action_type"]
    with pytest.raises(ValueError, match="unknown schema"):
        registry.schema_for("other")


def test_scan_fields_are_two_more():
    assert len(registry.scan_fields()) == 44
    assert set(registry.scan_fields()) - set(registry.schema_for("insights").names) == {
        "action_values", "purchase_roas"
    }


def test_conform_drops_unknown_and_adds_missing(spark):
    df = registry.conform(spark.sql("SELECT 'a' AS ad_id, 1 AS unknown"))
    assert df.columns == registry.schema_for("insights").names
    row = df.first()
    assert row.ad_id == "a" and row.spend is None


def test_updatable_columns(spark):
    df = registry.conform(spark.sql("SELECT 'a' AS ad_id"))
    assert len(registry.updatable_columns(df)) == 39
    assert len(registry.updatable_columns(df, registry.UPSERT_KEYS)) == 39
