import contextlib
import io
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_checkpoint_dir=tempfile.mkdtemp(prefix="adledger-tests-"),
        spark_sql_warehouse_dir=tempfile.mkdtemp(prefix="adledger-warehouse-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def plan_of(df):
    """The formatted plan text, before it ran."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree_of(df):
    """The operator tree of the plan, without the details."""
    return plan_of(df).split("\n\n")[0]


@pytest.fixture
def folder(spark):
    from adledger.storage import run_folder

    return run_folder(spark, "test")


@pytest.fixture
def rows_of(spark):
    """Landing rows from dicts: scalars as text, nested columns as VARIANT from JSON text."""
    import json

    from pyspark.sql import functions as F, types as T

    from adledger import registry

    nested = {
        f.name for f in registry.landing_schema().fields if isinstance(f.dataType, T.VariantType)
    }

    def build(records, columns=None):
        columns = columns or sorted({c for r in records for c in r})
        data = [
            (i, *(json.dumps(r[c]) if c in nested and c in r else r.get(c) for c in columns))
            for i, r in enumerate(records)
        ]
        schema = "_seq long, " + ", ".join(f"{c} string" for c in columns)
        df = spark.createDataFrame(data, schema)
        return df.withColumns({c: F.try_parse_json(c) for c in columns if c in nested} or {"_seq": F.col("_seq")})

    return build
