"""Small tables that the driver holds: metadata rows in, a DataFrame of known size out."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def _plain(value):
    if isinstance(value, Row):
        return value.asDict(recursive=True)
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return value


def local_frame(spark: SparkSession, rows: Sequence, schema: str | T.StructType) -> DataFrame:
    """DataFrame of driver-held rows.

    Goes through Arrow, which makes it a local relation: unlike rows that are shipped as an RDD
    it has a size that Spark knows, so joins with it are planned by that size.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = schema.fieldNames()
    plain = [
        {n: _plain(v) for n, v in (r.items() if isinstance(r, dict) else zip(names, r))} for r in rows
    ]
    return spark.createDataFrame(pa.Table.from_pylist(plain, schema=to_arrow_schema(schema)), schema)
