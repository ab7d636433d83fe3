"""What ``to_json`` writes, ``parse_events`` reads back."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.functions import parse_events

DDL = (
    "s string, b binary, d date, t timestamp, f float, g double, n decimal(20,4), y tinyint, h smallint, i int, l bigint, "
    "o boolean, st struct<a: int, d: date, xs: array<timestamp>>, ai array<int>, ad array<date>, ast array<struct<k: string, v: double>>, "
    "aa array<array<bigint>>, m map<string, int>, md map<string, date>, ms map<string, struct<x: int, y: array<string>>>"
)


def value(rng, dtype):
    if rng.random() < 0.15:
        return None
    if isinstance(dtype, T.StringType):
        return "".join(rng.choice('ab{}[]":\\\n é€\U0001f600-0') for _ in range(rng.randrange(8)))
    if isinstance(dtype, T.BinaryType):
        return bytearray(rng.randbytes(rng.randrange(1, 9)))
    if isinstance(dtype, T.DateType):
        return dt.date(1950, 1, 1) + dt.timedelta(days=rng.randrange(40000))
    if isinstance(dtype, T.TimestampType):
        return dt.datetime(1990, 1, 1) + dt.timedelta(milliseconds=rng.randrange(10**12))
    if isinstance(dtype, T.FloatType):
        return float(rng.randrange(-1000, 1000)) / 8
    if isinstance(dtype, T.DoubleType):
        return rng.uniform(-1e9, 1e9)
    if isinstance(dtype, T.DecimalType):
        return decimal.Decimal(rng.randrange(-(10**12), 10**12)).scaleb(-4)
    if isinstance(dtype, T.BooleanType):
        return rng.random() < 0.5
    if isinstance(dtype, T.StructType):
        return tuple(value(rng, f.dataType) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return [value(rng, dtype.elementType) for _ in range(rng.randrange(4))]
    if isinstance(dtype, T.MapType):
        return {f"k{n}": value(rng, dtype.valueType) for n in range(rng.randrange(4))}
    bits = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 62}[type(dtype)]
    return rng.randrange(-(2**bits), 2**bits)


# With an object where a list is expected, all of it goes through the exact pass.
@pytest.mark.parametrize("extra", ["[1]", '""'], ids=["first_pass", "exact_pass"])
def test_round_trip(spark, extra):
    rng = random.Random(7)
    schema = T.DataType.fromDDL(DDL)
    rows = [tuple(value(rng, f.dataType) for f in schema) for _ in range(400)]
    df = spark.createDataFrame(rows, schema).select(F.struct("*").alias("original"))
    text = F.to_json("original", {"ignoreNullFields": "false"})
    body = F.concat(F.lit(f'{{"extra":{extra},'), F.substring(text, 2, 1_000_000))
    wider = T.StructType([T.StructField("extra", T.ArrayType(T.IntegerType())), *schema.fields])
    parsed = parse_events(df.withColumn("value", body), wider)
    assert parsed.filter("reason is not null").count() == 0
    def shown(column):
        return F.to_json(column, {"ignoreNullFields": "false"})
    both = parsed.select(shown("original").alias("a"), shown(F.struct(*[F.col("row")[n].alias(n) for n in schema.fieldNames()])).alias("b"))
    assert both.filter("not (a <=> b)").count() == 0
