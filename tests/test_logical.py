"""Logical types: exact decimals, dates and timestamps."""

import base64
import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from cdclake import CdcConfig, ingest_batch, read_table
from cdclake.functions.logical import decimal_of, is_logical, logical_signature
from helpers import events, fld, value

DECIMAL = "org.apache.kafka.connect.data.Decimal"


def octets(n):
    return n.to_bytes(max(1, (n.bit_length() + 8) // 8), "big", signed=True)


def test_decimals_of_any_size(spark):
    r = random.Random(2)
    numbers = [0, 1, -1, 127, 128, -128, -129, 255, 256, 2**63 - 1, -(2**63), 2**64, -(2**64), 10**38 - 1, -(10**38) + 1] + [r.randrange(-(10**n), 10**n) for n in range(1, 38)]
    frame = spark.createDataFrame([(str(n), octets(n)) for n in numbers], "n string, b binary")
    for scale in (0, 2, 38):
        for row in frame.select("n", decimal_of(F.col("b"), 38, scale).alias("d")).collect():
            assert row.d == Decimal(row.n).scaleb(-scale, __import__("decimal").Context(prec=60)), (row.n, scale)
    odd = spark.createDataFrame([(b"",), (None,), (b"\x01" * 17,), (octets(12345),), (octets(10**38),), (octets(-(2**127)),)], "b binary").select(decimal_of(F.col("b"), 4, 2).alias("d")).collect()
    assert [x.d for x in odd] == [None] * 6


def test_landed_logical_types(spark, lake):
    fields = [fld("id", "int32"), fld("price", "bytes", name=DECIMAL, parameters={"scale": "4", "connect.decimal.precision": "18"}), fld("day", "int32", name="io.debezium.time.Date"),
              fld("ms", "int64", name="io.debezium.time.Timestamp"), fld("us", "int64", name="io.debezium.time.MicroTimestamp"), fld("ns", "int64", name="io.debezium.time.NanoTimestamp"),
              fld("zoned", "string", name="io.debezium.time.ZonedTimestamp"), fld("plain", "bytes"),
              {"type": "struct", "field": "inner", "optional": True, "fields": [fld("d", "int32", name="io.debezium.time.Date")]}, {"type": "array", "field": "days", "items": {"type": "int32", "name": "io.debezium.time.Date"}}]
    row = {"id": 1, "price": base64.b64encode(octets(12345663446)).decode(), "day": 16850, "ms": 1_600_000_000_123, "us": 1_600_000_000_123_456, "ns": 1_600_000_000_123_456_789,
           "zoned": "2020-09-13T12:26:40Z", "plain": base64.b64encode(b"aBC").decode(), "inner": {"d": -1}, "days": [0, 1]}
    rows = [("a", None, value(fields, row)), ("a", None, value(fields, dict.fromkeys(row) | {"id": 2})), ("b", None, value(fields[:2], {"id": 3, "price": base64.b64encode(octets(-5)).decode()}))]
    rows += [("b", None, value([fields[0], fld("price", "bytes")], {"id": 4, "price": base64.b64encode(b"x").decode()}))]
    ingest_batch(events(spark, rows[:3]), CdcConfig(base_path=lake, logical_types=True))
    got = {r.id: r for r in read_table(spark, f"{lake}/a").collect()}
    utc = lambda us: dt.datetime(2020, 9, 13, 12, 26, 40, us)
    assert (got[1].price, got[1].day, got[1].ms, got[1].us, got[1].ns, got[1].zoned) == (Decimal("1234566.3446"), dt.date(2016, 2, 19), utc(123000), utc(123456), utc(123456), utc(0))
    assert bytes(got[1].plain) == b"aBC" and got[1].inner.d == dt.date(1969, 12, 31) and got[1].days == [dt.date(1970, 1, 1), dt.date(1970, 1, 2)]
    assert all(got[2][c] is None for c in row if c != "id")
    assert dict(read_table(spark, f"{lake}/a").dtypes)["price"] == "decimal(18,4)"
    assert read_table(spark, f"{lake}/b").first().price == Decimal("-0.0005")
    res = ingest_batch(events(spark, rows[2:]), CdcConfig(base_path=lake + "2", logical_types=True))
    assert len(res.groups) == 2  # one physical type, two logical ones
    res = ingest_batch(events(spark, rows[2:]), CdcConfig(base_path=lake + "3"))
    assert len(res.groups) == 1 and bytes(sorted(read_table(spark, f"{lake}3/b").collect(), key=lambda r: r.id)[0].price) == octets(-5)


def test_signatures():
    plain, dated = {"type": "struct", "fields": [fld("a", "int32")]}, {"type": "struct", "fields": [fld("a", "int32", name="io.debezium.time.Date")]}
    assert not is_logical(plain) and is_logical(dated) and logical_signature(plain) != logical_signature(dated)
