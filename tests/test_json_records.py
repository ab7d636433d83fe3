"""One case per value rule: (JSON token, declared type) -> value, or a rejected record."""

import datetime as dt
import decimal
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.functions import json_records, parse_events
from eventbase.sources.envelope import spread

BAD = object()
X = T.StructType([T.StructField("x", T.IntegerType())])


def ts(*args):
    return dt.datetime(*args)


CASES = [
    # null and empty text
    ("null", "int", None), ("null", "timestamp", None), ("null", "string", None),
    ('""', "string", ""), ('""', "int", None), ('""', "double", None), ('""', "date", None),
    ('""', "timestamp", None), ('""', "binary", None), ('""', "boolean", None),
    ('""', "decimal(5,2)", None), ('""', "array<int>", None), ('""', "struct<x:int>", None),
    ('""', "map<string,int>", None),
    # string
    ('"t"', "string", "t"), ("12", "string", "12"), ("true", "string", "true"),
    ('{"x": [1, 2]}', "string", '{"x":[1,2]}'), ('[1, "a"]', "string", '[1,"a"]'),
    # binary
    ('"aGVsbG8="', "binary", b"hello"), ("12", "binary", BAD), ('"a b"', "binary", BAD),
    # date
    ('"2018-02-01"', "date", dt.date(2018, 2, 1)), ('"2018-02-01 12:00:00"', "date", dt.date(2018, 2, 1)),
    ('"17563"', "date", dt.date(2018, 2, 1)), ("17563", "date", BAD), ('"zz"', "date", BAD),
    ('"2018-99-01"', "date", BAD), ("true", "date", BAD), ('"99999999999"', "date", BAD),
    # timestamp (milliseconds)
    ('"2018-02-01 12:00:00"', "timestamp", ts(2018, 2, 1, 12)),
    ('"2018-02-01T12:00:00Z"', "timestamp", ts(2018, 2, 1, 12)),
    ("1517457600000", "timestamp", ts(2018, 2, 1, 4)), ('"1517457600"', "timestamp", BAD),
    ('"zz"', "timestamp", BAD), ('"a-b"', "timestamp", BAD), ("1.5", "timestamp", BAD),
    ("9223372036854775807", "timestamp", BAD), ("[1]", "timestamp", BAD), ('{"a":1}', "timestamp", BAD),
    # float and double
    ("1.5", "float", 1.5), ("10", "double", 10.0), ("1e2", "double", 100.0),
    ('"NaN"', "double", math.nan), ('"-Infinity"', "double", -math.inf), ('"Infinity"', "float", math.inf),
    ('"NaN"', "float", math.nan), ("NaN", "double", math.nan), ("1e999", "double", math.inf),
    ('"nan"', "double", BAD), ('"inf"', "double", BAD), ('"1.5"', "double", BAD), ('"INF"', "float", BAD),
    ('"+Infinity"', "double", BAD), ('"+INF"', "double", BAD), ("true", "float", BAD),
    # decimal
    ("1.235", "decimal(5,2)", decimal.Decimal("1.24")), ("12345.6", "decimal(3,2)", BAD),
    ('"1.5"', "decimal(5,2)", decimal.Decimal("1.50")), ('"q"', "decimal(5,2)", BAD), ("7", "decimal(5,2)", decimal.Decimal("7.00")),
    ("1e2", "decimal(5,2)", decimal.Decimal("100.00")), ("true", "decimal(5,2)", BAD),
    # integers
    ("7", "tinyint", 7), ("200", "tinyint", -56), ("256", "tinyint", BAD), ("-129", "tinyint", BAD),
    ("7", "smallint", 7), ("70000", "smallint", BAD), ("7", "int", 7), ("3000000000", "int", BAD),
    ("3000000000", "bigint", 3000000000), ("9223372036854775808", "bigint", BAD),
    ('"10"', "int", BAD), ("1.5", "int", BAD), ("1.0", "int", BAD), ("true", "int", BAD), ('{"a":1}', "int", BAD),
    # boolean
    ("true", "boolean", True), ("false", "boolean", False), ('"true"', "boolean", BAD), ("1", "boolean", BAD),
    # struct
    ('{"x":1,"z":2}', "struct<x:int>", (1,)), ('{"x":"q"}', "struct<x:int>", BAD), ('{"x":""}', "struct<x:int>", (None,)),
    ("{}", "struct<x:int>", (None,)), ("[1]", "struct<x:int>", BAD), ("3", "struct<x:int>", BAD),
    ('{"x":"2018-02-01"}', "struct<x:date>", (dt.date(2018, 2, 1),)), ('{"x":5}', "struct<x:date>", BAD),
    ('{"x":{"y":"17563"}}', "struct<x:struct<y:date>>", ((dt.date(2018, 2, 1),),)),
    # array
    ("[1,null,3]", "array<int>", [1, None, 3]), ('[1,"x",3]', "array<int>", BAD), ('[1,"",3]', "array<int>", [1, None, 3]),
    ("[]", "array<int>", []), ('["17563",""]', "array<date>", [dt.date(2018, 2, 1), None]), ("[5]", "array<date>", BAD),
    ('["a",1]', "array<string>", ["a", "1"]), ('"[1,2]"', "array<int>", BAD), ("5", "array<int>", BAD),
    ('[[1],[""]]', "array<array<int>>", [[1], [None]]), ('[{"x":1},{"x":""}]', "array<struct<x:int>>", [(1,), (None,)]),
    ('[{"x":1},{"x":"q"}]', "array<struct<x:int>>", BAD), ('[{"x":1},null]', "array<struct<x:int>>", [(1,), None]),
    # object where a list is expected
    ('{"x":1}', "array<struct<x:int>>", [(1,)]), ('{"x":1}', "array<int>", BAD),
    ('{"x": 1}', "array<string>", ['{"x":1}']), ('{"x":1}', "array<map<string,int>>", [{"x": 1}]),
    ('[{"y":{"x":1}}]', "array<struct<y:array<struct<x:int>>>>", [([(1,)],)]),
    ('{"x":1,"x":2}', "array<struct<x:int>>", [(2,)]),
    ('{"x":"q"}', "array<struct<x:int>>", BAD),
    ('[{"x":1,"y":2},{"x":"q","y":3}]', "array<struct<x:int,y:int>>", BAD),
    ('[{"x":1,"y":2},{"x":"","y":3}]', "array<struct<x:int,y:int>>", [(1, 2), (None, 3)]),
    ('{"y":[1,""]}', "struct<y:array<int>,z:int>", ([1, None], None)), ('{"y":[1,"q"],"z":1}', "struct<y:array<int>,z:int>", BAD),
    ('{"y":[1],"z":"q"}', "struct<y:array<int>,z:int>", BAD), ('{"y":{"a":1,"b":"q"}}', "struct<y:map<string,int>>", BAD),
    ('{"y":{"a":1,"b":""}}', "struct<y:map<string,int>>", ({"a": 1, "b": None},)), ('{"y":["NaN","nan"]}', "struct<y:array<double>>", BAD),
    ('[[1,2],[3,"q"]]', "array<array<int>>", BAD), ('{"a":[1,"q"],"b":[2]}', "map<string,array<int>>", BAD),
    ('{"a":[1,""],"b":[2]}', "map<string,array<int>>", {"a": [1, None], "b": [2]}),
    ('[["2018-02-01"],[5]]', "array<array<date>>", BAD), ('{"y":["2018-02-01",""],"z":""}', "struct<y:array<date>,z:int>", ([dt.date(2018, 2, 1), None], None)),
    # map
    ('{"x":1,"y":2}', "map<string,int>", {"x": 1, "y": 2}), ('{"y":""}', "map<string,int>", {"y": None}),
    ('{"y":"q"}', "map<string,int>", BAD), ('{"a":{"x":""}}', "map<string,struct<x:int>>", {"a": (None,)}),
    ('{"a":"17563"}', "map<string,date>", {"a": dt.date(2018, 2, 1)}), ("[1]", "map<string,int>", BAD),
    ('{"a":1,"b":{"c":2}}', "map<string,string>", {"a": "1", "b": '{"c":2}'}),
]


def plain(value):
    if isinstance(value, T.Row):
        return tuple(plain(v) for v in value)
    if isinstance(value, list):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def same(got, want):
    if isinstance(want, float) and math.isnan(want):
        return isinstance(got, float) and math.isnan(got)
    return got == want


# A clean record is settled by the first pass. Empty text in a second, non-text field
# sends the same token through the exact pass, which must decide alike.
@pytest.mark.parametrize("tail", [',"i":1', ',"i":""'], ids=["clean_neighbour", "exact_pass"])
def test_value_rules(spark, tail):
    by_type = {}
    for token, dtype, want in CASES:
        by_type.setdefault(dtype, []).append((token, want))
    wrong = []
    for dtype, cases in by_type.items():
        schema = schema_of(f"f {dtype}, i int")
        rows = [(n, f'{{"f":{token}{tail}}}') for n, (token, _) in enumerate(cases)]
        df = parse_events(spark.createDataFrame(rows, "n int, value string").coalesce(1), schema)
        for r in df.collect():
            token, want = cases[r["n"]]
            if want is BAD:
                if r["reason"] != "bad_value" or r["row"] is not None or r["bad_fields"] != ["f"]:
                    wrong.append((dtype, token, r))
            elif r["reason"] is not None or not same(plain(r["row"]["f"]), want):
                wrong.append((dtype, token, want, r))
    assert not wrong, "\n".join(map(str, wrong))


def schema_of(ddl):
    return T.DataType.fromDDL(ddl)


def parse(spark, bodies, ddl, **options):
    df = spark.createDataFrame([(n, b) for n, b in enumerate(bodies)], "n int, value string").coalesce(1)
    rows = parse_events(df, schema_of(ddl), **options).orderBy("n").collect()
    return [(plain(r["row"]), r["reason"]) for r in rows]


def test_whole_record_rules(spark):
    got = parse(
        spark,
        ["", "  ", None, "{bad", '{"a":1', "null", "12", '"x"', '[{"a":1}]', "{}", '{"a":1,"a":2}', '{"z":[{}],"b":"t"}',
         '{"a":1} xyz', "{'a':1}", "{a:1}", '{"a":01}', '{"a":1,/*c*/"b":"x"}', '{"A":1}', '{"a":1,"b":"x"}', '{"a":"q","b":"x"}'],
        "a int, b string",
    )
    blank, malformed = (None, "blank"), (None, "malformed")
    assert got == [
        blank, blank, blank, malformed, malformed, malformed, malformed, malformed, malformed,
        ((None, None), None), ((2, None), None), ((None, "t"), None), ((1, None), None), ((1, None), None),
        malformed, malformed, malformed, ((None, None), None), ((1, "x"), None), (None, "bad_value"),
    ]


def test_original_text_is_kept(spark):
    df = spark.createDataFrame([("{bad",)], "value string")
    assert parse_events(df, schema_of("a int")).first()["value"] == "{bad"


def test_first_fixture(spark):
    body = (
        '{"name":"Michael", "eventid":21, "eventtime":"2018-02-01 12:00:00", "eventtype":"tp", '
        '"birth":1517457600, "age":10, "event":[1,2,3]}'
    )
    ddl = "eventid bigint, eventtime timestamp, eventtype string, name string, birth timestamp, age double, event array<bigint>"
    want = (21, ts(2018, 2, 1, 12), "tp", "Michael", ts(2018, 2, 1, 4), 10.0, [1, 2, 3])
    assert parse(spark, [body], ddl, epoch_unit="s") == [(want, None)]


@pytest.mark.parametrize("unit, number", [("s", 1517457600), ("ms", 1517457600000), ("us", 1517457600000000)])
def test_epoch_units(spark, unit, number):
    assert parse(spark, [f'{{"t":{number}}}'], "t timestamp", epoch_unit=unit) == [((ts(2018, 2, 1, 4),), None)]


def test_epoch_unit_is_checked(spark):
    with pytest.raises(ValueError, match="epoch_unit"):
        parse(spark, ["{}"], "t timestamp", epoch_unit="days")


def test_epoch_overflow_is_bad_not_an_error(spark):
    assert parse(spark, ['{"t":9223372036855}'], "t timestamp", epoch_unit="s") == [(None, "bad_value")]


def test_lenient_floats(spark):
    spellings = ["NaN", "nan", "Infinity", "INF", "inf", "-infinity", "-Inf"]
    got = parse(spark, [f'{{"f":"{s}"}}' for s in spellings], "f double", lenient_floats=True)
    assert [reason for _, reason in got] == [None] * len(spellings)
    assert [r[0] for r, _ in got[2:]] == [math.inf] * 3 + [-math.inf] * 2
    assert parse(spark, ['{"f":"+inf"}', '{"f":"1.5"}'], "f double", lenient_floats=True) == [(None, "bad_value")] * 2


def test_json_options_are_passed_on(spark):
    bodies = ["{a:1}", '{"a":01}', '{"a":1,/*c*/"b":"x"}']
    options = {"allowUnquotedFieldNames": "true", "allowNumericLeadingZeros": "true", "allowComments": "true"}
    assert parse(spark, bodies, "a int, b string", json_options=options) == [((1, None), None)] * 2 + [((1, "x"), None)]


def test_repeated_map_keys_are_all_kept(spark):
    for tail in ("", ',"i":""'):
        df = spark.createDataFrame([('{"m":{"x":1,"x":2}' + tail + "}",)], "value string")
        entries = parse_events(df, schema_of("m map<string,int>, i int")).select(F.map_entries("row.m").alias("e"))
        assert [tuple(e) for e in entries.first()["e"]] == [("x", 1), ("x", 2)]


def test_root_list_gives_one_record_per_element(spark):
    got = parse(
        spark,
        ['[{"a":1},{"a":"q"},null,"{\\"a\\":1}"]', '{"a":2}', "[]", "[{", '["x"]'],
        "a int",
        explode_root_array=True,
    )
    good = [r for r, reason in got if reason is None]
    assert good == [(1,), (2,)]
    assert sorted(reason for _, reason in got if reason) == ["bad_value", "empty_list"] + ["malformed"] * 4


def test_odd_field_names(spark):
    assert parse(spark, ['{"a.b":1,"c`d":"x"}'], "`a.b` int, `c``d` string") == [((1, "x"), None)]


def test_first_pass_only_reads_clean_records_once(spark):
    df = spark.createDataFrame([('{"a":1}',)], "value string")
    parsed = parse_events(df, schema_of("a int, t timestamp")).filter("reason is null").select("row.*")
    spark.conf.set("spark.sql.maxPlanStringLength", "1000000")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    # the declared types are read in one place; a filter on the outcome does not repeat it
    assert plan.count("StructField(a,IntegerType,true)") == 1




def test_both_readings_of_suspect_records_agree(spark):
    """An escape in an unknown field sends a record to the exact reading; without it one reading by tokens does."""
    ddl = (
        "s struct<a: bigint, at: timestamp, `in`: struct<d: date, t: string>>, xs array<bigint>, m map<string, double>, "
        "ds array<date>, b binary, n decimal(5,2), f float, y tinyint, o boolean, ls array<struct<q: int>>, tx string"
    )
    bodies = [
        '{"s":{"a":1,"at":"2018-02-01 12:00:00","in":{"d":"17563","t":{"u":1.50}}},"xs":[1,"",3],"m":{"x":1.5,"y":""}#}',
        '{"s":{"a":"","at":1517457600000,"in":{"d":""}},"xs":["",null],"ds":["2018-02-01","","x"]#}',
        '{"s":{"a":1,"in":""},"xs":""#}', '{"s":"","xs":[1,"x"],"m":{"x":1,"x":"","x":2}#}', '{"s":null,"xs":{"a":1}#}',
        '{"b":"","n":"1.235","f":"NaN","y":200,"o":""#}', '{"b":"aGVsbG8=","n":12345.6,"f":"nan","y":256,"o":"true"#}',
        '{"ls":[{"q":""}],"tx":[1,{"k":1.0}],"xs":[""]#}', '{"ls":{"q":""},"tx":""#}', '{"ls":[{"q":1},{"q":""}],"xs":[]#}',
        '{"s":{"a":1,"a":"x"},"xs":[""]#}', '{"xs":["x"],"xs":[1]#}', '{"s":{"in":{"d":true,"d":"17563"}}#}', '{"xs":[""]#', '{"xs":[1.5]#} more',
        '{ "xs" : [ "" ] , "s" : { "a" : "q" }#}', "{'xs':[''],'s':{'a':''}#}", '{"m":{"a":{"b":1},"c":2}#}', '{"ds":{"a":1},"b":[]#}',
    ]
    tails = ("", ',"unknown":"\\\\"')
    plain_ones, escaped = (parse(spark, [b.replace("#", tail) for b in bodies], ddl) for tail in tails)
    assert len(plain_ones) == len(bodies)
    for body, a, b in zip(bodies, plain_ones, escaped):
        assert repr(a) == repr(b), body


def test_spread_bounds_the_rows_of_a_task(spark):
    scan = spark.range(0, 1000, 1, 6).toDF("id")
    assert spread(scan).rdd.getNumPartitions() == 6
    few = spread(scan, task_rows=50)
    assert few.rdd.getNumPartitions() == 20
    assert max(r["count"] for r in few.groupBy(F.spark_partition_id()).count().collect()) <= 100
    assert few.agg(F.countDistinct("id")).first()[0] == 1000


def test_rows_are_dealt_without_a_sort_and_evenly_even_if_alike(spark, tmp_path):
    spark.range(0, 1000, 1, 1).select(F.lit("x").alias("a"), F.lit(1).alias("__n")).write.parquet(str(tmp_path / "alike"))
    dealt = spread(spark.read.parquet(str(tmp_path / "alike")), task_rows=100)
    assert dealt.columns == ["a", "__n"]
    counts = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["count"] for r in counts) == [100] * 10
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan and "Sort" not in plan  # a round robin sorts the rows


def test_patterns_are_tried_only_where_a_name_stands_twice(spark):
    rules = json_records._Rules("ms", False, {})
    rows = [
        ('{"at":"2020-01-01"}', False),
        ('{"at":"2020-01-01","s":"what"}', False),
        ('{"at":1,"at":2}', True),
        ('{"at":1,"s":"\U0001f600","at" : 2}', True),
        ("{at:1,'at':2}", True),
        ('{"atat":1,"at":2}', False),
        ("atatat", False),
        ("", False),
        (None, False),
    ]
    df = spark.createDataFrame([(t,) for t, _ in rows], "value string")
    twice = rules.may_repeat(F.col("value"), T.StructType([T.StructField("at", T.DateType())]))
    assert [r[0] for r in df.select(twice).collect()] == [w for _, w in rows]
    plan = df.select(twice)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("substring_index") < plan.index("regexp_extract_all")
