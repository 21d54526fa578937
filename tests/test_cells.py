import datetime
import decimal
import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from changeflow.functions import cells as C
from tests.helpers import changes_of, one
from changeflow.sources import codec


def test_kinds_of_cells(spark):
    text = '{"a":1.50,"b":"x\\"y","c":null,"d":true,"f":12345678901234567890,"g":"null","h":[1,2],"i":{"z":1}}'
    row = one(spark.createDataFrame([(text,)], "j string").select(C.parse_cells(F.col("j")).alias("m")))
    assert row.m == {"a": "1.5", "b": '"x\\"y"', "c": None, "d": "true", "f": "12345678901234567890",
                     "g": '"null"', "h": "[1,2]", "i": '{"z":1}'}


def test_empty_and_malformed(spark):
    rows = spark.createDataFrame([("{}",), ("{oops",), (None,)], "j string").select(C.parse_cells(F.col("j")).alias("m"))
    assert [r.m for r in rows.collect()] == [{}, None, None]


def test_typed_columns(spark):
    df = spark.createDataFrame(
        [(1, 1.5, 100.0, decimal.Decimal("2.50"), True, "it's", b"text", datetime.date(2024, 1, 2), [1, 2], None, 1e20)],
        "i int, d double, whole double, n decimal(10,2), b boolean, s string, bin binary, day date, arr array<int>, nil string, big double")
    row = one(df.select(C.cells_of(df).alias("m")))
    assert row.m == {"i": "1", "d": "1.5", "whole": "100", "n": "2.5", "b": "true", "s": '"it\'s"', "bin": '"text"',
                     "day": '"2024-01-02"', "arr": "[1,2]", "nil": None, "big": "1.0E20"}


def test_json_is_sorted(spark):
    df = spark.createDataFrame([({"b": '"x"', "a": None, 'q"k': "1"},)], "m map<string,string>")
    assert one(df.select(C.cells_json(F.col("m")).alias("j"))).j == '{"a":null,"b":"x","q\\"k":1}'


def test_base64_fields(spark):
    df = spark.createDataFrame([({"t": '"aGVsbG8="', "u": '"aGVsbG8="', "n": None},)], "m map<string,string>")
    decoded = one(df.select(C.decode_base64(F.col("m"), ["t", "n"]).alias("m"))).m
    assert decoded == {"t": '"hello"', "u": '"aGVsbG8="', "n": None}
    back = df.select(C.encode_base64(C.decode_base64(F.col("m"), ["t", "n"]), ["t", "n"]).alias("m"))
    assert one(back).m == {"t": '"aGVsbG8="', "u": '"aGVsbG8="', "n": None}


scalars = st.none() | st.booleans() | st.integers(-2**60, 2**60) | st.text(max_size=8)
images = st.dictionaries(st.text(min_size=1, max_size=5), scalars, max_size=4)


def go_cell(value):
    return None if value is None else json.dumps(value, ensure_ascii=False)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(images, images), min_size=1, max_size=10))
def test_decode_of_encode(spark, pairs):
    clean = lambda m: {k: v for k, v in m.items()}
    rows = [{"log_pos": i, "before": {k: go_cell(v) for k, v in clean(b).items()},
             "after": {k: go_cell(v) for k, v in clean(a).items()}} for i, (b, a) in enumerate(pairs)]
    changes = changes_of(spark, rows)
    decoded = codec.decode_changes(codec.encode_changes(changes).select("value")).orderBy("log_pos").collect()
    for (before, after), row in zip(pairs, decoded):
        assert row.malformed is None
        for image, cells in ((before, row.before), (after, row.after)):
            assert {k: None if v is None else json.loads(v) for k, v in cells.items()} == image


def test_names_with_escapes_and_empty_images(spark):
    rows = spark.sql("""select * from values (0, map('a', '1', 'b"x', null)), (1, map('b', '"\\\\n"', 'a', null)), (2, cast(map() as map<string,string>)),
        (3, cast(null as map<string,string>)) as t(k, cells)""")
    got = {r.k: r.j for r in rows.select("k", C.cells_json(F.col("cells")).alias("j")).collect()}
    assert got == {0: '{"a":1,"b\\"x":null}', 1: '{"a":null,"b":"\\n"}', 2: "{}", 3: None}
    texts = spark.createDataFrame([("{}",), (" {}",), ("{x",), (None,)], "t string")
    assert [r.c for r in texts.select(C.parse_cells(F.col("t")).alias("c")).collect()] == [{}, {}, None, None]
