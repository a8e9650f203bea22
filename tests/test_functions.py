import datetime as dt

import pytest

from chronoweave.functions.expr import parse
from chronoweave.functions.formats import java_pattern
from chronoweave.functions.metadata_values import columns_of, compile_value


@pytest.mark.parametrize(("fmt", "want"), [("%Y-%m-%d", ("yyyy-M-d", "date")), ("%Y%m%d", ("yyyyMMdd", "date")), ("%H:%M", ("H:m", "time")), ("%Y-%m-%dT%H:%M:%S", ("yyyy-M-d'T'H:m:s", "datetime")), ("%m/%d/%Y, %H:%M:%S", ("M/d/yyyy, H:m:s", "datetime"))])
def test_patterns(fmt, want):
    assert java_pattern(fmt) == want


@pytest.mark.parametrize("fmt", ["%Q", "no directive"])
def test_bad_patterns(fmt):
    with pytest.raises(ValueError, match="time format"):
        java_pattern(fmt)


@pytest.mark.parametrize(("text", "kind", "columns"), [("$a", "column", {"a"}), ("BIRTH_EVENT", "literal", set()), ('"a b"', "literal", set()), ('f"A//{$x}//{$y}"', "text", {"x", "y"}), ("$a + $b * 2", "arith", {"a", "b"}), ('$d @ $t::"%H:%M"', "combine", {"d", "t"}), ('set_time($d, $t)', "combine", {"d", "t"}), ("hash($m)", "hash", {"m"}), ('$t as ?"%Y"', "time", {"t"}), ("$v::str", "cast", {"v"})])
def test_parsed(text, kind, columns):
    e = parse(text)
    assert (e.kind, e.columns) == (kind, columns)


@pytest.mark.parametrize("text", ["", "$a +", "foo($a)", "$a::nothing", "$a $b", "hash($a, $b)", "((1)"])
def test_not_an_expression(text):
    with pytest.raises(ValueError, match="expression"):
        parse(text)


def test_values(spark):
    df = spark.createDataFrame([(1, "x", None, "2020-01-02", "14:5", 2.5)], "a int, s string, n string, d string, t string, v double")
    forms = {"a": 'f"{$a}//{$s}"', "b": 'f"{$n}!"', "c": 'set_time($d::"%Y-%m-%d", $t::"%H:%M")', "d": '$s as ?"%Y"', "e": "$a * 2 + 1", "f": "hash($n)", "g": "$v::str", "h": '$d::"%Y-%m-%d"'}
    got = df.select(*[parse(e).compile().alias(k) for k, e in forms.items()]).first()
    assert list(got) == ["1//x", None, dt.datetime(2020, 1, 2, 14, 5), None, 3, None, "2.5", dt.date(2020, 1, 2)]
    assert df.select((parse("hash($s)").compile() == parse("hash($s)").compile()).alias("x")).first().x


def test_strict_time_fails(spark):
    df = spark.createDataFrame([("no",)], "d string")
    with pytest.raises(Exception, match="does not fit"):
        df.select(parse('$d::"%Y-%m-%d"').compile()).collect()


def test_metadata_values(spark):
    df = spark.createDataFrame([("HR", "Heart rate", "1-2", None)], "lab string, title string, loinc string, n string")
    forms = [("title", "Heart rate"), (["n", "title"], "Heart rate"), ({"title": {"lab": "HR"}}, "Heart rate"), ({"title": {"lab": "X"}}, None), ("LOINC/{loinc}", "LOINC/1-2"), ({"matcher": {"lab": "HR"}, "output": {"literal": "lit"}}, "lit"), ("A{n}", None)]
    assert list(df.select(*[compile_value(f).alias(str(i)) for i, (f, _) in enumerate(forms)]).first()) == [w for _, w in forms]
    assert columns_of({"LOINC/{loinc}": {"lab": "HR"}}) == {"loinc", "lab"}
    with pytest.raises(TypeError):
        compile_value({"title": "lab"})


def test_numbers_as_text(spark):
    """The shortest digits, plain from 1e-5 to below 1e16."""
    from pyspark.sql import functions as F

    from chronoweave.functions.formats import as_text

    want = {96.0: "96.0", 1e20: "1e20", 1e7: "10000000.0", 12345678.9: "12345678.9", 1.5e-7: "1.5e-7", 1.234e-5: "0.00001234", 2.5e-4: "0.00025", 1e15: "1000000000000000.0", -1.25e16: "-1.25e16", float("inf"): "inf", float("-inf"): "-inf", 0.0: "0.0"}
    df = spark.createDataFrame([(v,) for v in want], "d double")
    assert [r[0] for r in df.select(as_text(F.col("d"))).collect()] == list(want.values())
    other = spark.createDataFrame([("1.5E7", 3, True, None)], "s string, i int, b boolean, d double").select(*[as_text(F.col(c)) for c in "sibd"])
    assert tuple(other.first()) == ("1.5E7", "3", "true", None)
