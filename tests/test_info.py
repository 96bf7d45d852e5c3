"""Numbered pairs of columns as rows and as maps."""

import datetime

import pytest

from fathomframe.functions.names import clean_names
from fathomframe.plans import info

COLUMNS = ["OpCode", "Info5Name", "Info5Value", "Info12Name", "Info12Value", "Info6Name", "Info6Value", "Info9Name", "slot_x"]
ROWS = [("a", "Date", "20150910", "Bait", " pilchard ", "Time", "9:23:00", "alone", "x"), ("b", "", "no name", None, "x", " ", None, "alone", "y"),
        ("c", "Bait", "first", "Bait", "last", "Depth", "", "alone", None)]


@pytest.fixture
def sheet(spark):
    return clean_names(spark.createDataFrame(ROWS, ", ".join(f"`{c}` string" for c in COLUMNS)))


def test_pairs_are_matched_by_number(sheet):
    out = info.info_pairs(sheet)
    assert out.columns == ["opcode", "info9name", "slot_x", "slot", "name", "value"]
    assert sorted(map(tuple, out.select("opcode", "slot", "name", "value").collect()), key=repr) == sorted([
        ("a", 5, "Date", "20150910"), ("a", 6, "Time", "9:23:00"), ("a", 12, "Bait", "pilchard"),
        ("c", 5, "Bait", "first"), ("c", 6, "Depth", None), ("c", 12, "Bait", "last")], key=repr)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1


def test_maps_keep_the_last_of_a_name(sheet):
    got = {r.opcode: r.info for r in info.info_map(sheet).collect()}
    assert got == {"a": {"Date": "20150910", "Time": "9:23:00", "Bait": "pilchard"}, "b": {}, "c": {"Depth": None, "Bait": "last"}}


@pytest.mark.parametrize("text,day,seconds,n", [
    ("20150910", datetime.date(2015, 9, 10), None, 20150910.0), ("2015 09 13", datetime.date(2015, 9, 13), None, None),
    ("2015-09-13", datetime.date(2015, 9, 13), None, None), ("01/09/15", datetime.date(2015, 9, 1), None, None), ("31/12/2015", datetime.date(2015, 12, 31), None, None),
    ("31/02/2015", None, None, None), ("1/2/15", None, None, None), ("9:23:00", None, 33780, None), ("23:59", None, 86340, None), ("24:00:00", None, None, None),
    ("0.645138889", None, 55740, 0.645138889), ("1.5", None, None, 1.5), ("NaN", None, None, None), (None, None, None, None)])
def test_typed_values(spark, text, day, seconds, n):
    df = info.info_map(spark.createDataFrame([("k", text)], "info1name string, info1value string"))
    row = df.select(info.info_value("k").alias("t"), info.info_value("k", "date").alias("d"), info.info_value("k", "seconds").alias("s"),
                    info.info_value("k", "number").alias("n"), info.info_value("other", "number").alias("o")).first()
    assert tuple(row) == (text, day, seconds, n, None)


def test_no_pairs_and_no_rows(spark, sheet):
    assert info.info_pairs(sheet.limit(0)).collect() == []
    plain = spark.createDataFrame([("a",)], "opcode string")
    assert info.info_pairs(plain).collect() == [] and info.info_map(plain).first().info == {}
    with pytest.raises(ValueError):
        info.info_value("k", "colour")
