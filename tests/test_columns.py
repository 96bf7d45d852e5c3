import math

import pytest
from pyspark.sql import functions as F

from fathomframe.functions import columns as C
from fathomframe.functions.names import clean_name, clean_names


def first(df):
    return df.first().asDict()


@pytest.mark.parametrize("raw,clean", [
    ("Biota: Octocoral.Black", "biota_octocoral_black"),
    ("Biota: Hydroids ", "biota_hydroids"),
    ("Habitat.Image.(Y/N)", "habitat_image_y_n_"),
    ("Opcode-old", "opcode_old"),
    ("L.cam", "l_cam"),
])
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_clean_names_repeats_get_numbers(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A b", "a.B", "a-b "])
    assert clean_names(df).columns == ["a_b", "a_b_2", "a_b_3"]


def test_to_numeric_bad_text_is_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("",), (None,), (" 7 ",)], ["v"])
    got = [r[0] for r in df.select(C.to_numeric("v")).collect()]
    assert got == [1.5, None, None, None, 7.0]


def test_null_tokens_only_listed(spark):
    df = spark.createDataFrame([("", " ", "NA", "x")], ["a", "b", "c", "d"])
    assert first(C.null_tokens(df, ["", " "])) == {"a": None, "b": None, "c": "NA", "d": "x"}


def test_fill_taxa_and_paste(spark):
    df = spark.createDataFrame([(None, "NA", None)], "family string, genus string, species string")
    assert first(C.fill_taxa(df)) == {"family": "Unknown", "genus": "NA", "species": "spp"}
    assert df.select(C.scientific_name()).first()[0] == "NA NA NA"


def test_replace_text_is_case_sensitive_substring(spark):
    df = spark.createDataFrame([("NAso",), ("Naso",)], ["genus"])
    got = [r[0] for r in df.select(C.replace_text("genus", {"NA": "Unknown"})).collect()]
    assert got == ["Unknownso", "Naso"]


def test_row_total_and_percent(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (0.0, 0.0, None)], "a double, b double, c double")
    totals = [r[0] for r in df.select(C.row_total(["a", "b", "c"])).collect()]
    assert totals == [4.0, 0.0]
    rows = C.row_percent(df, ["a", "b", "c"]).collect()
    assert tuple(rows[0]) == (25.0, 0.0, 75.0)
    assert tuple(rows[1]) == (None, None, None)
    assert tuple(C.row_percent(df, ["a", "b", "c"], empty=0.0).collect()[1]) == (0.0, 0.0, 0.0)


def test_select_by_prefix_ignores_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["id", "Relief_0", "relief_1"])
    assert C.select_by_prefix(df, "relief", keep=["id"]).columns == ["id", "Relief_0", "relief_1"]


def test_measure_rank(spark):
    df = spark.createDataFrame([("FL",), ("TL",), ("SL",), ("x",), (None,)], "m string")
    assert [r[0] for r in df.select(C.measure_rank("m")).collect()] == [1, 2, 3, 3, None]


def test_select_keep_rest(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert C.select_keep(df, ["c"], rest=True, drop=["b"]).columns == ["c", "a"]


def test_log_of_zero_never_reaches_a_mean(spark):
    from fathomframe.operators.aggregates import geometric_mean
    df = spark.createDataFrame([(10.0,), (1000.0,), (0.0,), (None,)], "a double")
    assert math.isclose(df.agg(geometric_mean("a")).first()[0], 100.0)
    assert df.filter(F.col("a") == 0).agg(geometric_mean("a")).first()[0] is None


def test_only_finite_numbers(spark):
    from fathomframe.functions.columns import to_numeric

    text = ["1", " 2.5 ", "-3e2", "5.", ".5", "NaN", "inf", "Infinity", "1d", "1e999", "10mm", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "i int, t string")
    got = [r["n"] for r in df.select("i", to_numeric("t").alias("n")).orderBy("i").collect()]
    assert got == [1.0, 2.5, -300.0, 5.0, 0.5] + [None] * 8
    numbers = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r["n"] for r in numbers.select(to_numeric("x").alias("n")).collect()] == [1.5, None, None, None]
