import math

import pytest
from pyspark.sql import functions as F

from fathomframe.functions.columns import SAMPLE, TAXON
from fathomframe.plans import check, format as fmt, gather, habitat as hab
from fathomframe.plans.info import campaign_info_wide
from fathomframe.plans.study import Decisions, check_study, format_study

KEY = "campaignid string, sample string"
TAXA = "family string, genus string, species string"
LH = (TAXA + ", marine_region string, length_measure string, a double, b double, `all` double, "
      "bll double, fb_length_max double, fb_ltypemaxm string")


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


@pytest.fixture(scope="module")
def metadata(spark):
    return spark.createDataFrame(
        [("c", "s1", "Yes", "Yes", "x"), ("c", "s2", "No", "Yes", "y"),
         ("c", "s3", "Yes", "No", None), ("d", "s1", "Yes", "Yes", "z")],
        KEY + ", successful_count string, successful_length string, comment string")


@pytest.fixture(scope="module")
def life_history(spark):
    return spark.createDataFrame([
        ("F", "G", "a", "NW", "FL", 0.01, 3.0, None, None, 1000.0, "FL"),
        ("F", "G", "b", "NW", "TL", None, None, 0.0, 1.0, None, "TL"),
        ("F", "H", "c", "NW", "SL", 0.02, 2.5, 1.0, 2.0, None, "TL"),
        ("K", "L", "d", "NW", "SL", 0.03, 3.0, None, None, 200.0, "TL"),
        ("K", "L", "e", "NW", "XX", 0.04, 3.0, None, None, 100.0, "TL"),
    ], LH)


def test_maxn_is_the_largest_frame(spark, metadata):
    points = spark.createDataFrame([
        ("c", "s1", "v1", 1, 0.5, "F", "G", "a", "1"), ("c", "s1", "v1", 1, 0.5, "F", "G", "a", "2"),
        ("c", "s1", "v1", 9, 0.9, "F", "G", "a", "3"), ("c", "s1", "v2", 1, 0.1, "F", "G", "a", "2"),
        ("c", "s1", "v1", 1, 0.5, None, None, None, "4"), ("c", "s1", "v1", 2, 0.7, "F", "G", "z", None),
        ("c", "s2", "v1", 1, 0.5, "F", "G", "a", "7")],
        KEY + ", filename string, frame int, periodtime double, " + TAXA + ", number string")
    counts = spark.createDataFrame([("d", "s1", "F", "G", "a", "5"), ("d", "s1", "F", "G", "b", "0")],
                                   KEY + ", " + TAXA + ", count string")
    out = gather.build_maxn(points, counts, metadata)
    assert rows(out, *SAMPLE, *TAXON, "maxn", "periodtime") == [
        ("c", "s1", "F", "G", "a", 3.0, 0.5), ("c", "s1", None, None, None, 4.0, 0.5),
        ("d", "s1", "F", "G", "a", 5.0, None)]


def test_length3d_drops_clashing_columns(spark, metadata):
    em = spark.createDataFrame([("c", "s1", "F", 10.0, "t", "p", "em")],
                               KEY + ", family string, length double, time string, project string, comment string")
    located = spark.createDataFrame([("d", "s1", "F", 3.0), ("c", "s3", "F", 1.0)],
                                    KEY + ", family string, number double")
    out = gather.build_length3d(None, em, located, metadata)
    assert rows(out, *SAMPLE, "length", "number", "comment") == [
        ("c", "s1", 10.0, None, "x"), ("d", "s1", None, 3.0, "z")]


def test_complete_count(spark, metadata):
    count = spark.createDataFrame(
        [("p", "c", "s1", "F", "G", "a", "legal", "2"), ("p", "c", "s9", "F", "G", "a", "sublegal", "x")],
        "project string, " + KEY + ", " + TAXA + ", legal_sublegal string, count string")
    out = gather.complete_count(count, metadata)
    assert rows(out, "sample", "legal_sublegal", "count", "comment") == [
        ("s1", "legal", 2.0, "x"), ("s1", "sublegal", 0.0, "x"),
        ("s9", "legal", 0.0, None), ("s9", "sublegal", 0.0, None)]


def test_standardise(spark):
    maxn = spark.createDataFrame([("c", "s1", None, None, "ABC", "x"), ("c", "s1", "F", "G", None, "2")],
                                 KEY + ", " + TAXA + ", maxn string")
    assert rows(check.standardise_maxn(maxn)) == [
        ("c", "s1", "F", "G", "spp", 2.0), ("c", "s1", "Unknown", "Unknown", "abc", None)]
    length = spark.createDataFrame(
        [("c", "s1", None, "NA", "ABC", "x", "1", "5"), ("c", "s1", "F", "G", "a", "1", None, "5"),
         ("c", "s1", "F", "G", "a", "1", "none", "5")],
        KEY + ", " + TAXA + ", length string, number string, range string")
    assert rows(check.standardise_length(length)) == [
        ("c", "s1", "Unknown", "Unknown", "ABC", None, 1.0, 5.0)]


def test_life_history_region_is_a_substring(spark):
    sheet = spark.createDataFrame(
        [("Australia/Fiji", "N/NW", "F"), ("Fiji", "NW", "G"), ("Australia", "N", "H"),
         ("Australia", None, "I"), ("Australia/Fiji", "N/NW", "F")],
        "global_region string, marine_region string, family string")
    for c in ("genus", "species", "length_measure", "fb_ltypemaxm"):
        sheet = sheet.selectExpr("*", f"'x' AS {c}")
    for c in ("a", "b", "all", "bll", "fb_length_max"):
        sheet = sheet.selectExpr("*", f"'unknown' AS `{c}`")
    got = check.load_life_history(sheet)
    assert rows(got, "family", "a") == [("F", None)]
    assert rows(check.load_life_history(sheet, region="N"), "family") == [("F",), ("H",)]


def test_synonyms(spark):
    df = spark.createDataFrame([("F", "Old", "a", 1), ("F", "G", "b", 2), (None, "G", "b", 3)],
                               TAXA + ", n int")
    syn = spark.createDataFrame([("F", "Old", "a", "F", "New", "a"), ("F", "G", "b", None, None, "c")],
                                TAXA + ", new_family string, new_genus string, new_species string")
    out, report = check.apply_synonyms(df, syn.union(syn))
    assert rows(out) == [("F", "G", "c", 2), ("F", "New", "a", 1), (None, "G", "b", 3)]
    assert rows(report) == [("F", "G", "b", "F", "G", "c"), ("F", "Old", "a", "F", "New", "a")]


def test_bounds_fall_back_to_genus_then_family(life_history):
    got = {r["species"]: (r["fb_length_max"], r["min_length"], r["max_length"])
           for r in check.max_length_bounds(life_history).collect()}
    assert got["a"] == pytest.approx((1000.0, 150.0, 850.0))
    assert got["b"] == pytest.approx((1000.0, 150.0, 850.0))    # genus G
    assert got["c"] == pytest.approx((1000.0, 150.0, 850.0))    # family F
    assert got["d"] == pytest.approx((200.0, 30.0, 170.0))


def lengths(spark, *items):
    """(sample, species, length, number) within one genus."""
    return spark.createDataFrame(
        [("c", s, "F", "G", sp, le, n, 5000.0) for s, sp, le, n in items],
        KEY + ", " + TAXA + ", length double, number double, range double")


def test_wrong_lengths_are_strict_and_fan_out(spark, life_history):
    length = lengths(spark, ("s1", "a", 150.0, 1.0), ("s1", "a", 850.0, 1.0), ("s1", "a", 149.0, 1.0),
                     ("s2", "a", 851.0, 1.0), ("s2", "a", None, 1.0), ("s2", "q", 5.0, 1.0))
    bounds = check.max_length_bounds(life_history)
    got = rows(check.wrong_length_taxa(length, bounds), "sample", "length", "reason", "difference",
               "percent_of_fb_max")
    assert [g[:4] for g in got] == [("s1", 149.0, "too small", 1.0), ("s2", 851.0, "too big", 1.0)]
    assert got[0][4] == pytest.approx(14.9)
    assert check.wrong_length_taxa(length, bounds.union(bounds)).count() == 4


def test_wrong_length_legacy(spark, life_history):
    length = lengths(spark, ("s1", "a", 1000.0, 1.0), ("s1", "a", 999.0, 1.0), ("s1", "b", 400.0, 1.0))
    got = check.wrong_length_legacy(length, life_history).collect()
    # family F: (1000 + 0 + 0) / 3
    assert [(r["species"], round(r["percent_error"], 6)) for r in got] == [("b", 20.0), ("a", 0.0)]


def test_maxn_vs_stereo(spark):
    length = lengths(spark, ("s1", "eq", 1.0, 2.0), ("s1", "more", 1.0, 3.0), ("s1", "less", None, 1.0),
                     ("s1", "alone", 1.0, 4.0), ("s1", "zero", 1.0, 2.0))
    maxn = spark.createDataFrame(
        [("c", s, "F", "G", sp, n) for s, sp, n in [
            ("s1", "eq", 2.0), ("s1", "more", 2.0), ("s1", "less", 4.0), ("s1", "zero", 0.0),
            ("s1", "only", 5.0), ("s9", "only", 5.0)]], KEY + ", " + TAXA + ", maxn double")
    got = [(r["species"], r["maxn"], r["stereo_maxn"], r["difference"], r["percent_difference"])
           for r in check.maxn_vs_stereo(length, maxn).collect()]
    assert got == [("alone", 0.0, 4.0, 4.0, None), ("less", 4.0, 1.0, 3.0, 75.0),
                   ("zero", 0.0, 2.0, 2.0, None), ("more", 2.0, 3.0, 1.0, 50.0)]
    wide = check.maxn_vs_stereo(length, maxn, include_unmeasured=True)
    extra = set(rows(wide, "sample", "species")) - {("s1", g[0]) for g in got}
    assert extra == {("s1", "only")}


def test_not_observed_keeps_missing_species(spark, life_history):
    obs = spark.createDataFrame(
        [("c", "s1", "F", "G", "a"), ("c", "s1", "F", "G", "spp"), ("c", "s1", "F", "G", "new"),
         ("c", "s1", "F", "G", "new"), ("c", "s1", "F", "G", None)], KEY + ", " + TAXA)
    assert rows(check.taxa_not_observed(obs, life_history), "species") == [("new",), (None,)]


def test_wrong_lengths_go_in_every_sample_unless_told(spark, life_history):
    length = lengths(spark, ("s1", "a", 5.0, 1.0), ("s2", "a", 5.0, 1.0), ("s1", "a", 500.0, 1.0),
                     ("s1", "a", None, 1.0))
    wrong = check.wrong_length_taxa(length.filter("sample = 's1'"), check.max_length_bounds(life_history))
    kept = check.drop_wrong_lengths(length, wrong)
    assert rows(kept, "sample", "length") == [("s1", 500.0), ("s1", None)]
    assert kept.join(wrong, [*SAMPLE, *TAXON, "length"], "left_semi").count() == 0
    per = check.drop_wrong_lengths(length, wrong, per_sample=True)
    assert rows(per, "sample", "length") == [("s1", 500.0), ("s1", None), ("s2", 5.0)]


def test_direct_removal_equals_applying_the_reports(spark, life_history):
    length = spark.createDataFrame(
        [("c", "s1", "F", "G", "a", 149.0), ("c", "s2", "F", "G", "a", 150.0), ("c", "s2", "F", "G", "a", 851.0),
         ("c", "s1", "F", "G", "spp", 1.0), ("c", "s1", "F", "G", None, 1.0), ("c", "s1", None, None, None, 1.0),
         ("c", "s3", "K", "L", "d", 29.0), ("c", "s3", "K", "L", "d", 90.0), ("c", "s3", "K", "L", "new", 5.0),
         ("c", "s3", "K", "L", "d", None)], KEY + ", " + TAXA + ", length double").selectExpr(
        "*", "1.0D AS number", "5.0D AS range")
    narrower = spark.createDataFrame([("K", "L", "d", "NW", "TL", 0.1, 3.0, None, None, 100.0, "TL")], LH)
    lh = life_history.union(narrower)                       # two rows for one taxon
    bounds = check.max_length_bounds(lh)
    bad, wrong = check.taxa_not_observed(length, lh), check.wrong_length_taxa(length, bounds)
    maxn = length.selectExpr(*SAMPLE, *TAXON, "number AS maxn")
    by_report = check.drop_errors(maxn, length, check.taxa_not_observed(maxn, lh), bad, wrong)
    assert rows(check.drop_unknown_taxa(maxn, lh)) == rows(by_report[0])
    direct = check.drop_implausible_lengths(check.drop_unknown_taxa(length, lh), bounds)
    assert rows(direct) == rows(by_report[1]) and direct.count() == 3


def test_complete_maxn_keys(spark, metadata):
    maxn = spark.createDataFrame(
        [("c", "s1", "F", "G", "a", 2.0), ("d", "s1", "F", "G", "b", 3.0),
         ("c", "s2", "Unknown", "Unknown", "spp", 1.0), ("x", "s9", "F", "G", "a", 1.0)],
        KEY + ", " + TAXA + ", maxn double")
    out = fmt.complete_maxn(maxn, metadata)
    # samples with unnamed fish only still get their zeros; s3 has no fish; x.s9 no metadata
    assert rows(out, "id", "species", "maxn") == [
        ("c.s1", "a", 2.0), ("c.s1", "b", 0.0), ("c.s2", "a", 0.0), ("c.s2", "b", 0.0),
        ("d.s1", "a", 0.0), ("d.s1", "b", 3.0)]
    merged = fmt.complete_maxn(maxn, metadata, key="sample")
    assert rows(merged, "campaignid", "sample", "species", "maxn") == [
        ("c", "s1", "a", 2.0), ("c", "s1", "b", 3.0), ("c", "s2", "a", 0.0), ("c", "s2", "b", 0.0),
        ("d", "s1", "a", 2.0), ("d", "s1", "b", 3.0)]


def test_complete_length_holds_every_sample(spark, metadata):
    length = lengths(spark, ("s1", "a", 100.0, 2.0), ("s1", "a", None, 3.0), ("s2", "b", 50.0, 1.0),
                     ("s9", "q", 1.0, 1.0))
    out = fmt.complete_length(length, metadata)
    # c.s3 and d.s1 have no fish, so "no taxon" is a taxon; s9 has no metadata
    assert out.select("campaignid", "sample").distinct().count() == metadata.count()
    assert out.select(*SAMPLE, *TAXON).distinct().count() == 4 * 3
    assert rows(out.filter("number > 0"), "id", "species", "length", "number") == [
        ("c.s1", "a", 100.0, 2.0), ("c.s1", "a", None, 3.0), ("c.s2", "b", 50.0, 1.0)]
    expanded = fmt.expanded_length(out)
    assert expanded.count() == 3 and "number" not in expanded.columns
    full = fmt.complete_length(length, metadata.filter("sample IN ('s1', 's2') AND campaignid = 'c'"))
    assert full.filter("family IS NULL").count() == 0 and full.count() == 5


def test_missing_length_weight(spark, life_history):
    done = spark.createDataFrame([("F", "G", "a"), ("F", "G", "b"), ("Z", "Y", "x"), (None, None, None)], TAXA)
    assert rows(fmt.missing_length_weight(done, life_history)) == [
        ("F", "G", "b"), ("Z", "Y", "x"), (None, None, None)]
    assert rows(fmt.missing_length_weight(done, life_history, "genus")) == [("Y",), (None,)]
    assert rows(fmt.missing_length_weight(done, life_history, "family")) == [("Z",), (None,)]


def test_family_length_weight(life_history):
    got = {(r["family"], r["length_measure"]): r for r in fmt.family_length_weight(life_history).collect()}
    assert set(got) == {("F", "FL"), ("K", "SL"), ("K", "XX")}    # rank 3 ties
    assert got["F", "FL"]["all"] == 0.0 and got["F", "FL"]["bll"] == 1.0
    assert math.isclose(got["K", "XX"]["a"], 0.04)


def test_length_to_mass(spark, life_history, metadata):
    done = spark.createDataFrame(
        [("c", "s1", "F", "G", "a", 100.0, 2.0, 1.0, "x"), ("c", "s1", "F", "G", "b", 100.0, 2.0, 1.0, "x"),
         ("c", "s1", "K", "L", "new", 100.0, 1.0, 1.0, "x"), ("c", "s1", "F", "H", "c", -90.0, 1.0, 1.0, "x"),
         ("c", "s1", "F", "G", "a", None, 0.0, None, "x"), ("c", "s1", None, None, None, None, 0.0, None, "x")],
        KEY + ", " + TAXA + ", length double, number double, range double, comment string")
    out = fmt.length_to_mass(done, life_history)
    got = rows(out, "species", "length", "mass_g")
    expected = [("a", 100.0, 10.0 ** 3 * 0.01 * 2), ("a", None, None), ("c", -90.0, None),
                ("new", 100.0, 10.0 ** 3 * 0.03), ("new", 100.0, 10.0 ** 3 * 0.04)]
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[2] == (None if e[2] is None else pytest.approx(e[2]))
    by_sample = fmt.length_to_mass(done, life_history, metadata, key="sample")
    assert by_sample.count() == 2 * out.count()
    mass = fmt.check_mass(out).collect()
    assert [(r["species"], r["mean_kg"], r["min_length"]) for r in mass] == [
        ("new", 0.035, 10.0), ("a", 0.01, 10.0)]


# Point scores of six samples and the relief expected of them.
RELIEF_CASES = [
    ("r1", [7, 3, 0, 0, 0, 0], 0.3, 0.4830458915),
    ("r2", [6, 3, 0, 0, 0, 0], 0.3333333333, 0.5),
    ("r3", [10, 0, 0, 0, 0, 0], 0.0, 0.0),
    ("r5", [0, 1, 1, 5, 0, 0], 2.5714285714, 0.7867957924),
    ("r6", [0, 1, 0, 0, 0, 0], 1.0, None),
]


def test_relief_golden(spark):
    data = [("c", s, *map(float, w)) for s, w, _, _ in RELIEF_CASES]
    data += [("c", "empty", *[0.0] * 6), ("c", "half", 0.5, 1.5, *[0.0] * 4), ("c", "gap", *[None] * 6)]
    h = spark.createDataFrame(data, KEY + "".join(f", relief_{i} double" for i in range(6)))
    got = {r["sample"]: (r["mean_relief"], r["sd_relief"]) for r in hab.relief_stats(h).collect()}
    for s, _, mean, sd in RELIEF_CASES:
        assert got.pop(s) == (pytest.approx(mean, abs=1e-9),
                              None if sd is None else pytest.approx(sd, abs=1e-9))
    assert got == {"half": (1.0, None)}


def test_relief_weights_equal_repeated_rows(spark):
    from pyspark.sql import functions as F
    from fathomframe.operators.reshape import uncount, unpivot_long
    h = spark.createDataFrame([("c", "s", 3.0, 0.0, 5.0, 1.0, 0.0, 2.0)],
                              KEY + "".join(f", relief_{i} double" for i in range(6)))
    long = uncount(unpivot_long(h, SAMPLE, list(hab.RELIEF), "relief", "score"), "score")
    want = long.select(F.substring("relief", -1, 1).cast("double").alias("r")).agg(
        F.avg("r"), F.stddev_samp("r")).first()
    got = hab.relief_stats(h).first()
    assert (got["mean_relief"], got["sd_relief"]) == pytest.approx(tuple(want))


def habitat_table(spark):
    return spark.createDataFrame(
        [("p", "c", "s1", "3", "20", "1", "2", "1", "6", "8"), ("p", "c", "s2", "0", "0", "0", "0", "0", None, "5"),
         ("p", "x", "s1", "1", "1", "1", "1", "1", "1", "1")],
        "project string, " + KEY + ", relief_2_mostly string, fieldofview_open string, "
        "biota_sponges_cup string, biota_sponges_tube string, biota_hydroids string, "
        "biota_unconsolidated string, open_water string")


NAMES = [("biota_sponges_cup", "sponges"), ("biota_sponges_tube", "sponges"),
         ("biota_hydroids", "hydroids"), ("biota_unconsolidated", "unconsolidated")]


def test_habitat_percent(spark, metadata):
    h = hab.habitat_broad(habitat_table(spark), NAMES)
    assert "biota_open_water" not in h.columns and len(h.columns) == 30
    broad = {(r["campaignid"], r["sample"]): r for r in hab.broad_percent(h).collect()}
    assert broad["c", "s1"]["biota_sponges"] == 30.0
    assert broad["c", "s1"]["biota_unconsolidated"] == 60.0
    values = [v for r in broad.values() for k, v in r.asDict().items() if k.startswith("biota_")]
    assert sum(values) == pytest.approx(200.0)              # the empty sample adds zeros
    fov = {(r["campaignid"], r["sample"]): r["fieldofview_open"] for r in hab.fov_percent(h).collect()}
    assert fov["c", "s1"] == 100.0 and fov["c", "s2"] is None
    done = hab.complete_habitat(hab.relief_stats(h), hab.fov_percent(h), hab.broad_percent(h), metadata)
    assert rows(done, "id", "mean_relief", "sponges", "comment") == [
        ("c.s1", 2.0, 30.0, "x"), ("c.s2", None, 0.0, "y")]


def test_info_wide(spark):
    info = spark.createDataFrame([("p", "c", "Bait", "x"), ("p", "c", "Camera", "y"), ("p", "d", "Bait", "z")],
                                 ["project", "campaignid", "name", "value"])
    assert rows(campaign_info_wide(info)) == [("p", "c", "x", "y"), ("p", "d", "z", None)]


def test_study_end_to_end(spark, metadata, life_history):
    length = spark.createDataFrame(
        [("c", "s1", "F", "G", "a", "500", "2", "5000"), ("c", "s1", "F", "G", "a", "5", "1", "5000"),
         ("c", "s1", "F", "G", "a", "500", "1", "10000"), ("c", "s2", "F", "Old", "a", "400", "1", "99"),
         ("c", "s2", "F", "G", "new", "400", "1", "99"), ("c", "s2", None, None, None, None, "1", "99")],
        KEY + ", " + TAXA + ", length string, number string, range string")
    maxn = spark.createDataFrame([("c", "s1", "F", "G", "A", "4"), ("c", "s2", "F", "Old", "a", "1"),
                                  ("c", "s2", "F", "G", "new", "1")], KEY + ", " + TAXA + ", maxn string")
    syn = spark.createDataFrame([("F", "Old", "a", "F", "G", "a")],
                                TAXA + ", new_family string, new_genus string, new_species string")
    reports, checked = check_study(maxn, length, life_history, syn)
    assert reports["length.species.not.previously.observed"].count() == 1
    assert reports["check.wrong.length.taxa.vs.life.history"].count() == 1
    assert rows(checked["checked.length"], "sample", "genus", "length", "number") == [
        ("s1", "G", 500.0, 2.0), ("s2", "G", 400.0, 1.0), ("s2", "Unknown", None, 1.0)]
    kept = check_study(maxn, length, life_history, syn, Decisions(None, False, False))[1]
    assert kept["checked.length"].count() == 6 and kept["checked.maxn"].count() == 3
    out_reports, tables = format_study(checked["checked.maxn"], checked["checked.length"], metadata,
                                       life_history)
    assert tables["complete.length"].count() == 4 * 2
    assert tables["expanded.length"].count() == 3
    assert tables["complete.mass"].filter("mass_g > 0").count() == 2
    assert out_reports["check.mass"].count() == 1


def test_contradictory_synonyms_end_the_job(spark):
    df = spark.createDataFrame([("F", "Old", "a", 1)], TAXA + ", n int")
    syn = spark.createDataFrame([("F", "Old", "a", "F", "New", "a"), ("F", "Old", "a", "F", "Newer", "a")],
                                TAXA + ", new_family string, new_genus string, new_species string")
    with pytest.raises(Exception, match="contradictory synonyms"):
        check.apply_synonyms(df, syn)[0].collect()


def test_numbers_that_are_none_are_missing(spark):
    length = spark.createDataFrame([("c", "s", "F", "G", "a", "NaN", "NaN", "5"), ("c", "s", "F", "G", "a", "10mm", "2", "Infinity")],
                                   KEY + ", " + TAXA + ", length string, number string, range string")
    got = check.standardise_length(length).collect()
    assert [(r["length"], r["number"], r["range"]) for r in got] == [(None, 2.0, None)]


def test_completed_mass_equals_completing_first(spark, life_history, metadata):
    length = spark.createDataFrame(
        [("c", "s1", "F", "G", "a", 100.0, 2.0, 1.0), ("c", "s1", "Unknown", "u", "u", 5.0, 1.0, 1.0),
         ("c", "s2", "Q", "Q", "q", 50.0, 1.0, 1.0), ("d", "s1", "K", "L", "x", 50.0, 1.0, 1.0)],
        KEY + ", " + TAXA + ", length double, number double, range double")
    life_history = life_history.unionByName(life_history.filter("species = 'a'").withColumn("b", F.lit(2.9)))
    for key in (("campaignid", "sample"), ("sample",)):
        whole = fmt.complete_mass(length, metadata, life_history, key)
        first = fmt.complete_length(length, metadata)
        meta = None if len(key) == 2 else metadata
        then = fmt.length_to_mass(first, life_history, meta, key)
        columns = sorted(then.columns)
        assert sorted(map(str, whole.select(*columns).collect())) == sorted(map(str, then.select(*columns).collect()))
    taxa = sorted(map(tuple, fmt.completed_taxa(length, metadata).collect()), key=repr)
    assert taxa == sorted(map(tuple, first.select("family", "genus", "species").distinct().collect()), key=repr)


def test_a_step_measures_each_small_table_once(spark, metadata, life_history, monkeypatch):
    from fathomframe.operators import joins
    from fathomframe.plans import study

    seen = []
    real = joins.fits_broadcast

    def counted(df, *a):
        seen.append(df)
        return real(df, *a)

    monkeypatch.setattr(joins, "fits_broadcast", counted)
    monkeypatch.setattr(study, "fits_broadcast", counted)
    maxn = spark.createDataFrame([("c", "s1", "F", "G", "a", 1.0)], KEY + ", " + TAXA + ", maxn double")
    length = spark.createDataFrame([("c", "s1", "F", "G", "a", 100.0, 2.0, 1.0)], KEY + ", " + TAXA + ", length double, number double, range double")
    syn = spark.createDataFrame([], TAXA + ", new_family string, new_genus string, new_species string")
    study.check_study(maxn, length, life_history, syn)
    assert len(seen) == 2
    seen.clear()
    study.format_study(maxn, length, metadata, life_history)
    assert len(seen) == 2
