"""Clustered tables, replaced campaigns, and studies brought up to date."""

import os
import shutil

import pytest

from fathomframe.plans import check
from fathomframe.plans.study import check_study, gather_study, refresh_study
from fathomframe.sources.store import StudyStore, campaign_states, changes
from tests.test_sources import META, put, rows

MAXN = "campaignid string, sample string, species string, maxn double"


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_one_campaign_is_replaced_alone(spark, tmp_path):
    store = StudyStore(spark, str(tmp_path), "my study", 4)
    first = [(c, f"s{i}", "a", float(i)) for c in ("x", "y/1", "z") for i in range(9)]
    store.replace("maxn", spark.createDataFrame(first, MAXN))
    before = files_of(tmp_path)
    store.replace("maxn", spark.createDataFrame([("y/1", "s1", "b", 5.0)], MAXN))
    kept = [r for r in first if r[0] != "y/1"]
    assert rows(store.table("maxn")) == sorted([*kept, ("y/1", "s1", "b", 5.0)], key=repr)
    after = files_of(tmp_path)
    assert {f for f in before if "campaign=x" in f or "campaign=z" in f} <= set(after)
    assert all(after[f] == t for f, t in before.items() if f in after)
    store.replace("maxn", store.table("maxn").where("campaignid = 'x' AND maxn > 4"), ["x", "y/1"])
    assert rows(store.table("maxn")) == sorted([r for r in first if r[0] == "z" or r[0] == "x" and r[3] > 4], key=repr)
    with pytest.raises(ValueError, match="not to be replaced"):
        store.replace("maxn", spark.createDataFrame([("x", "s", "a", 1.0)], MAXN), ["z"])
    with pytest.raises(FileNotFoundError):
        store.table("length")


def test_stored_tables_join_without_a_shuffle_in_any_session(spark, tmp_path):
    store = StudyStore(spark, str(tmp_path), "s", 4)
    store.replace("maxn", spark.createDataFrame([("x", f"s{i}", "a", float(i)) for i in range(40)], MAXN))
    store.replace("metadata", spark.createDataFrame([("x", f"s{i}", f"site {i}") for i in range(40)], "campaignid string, sample string, site string"))
    for name in ("maxn", "metadata"):
        spark.sql(f"DROP TABLE {store._known_as(name)}")  # as in a session that did not write them
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = store.table("maxn").join(store.table("metadata"), ["campaignid", "sample"])
        grouped = out.groupBy("campaignid", "sample").count()
        for df in (out, grouped):
            assert df.count() == 40
            df.collect()
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    from fathomframe.sources import store as module

    monkeypatch.setattr(module, "TASK_BYTES", 4000)
    store = StudyStore(spark, str(tmp_path), "s", 2)
    first = [(c, f"s{i}", "a", float(i)) for c in ("x", "y") for i in range(150)]
    store.replace("maxn", spark.createDataFrame(first, MAXN))
    store.replace("metadata", spark.createDataFrame([("x", f"s{i}", f"site {i}") for i in range(5)], "campaignid string, sample string, site string"))
    most = max(len(spark.read.parquet(f).collect()) for f in files_of(tmp_path / "s.maxn"))
    assert most <= 60  # of 300 rows of some 85 bytes
    out = store.table("maxn").hint("merge").join(store.table("metadata"), ["campaignid", "sample"])
    assert out.count() == 5 and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    # a campaign that outgrows the buckets is written as several files of a bucket, and still joins by bucket
    more = [("x", f"s{i}", "b", float(i)) for i in range(900)]
    store.replace("maxn", spark.createDataFrame(more, MAXN))
    files = files_of(tmp_path / "s.maxn" / "campaign=x")
    assert max(len(spark.read.parquet(f).collect()) for f in files) <= 90
    assert rows(store.table("maxn")) == sorted([*more, *[r for r in first if r[0] == "y"]], key=repr)
    out = store.table("maxn").hint("merge").join(store.table("metadata"), ["campaignid", "sample"])
    assert out.count() == 5 and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_states_tell_what_changed(spark, tmp_path):
    root = str(tmp_path / "in")
    for c in "abc":
        put(root, f"P/{c}/{c}_Metadata.csv", "Sample\ns1\n")
        put(root, f"P/{c}/{c}_Count.csv", f"Sample,Count\ns1,{c}\n")
        put(root, f"P/{c}/{c}_other.txt", "not read")
    kinds = ["_Metadata.csv", "_Count.csv"]
    before = campaign_states(spark, root, kinds)
    before = spark.createDataFrame(before.collect(), before.schema)
    shutil.copytree(root, tmp_path / "copy")
    assert changes(campaign_states(spark, str(tmp_path / "copy"), kinds), before).collect() == []
    put(root, "P/a/a_Count.csv", "Sample,Count\ns1,9\n")
    os.remove(os.path.join(root, "P/b/b_Count.csv"))
    shutil.rmtree(os.path.join(root, "P/c"))
    put(root, "P/d/d_Metadata.csv", "Sample\ns1\n")
    put(root, "P/a/a_other.txt", "changed")
    assert dict(rows(changes(campaign_states(spark, root, kinds), before))) == {"a": "changed", "b": "changed", "c": "removed", "d": "new"}
    assert campaign_states(spark, root, ["_nothing"]).collect() == []


def campaign(root, code, counts):
    put(root, f"P/{code}/{code}_Metadata.csv", META + "".join(f"s{i},1,2,20150910,9:23:00,L,F,NA,10,O,Yes,Yes,NA\n" for i in range(3)))
    put(root, f"P/{code}/{code}_Count.csv", "Sample,Family,Genus,Species,Count\n" + "".join(f"s{i},F,G,a,{n}\n" for i, n in enumerate(counts)))
    put(root, f"P/{code}/{code}_Length.csv", "Sample,Family,Genus,Species,Length,Number,Range\n" + "".join(f"s{i},F,G,a,{50 + n},1,1000\n" for i, n in enumerate(counts)))


def test_refreshed_study_equals_a_full_run(spark, tmp_path):
    root = str(tmp_path / "in")
    life = spark.createDataFrame([("F", "G", "a", "NW", "FL", 1.0, 3.0, 1.0, 0.0, 100.0, "TL")], ", ".join(
        f"{c} {'double' if c in ('a', 'b', 'all', 'bll', 'fb_length_max') else 'string'}" for c in check.LIFE_HISTORY_COLUMNS))
    store = StudyStore(spark, str(tmp_path / "out"), "study", 2)

    def full():
        raw = gather_study(spark, root)
        return check_study(raw["maxn"], raw["length3dpoints"], life, metadata=raw["metadata"])[1]

    def agrees():
        for name, want in full().items():
            assert rows(store.table(name), *want.columns) == rows(want), name

    for code, counts in (("a", (1, 2)), ("b", (3, 4)), ("c", (5, 90))):
        campaign(root, code, counts)
    assert refresh_study(spark, root, store, life) == {c: "new" for c in "abc"}
    agrees()
    assert refresh_study(spark, root, store, life) == {}
    held = files_of(tmp_path / "out")
    campaign(root, "b", (7,))
    assert refresh_study(spark, root, store, life) == {"b": "changed"}
    agrees()
    after = files_of(tmp_path / "out")
    assert all(after.get(f) == t for f, t in held.items() if "campaign=a" in f or "campaign=c" in f)
    shutil.rmtree(os.path.join(root, "P/a"))
    campaign(root, "d", (8, 1, 2))
    assert refresh_study(spark, root, store, life) == {"a": "removed", "d": "new"}
    agrees()
    shutil.rmtree(os.path.join(root, "P/d"))
    assert refresh_study(spark, root, store, life) == {"d": "removed"}
    agrees()
