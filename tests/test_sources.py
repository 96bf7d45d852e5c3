import os

import pytest
from pyspark.sql import functions as F

from fathomframe.plans.study import gather_counts, gather_study
from fathomframe.sources import catalog as cat
from fathomframe.sources import files, manifest, sinks


def put(root, relative, text):
    path = os.path.join(root, relative)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(
        [("2011-09_Bay_video", "Bay project", ("a@x.org",), [("NSW one BRUVS",), ("Other",)]),
         ("2012-01_Bay_Video", "Bay project", ("b@x.org",), []),
         ("2013-01_Reef_video", "Reef project", ("a@x.org",), [("nsw-bruvs",)])],
        "name string, project string, user struct<email: string>, workgroups array<struct<name: string>>")


@pytest.mark.parametrize("filters,found", [
    ([{"name": "name", "op": "eq", "val": "2012-01_Bay_Video"}], [1]),
    ([{"name": "name", "op": "like", "val": "%_video"}], [0, 2]),
    ([{"name": "name", "op": "ilike", "val": "%_VIDEO"}], [0, 1, 2]),
    ([{"name": "user", "op": "has", "val": {"name": "email", "op": "eq", "val": "a@x.org"}}], [0, 2]),
    ([{"name": "workgroups", "op": "any", "val": {"name": "name", "op": "like", "val": "Oth%"}}], [0]),
    ([{"name": "name", "op": "like", "val": "%Bay%"},
      {"name": "user", "op": "has", "val": {"name": "email", "op": "eq", "val": "a@x.org"}}], [0]),
    (None, [0, 1, 2]), ("", [0, 1, 2]),
])
def test_campaign_search(catalog, filters, found):
    names = ["2011-09_Bay_video", "2012-01_Bay_Video", "2013-01_Reef_video"]
    got = [r["name"] for r in cat.campaign_search(catalog, filters).collect()]
    assert sorted(got) == [names[i] for i in found]


def test_search_shortcuts_and_restriction(spark, catalog):
    assert cat.by_project(catalog, "Bay+project").count() == 2
    assert cat.by_workgroup(catalog, "Other").count() == 1
    table = spark.createDataFrame([("2013-01_Reef_video", 1), ("x", 2)], ["campaignid", "n"])
    assert rows(cat.restrict(table, cat.by_name(catalog, "2013-01_Reef_video")), "n") == [(1,)]
    with pytest.raises(ValueError, match="unknown filter"):
        cat.campaign_search(catalog, [{"name": "name", "op": "near", "val": "x"}])


def test_scan_binds_by_name(spark, tmp_path):
    root = str(tmp_path)
    put(root, "Proj A/camp+1/camp+1_Metadata.csv", 'Sample,Depth,"Comment (Y/N)"\ns1,5,"a, ""b"""\ns2,NA,\n')
    put(root, "Proj A/camp 2/camp 2_Metadata.csv", "Depth,Sample\n7,s1\n")
    put(root, "Proj B/camp[3]/camp[3]_Metadata.csv", "Sample,Depth,Extra\ns9,1,x\n")
    put(root, "Proj B/camp[3]/camp[3]_Count.csv", "Sample,Count\ns9,1\n")
    out = files.scan_files(spark, root, "_Metadata.csv")
    assert out.columns[:2] == ["project", "campaignid"]
    assert rows(out, "project", "campaignid", "sample", "depth", "comment_y_n_", "extra") == [
        ("Proj A", "camp 2", "s1", "7", None, None), ("Proj A", "camp+1", "s1", "5", 'a, "b"', None),
        ("Proj A", "camp+1", "s2", None, None, None), ("Proj B", "camp[3]", "s9", "1", None, "x")]
    with pytest.raises(FileNotFoundError):
        files.scan_files(spark, root, "_Nothing.csv")


def test_flat_layout(spark, tmp_path):
    put(str(tmp_path), "2015-09_Bay_Metadata.csv", "Sample,Depth\ns1,5\n")
    out = files.scan_files(spark, str(tmp_path), "_Metadata.csv", layout="flat")
    assert rows(out) == [("2015-09_Bay", "s1", "5")]


def test_tab_files_with_different_columns(spark, tmp_path):
    root = str(tmp_path)
    put(root, "P/a/a_Habitat.point.score.txt", "Sample\tRelief: 0. Flat\tBiota: Hydroids \nx\t7.0\t1.0\n")
    put(root, "P/b/b_Habitat.point.score.txt", "Sample\tRelief: 0. Flat\ny\t3.0\n")
    assert rows(files.scan_tsv(spark, root), "campaignid", "sample", "relief_0_flat", "biota_hydroids") == [
        ("a", "x", "7.0", "1.0"), ("b", "y", "3.0", None)]


def test_campaign_info(spark, tmp_path):
    put(str(tmp_path), "P/a/info.csv", "name,value\nBait,NA\nCamera,x\n")
    assert rows(files.scan_campaign_info(spark, str(tmp_path))) == [
        ("P", "a", "Bait", None), ("P", "a", "Camera", "x")]


def test_write_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("s1", 'say "x", y', 1.0), ("s2", None, 0.0)],
                               "sample string, comment string, number double")
    path = sinks.write_csv_table(df, str(tmp_path), "study", "metadata")
    assert path.endswith("/study_metadata.csv")
    assert rows(files.scan_reference_table(spark, path)) == [("s1", 'say "x", y', "1.0"), ("s2", None, "0.0")]
    only = spark.read.parquet(sinks.write_length_columnar(df, str(tmp_path), "study"))
    assert rows(only, "sample") == [("s1",)]
    paths = sinks.write_tables({"a": df, "b": df}, str(tmp_path), "two", columnar=True)
    assert spark.read.parquet(paths["b"]).count() == 2


META = ("Sample,Latitude,Longitude,Date,Time,Location,Status,Site,Depth,Observer,"
        "Successful.count,Successful.length,Comment\n")


def test_gather_study(spark, tmp_path):
    root = str(tmp_path)
    put(root, "P/c/c_Metadata.csv", META + "s1,1,2,20150910,9:23:00,L,F,NA,10,O,Yes,Yes,NA\n"
        "s2,1,2,20150910,9:23:00,L,F,NA,10,O,No,No,NA\n")
    put(root, "P/c/c_Points.txt", "OpCode\tFilename\tFrame\tTime (mins)\tFamily\tGenus\tSpecies\tNumber\n"
        "s1\tv\t1\t0.5\tF\tG\ta\t2\ns1\tv\t1\t0.5\tF\tG\ta\t3\ns2\tv\t1\t0.5\tF\tG\ta\t3\n")
    put(root, "P/c/c_Lengths.txt", "OpCode\tLength (mm)\tRange (mm)\tNumber\tFamily\tGenus\tSpecies\n"
        "s1\t100\t5000\t1\tF\tG\ta\n")
    put(root, "P/c/c_3DPoints.txt", "OpCode\tRange (mm)\tNumber\tFamily\tGenus\tSpecies\n"
        "s1\t5000\t4\tF\tG\ta\n")
    put(root, "P/d/d_Metadata.csv", META + "s1,1,2,x,y,L,F,NA,10,O,Yes,Yes,NA\n")
    put(root, "P/d/d_Count.csv", "Sample,Family,Genus,Species,Count\ns1,F,G,b,6\ns1,F,G,c,0\n")
    put(root, "P/c/c_Habitat.point.score.txt", "Sample\tRelief: 0. Flat\ns1\t7.0\n")
    got = gather_study(spark, root)
    assert rows(got["maxn"], "campaignid", "sample", "species", "maxn", "time") == [
        ("c", "s1", "a", 5.0, "9:23:00"), ("d", "s1", "b", 6.0, "y")]
    assert rows(got["length3dpoints"], "sample", "length", "number", "date") == [
        ("s1", "100", "1", "20150910"), ("s1", None, "4", "20150910")]
    assert got["metadata"].count() == 3 and len(got["metadata"].columns) == 15
    assert got["habitat"].count() == 1


def test_gather_counts(spark, tmp_path):
    root = str(tmp_path)
    put(root, "P/c/c_Metadata.csv", "Sample,Site\ns1,x\n")
    put(root, "P/c/c_Count.csv", "Sample,Family,Genus,Species,Legal.sublegal,Count\n"
        "s1,F,G,a,legal,2\ns1,F,G,b,sublegal,1\n")
    put(root, "P/c/c_Length.csv", "Sample,Length\ns1,5\n")
    got = gather_counts(spark, root)["complete.count"]
    assert rows(got, "species", "legal_sublegal", "count", "site") == [
        ("a", "legal", 2.0, "x"), ("a", "sublegal", 0.0, "x"),
        ("b", "legal", 0.0, "x"), ("b", "sublegal", 1.0, "x")]
    assert got.select(F.sum("count")).first()[0] == 3.0


def test_hidden_names_line_breaks_and_info(spark, tmp_path):
    root = str(tmp_path)
    put(root, "P/_old/_old_Metadata.csv", "Sample,Comment\ns1,a\n")
    put(root, "P/d/_d_Metadata.csv", 'Sample,Comment\ns2,"two\nlines"\n')
    put(root, "P/n/n_Metadata.csv", 'Comment,Sample,Odd Name\n"q ""x""",s3,1\n')
    put(root, "P/n/.info.csv", 'name,value\nk,"v\n2"\n')
    put(root, "P/d/info.csv", "name,value\nk,NA\n")
    got = files.scan_files(spark, root, "_Metadata.csv", multi_line=True)
    assert rows(got) == [("P", "_old", "s1", "a", None), ("P", "d", "s2", "two\nlines", None), ("P", "n", "s3", 'q "x"', "1")]
    assert got.count() == 3
    assert rows(files.scan_campaign_info(spark, root)) == [("P", "d", "k", None), ("P", "n", "k", "v\n2")]
    flat = files.scan_files(spark, root, "_Metadata.csv", layout="flat", multi_line=True)
    assert rows(flat, "campaignid") == [("_d",), ("_old",), ("n",)]


def test_rows_of_another_width_are_not_lost(spark, tmp_path):
    root = str(tmp_path)
    put(root, "P/a/a_Count.csv", "Sample,Count\ns1,1\ns2,2,3\ns3\n")
    with pytest.raises(Exception, match="not as wide as its header"):
        files.scan_files(spark, root, "_Count.csv").count()
    assert rows(files.scan_files(spark, root, "_Count.csv", odd_rows="skip"), "sample") == [("s1",)]
    odd = files.odd_width_rows(spark, root, "_Count.csv")
    assert rows(odd, "campaignid", "record") == [("a", "s2,2,3"), ("a", "s3")] and odd.count() == 2


def test_gather_keeps_length_columns_and_takes_metadata_as_a_table(spark, tmp_path):
    root = str(tmp_path)
    put(root, "P/a/a_Length.csv", "Sample,Family,Genus,Species,Length,Number,Range,Activity,Comment\ns1,F,G,s,10,1,5,Feeding,x\n")
    meta = spark.createDataFrame([("a", "s1", "Yes", "Yes")], "campaignid string, sample string, successful_count string, successful_length string")
    out = gather_study(spark, root, metadata=meta)
    assert rows(out["length3dpoints"], "sample", "activity", "length") == [("s1", "Feeding", "10")]
    assert "comment" not in out["length3dpoints"].columns


def test_name_map(spark):
    table = spark.createDataFrame([("Biota.Sand", "Biota.Unconsolidated"), ("Biota.Sand", "Biota.Unconsolidated"), (None, "x")],
                                  "old_name string, new_name string")
    assert files.load_name_map(table) == [("biota_sand", "biota_unconsolidated")]


def test_columnar_lengths_leave_out_zero_rows(spark, tmp_path):
    table = spark.createDataFrame([("s1", 2.0), ("s2", 0.0)], "sample string, number double")
    out = sinks.write_tables({"complete.length": table, "complete.maxn": table}, str(tmp_path), "x", columnar=True)
    assert spark.read.parquet(out["complete.length"]).count() == 1
    assert spark.read.parquet(out["complete.maxn"]).count() == 2


def test_scratch_folder_must_be_named():
    from types import SimpleNamespace

    from fathomframe.session import scratch_root

    def session(setting):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: setting or default),
                               sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session(None))
    assert scratch_root(session("hdfs:///shared/")) == "hdfs:///shared"


def test_files_of_other_campaigns_are_never_opened(spark, tmp_path, catalog):
    root = str(tmp_path)
    for name in ("2011-09_Bay_video", "2012-01_Bay_Video", "2013-01_Reef_video"):
        put(root, f"P/{name}/{name}_Metadata.csv", META + "s1,1,2,20150910,9:23:00,L,F,NA,10,O,Yes,Yes,NA\n")
        put(root, f"P/{name}/{name}_Count.csv", "Sample,Family,Genus,Species,Count\ns1,F,G,b,6\n")
    for kind in ("Metadata", "Count"):  # a file that no one could read
        os.remove(os.path.join(root, f"P/2013-01_Reef_video/2013-01_Reef_video_{kind}.csv"))
        os.symlink("/proc/self/mem", os.path.join(root, f"P/2013-01_Reef_video/2013-01_Reef_video_{kind}.csv"))
    got = gather_study(spark, root, campaigns=cat.by_pattern(catalog, "%Bay%"))
    assert rows(got["maxn"], "campaignid", "maxn") == [("2011-09_Bay_video", 6.0), ("2012-01_Bay_Video", 6.0)]
    assert rows(got["metadata"], "campaignid") == [("2011-09_Bay_video",), ("2012-01_Bay_Video",)]
    with pytest.raises(Exception):
        gather_study(spark, root)["metadata"].count()
    assert set(gather_study(spark, root, campaigns=cat.by_name(catalog, "2012-01_Bay_Video"))) == {"metadata", "maxn"}
    with pytest.raises(FileNotFoundError):
        files.scan_metadata(spark, root, campaigns=cat.by_name(catalog, "nowhere"))


def test_one_scan_for_many_headers(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for i in range(40):
        names = ["Sample", f"Only {i}", "Depth"]
        put(root, f"P/c{i}/.c{i}_Metadata.csv" if i % 2 else f"P/c{i}/c{i}_Metadata.csv",
            ",".join(names[i % 3:] + names[: i % 3]) + "\n" + ",".join([f"s{i}", "x", str(i)][i % 3:] + [f"s{i}", "x", str(i)][: i % 3]) + "\n")
    monkeypatch.setattr(files, "_first_line", None)
    monkeypatch.setattr(files, "_readable", None)
    out = files.scan_files(spark, root, "_Metadata.csv")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan
    assert len(out.columns) == 44 and rows(out, "campaignid", "sample", "depth") == rows(spark.createDataFrame(
        [(f"c{i}", f"s{i}", str(i)) for i in range(40)], "campaignid string, sample string, depth string"))
    assert out.filter("only_7 = 'x'").count() == 1
    found = files.campaign_files(spark, root, "_Metadata.csv", campaigns=spark.createDataFrame([("c3",), ("c4",)], "name string"))
    got = {r["campaignid"]: (r["header"], r["size"]) for r in manifest.headers(found).collect()}
    assert got == {"c3": (["sample", "only_3", "depth"], len("Sample,Only 3,Depth\ns3,x,3\n")),
                   "c4": (["only_4", "depth", "sample"], len("Only 4,Depth,Sample\nx,4,s4\n"))}


@pytest.mark.parametrize("stretch", [1, 7, 64, 1 << 20])
def test_stretches_of_files_cover_each_line_once(spark, tmp_path, monkeypatch, stretch):
    root = str(tmp_path)
    lines = [f"s{i},{'é' * (i % 9)},{i}" for i in range(60)]
    put(root, "P/a/a_Count.csv", "Sample,Name,Count\n" + "\n".join(lines) + "\n")
    put(root, "P/b/b_Count.csv", "Sample,Count\r\nx,1\r\n\r\ny,2")
    put(root, "P/c/c_Count.csv", "Sample,Count\n")
    put(root, "P/d/d_Count.csv", "")
    monkeypatch.setattr(manifest, "STRETCH", stretch)
    monkeypatch.setattr(manifest, "BLOCK", 64)
    got = files.scan_files(spark, root, "_Count.csv", na=())
    want = [("a", *line.split(",")) for line in lines] + [("b", "x", None, "1"), ("b", "y", None, "2")]
    assert rows(got.fillna("", ["name"]), "campaignid", "sample", "name", "count") == sorted([(a, b, c or "", d) for a, b, c, d in want], key=repr)


def test_line_breaks_quotes_and_bad_bytes(spark, tmp_path):
    root = str(tmp_path)
    put(root, "P/a/a_Count.csv", '﻿"Sample\nname",Count\n"a ""q"", b","1\n2"\n" s ",\n')
    with open(os.path.join(root, "P/a/b_Count.csv"), "wb") as f:
        f.write(b"Count\n\xff1\n")
    got = files.scan_files(spark, root, "_Count.csv", multi_line=True)
    assert rows(got, "sample_name", "count") == sorted([('a "q", b', "1\n2"), (" s ", None), (None, "�1")], key=repr)


def test_spark_reads_what_tasks_cannot_open(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(root, "P/a/a_Count.csv", "Sample,Count\ns1,1\n")
    put(root, "P/b/_b_Count.csv", "Count,Sample\n2,s2\n")
    names = spark.createDataFrame([("b",)], "name string")
    both = [rows(files.scan_files(spark, root, "_Count.csv")), rows(files.scan_files(spark, root, "_Count.csv", campaigns=names, columns=["count"]))]
    monkeypatch.setattr(manifest, "opens", lambda root: False)
    assert both == [rows(files.scan_files(spark, root, "_Count.csv")), rows(files.scan_files(spark, root, "_Count.csv", campaigns=names, columns=["count"]))]
