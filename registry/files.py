"""Sources and sinks: the given tables written as campaign files and read back.

Every call writes into a folder of its own below the shared scratch folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from fathomframe.functions import columns as C
from fathomframe.session import scratch_root
from fathomframe.sources import catalog as cat
from fathomframe.sources import files, manifest, sinks
from registry.book import query


def fresh(r) -> str:
    """A new folder below the shared one; a session on this machine alone may go without that setting."""
    context = r.spark.sparkContext
    named = r.spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="survey-"))
    return f"{scratch_root(r.spark)}/survey-files-{uuid.uuid4().hex}"


def write(df, path: str, sep: str = ",", mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).option("nullValue", "NA").csv(path)


@query("scan_campaign_files", """SELECT 'study' AS project, campaignid, sample,
      CASE WHEN campaignid IN ('A', 'N') THEN location END AS location, status
    FROM metadata WHERE campaignid <> 'Z'
    UNION ALL SELECT 'study', 'Z', sample, location, NULL FROM metadata WHERE campaignid = 'Z'""")
def _(r):
    """Three kinds of header below one root."""
    root, meta = fresh(r), r.metadata()
    layouts = {"A": ("sample", "location", "status"), "N": ("status", "sample", "location"),
               "R": ("sample", "status"), "Z": ("location", "sample")}
    for code, columns in layouts.items():
        part = meta.filter(F.col("campaignid") == code).select(*columns)
        write(part.toDF(*[c.title() for c in columns]), f"{root}/study/{code}")
    return files.scan_files(r.spark, root, ".csv").select(
        "project", "campaignid", "sample", "location", "status")


@query("scan_tsv", """SELECT campaignid, project, sample, relief_0_flat::INTEGER::VARCHAR AS relief_0_flat,
      CASE WHEN campaignid <> 'Z' THEN sand::INTEGER::VARCHAR END AS biota_sand FROM habitat""")
def _(r):
    root = fresh(r)
    h = r.habitat().select("campaignid", "sample",
                           F.col("relief_0_flat").cast("int").alias("Relief: 0. Flat"),
                           F.col("sand").cast("int").alias("Biota: Sand "))
    for code in "ANRZ":
        part = h.filter(F.col("campaignid") == code).drop("campaignid")
        write(part.drop("Biota: Sand ") if code == "Z" else part,
               f"{root}/habitat/{code}", "\t")
    return files.scan_tsv(r.spark, root, ".csv")


@query("scan_campaign_info", """SELECT concat('P', o_custkey % 3) AS project,
      o_orderstatus AS campaignid, o_orderpriority AS name, max(o_custkey)::VARCHAR AS value
    FROM orders GROUP BY ALL""")
def _(r):
    root = fresh(r)
    info = (r.read("orders").groupBy(
                F.concat(F.lit("P"), F.col("o_custkey") % 3).alias("project"),
                F.col("o_orderstatus").alias("campaignid"),
                F.col("o_orderpriority").alias("name"))
            .agg(F.max("o_custkey").alias("value")))
    (info.repartition("project", "campaignid").write.partitionBy("project", "campaignid")
     .option("header", True).csv(root))
    back = files.scan_campaign_info(r.spark, root, ".csv")
    return back.withColumns({c: F.regexp_replace(c, "^.*=", "") for c in ("project", "campaignid")})


@query("scan_reference_table", """SELECT family, genus, species, marine_region, length_measure,
      fb_ltypemaxm FROM life_history""")
def _(r):
    sheet = r.life_history_sheet().select(*C.TAXON, "marine_region", "length_measure",
                                          "fb_ltypemaxm")
    path = sinks.write_csv_table(sheet.toDF(*[c.title().replace("_", ".") for c in sheet.columns]),
                                 fresh(r), "study", "life.history")
    return files.scan_reference_table(r.spark, path)


@query("write_csv_table", """SELECT campaignid, sample, coalesce(family, 'none') AS family,
      coalesce(nullif(genus, 'NA'), 'none') AS genus, coalesce(species, 'none') AS species
    FROM length_raw""")
def _(r):
    table = r.length_raw().select(*C.SAMPLE, *C.TAXON)
    path = sinks.write_csv_table(table, fresh(r), "study", "length")
    return files.scan_reference_table(r.spark, path).fillna("none")


@query("write_columnar", """SELECT campaignid, sample, genus, species, length, number - 1 AS number
    FROM observed WHERE number - 1 > 0""")
def _(r):
    rows = r.observed().select(*C.SAMPLE, "genus", "species", "length",
                               (F.col("number") - 1).alias("number"))
    return r.spark.read.parquet(sinks.write_length_columnar(rows, fresh(r), "study"))


def campaigns(r, suffix: str) -> str:
    """Metadata of four campaigns below one root, each with a header of its own."""
    root, meta = fresh(r), r.metadata()
    names = ["Sample", "Location", "Status", "Depth"]
    for i, code in enumerate("ANRZ"):
        shown = names[i:] + names[:i]
        part = meta.filter(F.col("campaignid") == code).select(*[F.col(n.lower()).alias(n) for n in shown if (n, code) != ("Status", "Z")])
        write(part, f"{root}/study/{code}/{code}_Metadata{suffix}")
    return root


def _catalog(r):
    """A and N belong to one workgroup, R and Z to another."""
    codes = r.metadata().select(F.col("campaignid").alias("name")).distinct()
    group = F.when(F.col("name").isin("A", "N"), "first group").otherwise("second group")
    return codes.select("name", F.lit("study").alias("project"), F.array(F.struct(group.alias("name"))).alias("workgroups"))


def by_folder(df):
    """Spark writes a folder where an export is one file, so the campaign is one folder further up."""
    return df.withColumn("campaignid", F.regexp_replace("campaignid", "_Metadata.*", ""))


@query("scan_selected_campaigns", """SELECT campaignid, sample, location, CASE WHEN campaignid <> 'Z' THEN status END AS status,
      depth::VARCHAR AS depth FROM metadata WHERE campaignid IN ('R', 'Z')""")
def _(r):
    """A search decides which files are read."""
    root = campaigns(r, ".csv")
    found = cat.by_workgroup(_catalog(r), "second+group")
    folders = found.select(F.concat("name", F.lit("_Metadata.csv")).alias("name"))
    return by_folder(files.scan_files(r.spark, root, ".csv", campaigns=folders)).select("campaignid", "sample", "location", "status", "depth")


@query("scan_mixed_headers", """SELECT 'study' AS project, concat('c', o_custkey % 7) AS campaignid, o_orderkey::VARCHAR AS orderkey,
      o_orderstatus AS status, CASE WHEN o_custkey % 7 < 4 THEN o_orderpriority END AS priority,
      CASE WHEN o_custkey % 7 >= 4 THEN o_orderpriority END AS level FROM orders""")
def _(r):
    """Seven headers, whose columns differ in order and name, in one scan."""
    root = fresh(r)
    orders = r.read("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    for i in range(7):
        names = {"orderkey": "OrderKey", "orderstatus": "Status", "orderpriority": "Priority" if i < 4 else "Level"}
        shown = list(names)[i % 3:] + list(names)[: i % 3]
        part = orders.filter(F.col("o_custkey") % 7 == i).select(*[F.col(f"o_{n}").alias(names[n]) for n in shown])
        write(part, f"{root}/study/c{i}")
    return files.scan_files(r.spark, root, ".csv").select("project", "campaignid", "orderkey", "status", "priority", "level")


@query("campaign_headers", """SELECT * FROM (VALUES ('A', 'sample,location,status,depth'), ('N', 'location,status,depth,sample'),
      ('R', 'status,depth,sample,location'), ('Z', 'depth,sample,location')) t(campaignid, header)
    WHERE campaignid IN (SELECT campaignid FROM metadata)""")
def _(r):
    """What the manifest of a folder tells of its files."""
    found = files.campaign_files(r.spark, campaigns(r, ".csv"), ".csv")
    heads = manifest.headers(found).where("size > 0").select("campaignid", F.array_join("header", ",").alias("header"))
    return by_folder(heads).distinct()
