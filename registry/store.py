"""Clustered tables, replaced campaigns and what changed since."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomframe.functions import columns as C
from fathomframe.sources import files
from fathomframe.sources.store import StudyStore, campaign_states, changes
from fathomframe.session import stored
from registry.book import query
from registry.files import by_folder, campaigns, fresh, write


@query("replace_campaign", """SELECT * FROM maxn_role WHERE campaignid <> 'R'
    UNION ALL SELECT * REPLACE (maxn + 1 AS maxn) FROM maxn_role WHERE campaignid = 'R' AND maxn > 5""")
def _(r):
    """One campaign of a stored table is replaced, the others stay as they are."""
    store = StudyStore(r.spark, fresh(r), "study", 4)
    store.replace("maxn", r.maxn())
    fewer = r.maxn().filter("campaignid = 'R' AND maxn > 5").withColumn("maxn", F.col("maxn") + 1)
    store.replace("maxn", fewer, ["R"])
    return store.table("maxn").select("campaignid", "sample", *C.TAXON, "maxn")


@query("stored_join", """SELECT l.*, location, status, depth FROM maxn_role l
    JOIN metadata m ON l.campaignid = m.campaignid AND l.sample = m.sample""")
def _(r):
    """Tables clustered alike join by sample without a shuffle."""
    store = StudyStore(r.spark, fresh(r), "study", 4)
    store.replace("maxn", r.maxn())
    store.replace("metadata", r.metadata().select(*C.SAMPLE, "location", "status", "depth"))
    return store.table("maxn").join(store.table("metadata"), list(C.SAMPLE))


@query("changed_campaigns", """SELECT * FROM (VALUES ('R', 'changed'), ('Z', 'removed')) t(campaignid, change)
    WHERE campaignid IN (SELECT campaignid FROM metadata)""")
def _(r):
    """Campaign files are written, then those of one campaign anew and those of another one deleted."""
    root = campaigns(r, ".csv")
    before = stored(campaign_states(r.spark, root, [".csv"]), "states")
    few = r.metadata().filter("campaignid = 'R' AND depth > 3").select("sample", "depth")
    write(few, f"{root}/study/R/R_Metadata.csv", mode="overwrite")
    fs, gone = files._file_system(r.spark, f"{root}/study/Z")
    fs.delete(gone, True)
    return by_folder(changes(campaign_states(r.spark, root, [".csv"]), before))
