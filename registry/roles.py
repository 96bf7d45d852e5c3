"""Survey tables derived from the given tables, as DataFrames.

``registry/role_sql.py`` states the same derivations as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The event types of the given data.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
# The part types of the given data, used as families.
FAMILIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def _taxon() -> list[Column]:
    return [F.col("p_type").alias("family"),
            F.concat("p_type", F.lit("-"), "p_brand").alias("genus"),
            F.concat(F.lit("sp"), F.col("p_size") % 3).alias("species")]


class Roles:
    """Builds each survey table on demand for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    def taxa(self) -> DataFrame:
        return self.read("part").select(*_taxon()).distinct()

    def _catch(self) -> DataFrame:
        """Line items with the taxon of their part."""
        part = self.read("part").select("p_partkey", *_taxon())
        line = self.read("lineitem").select(
            "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount",
            "l_linestatus", "l_extendedprice", F.col("l_returnflag").alias("campaignid"),
            _text("l_suppkey").alias("sample"))
        return line.join(part, line.l_partkey == part.p_partkey)

    def length(self) -> DataFrame:
        return self._catch().select(
            "campaignid", "sample", "family", "genus", "species",
            F.when(F.col("l_linenumber") != 7, F.col("l_quantity") * 20).alias("length"),
            F.when(F.col("l_tax") != 0.08, F.col("l_linenumber").cast("double")).alias("number"),
            (F.col("l_extendedprice") / 5).alias("range"),
            F.col("l_linestatus").alias("legal_sublegal"))

    def observed(self) -> DataFrame:
        """Lengths without the synchronisation points."""
        return self.length().filter(F.col("number").isNotNull()).drop("legal_sublegal")

    def length_raw(self) -> DataFrame:
        """Lengths as they come from annotation files: text, gaps, odd names."""
        return self._catch().select(
            "campaignid", "sample",
            F.when(F.col("l_discount") != 0.0, F.col("family")).alias("family"),
            F.when(F.col("l_discount") == 0.01, "NA").otherwise(F.col("genus")).alias("genus"),
            F.when(F.col("l_discount") != 0.02, F.upper("species")).alias("species"),
            F.when(F.col("l_linenumber") == 7, "")
            .otherwise((F.col("l_quantity") * 20).cast("int").cast("string")).alias("length"),
            F.when(F.col("l_tax") == 0.08, "none")
            .otherwise(_text("l_linenumber")).alias("number"),
            (F.col("l_extendedprice") / 5).alias("range"))

    def maxn(self) -> DataFrame:
        return (self._catch().groupBy("campaignid", "sample", "family", "genus", "species")
                .agg((F.sum("l_linenumber") + F.min("l_orderkey") % 3 - 1)
                     .cast("double").alias("maxn")))

    def count(self) -> DataFrame:
        return (self._catch().groupBy(
                    F.concat(F.lit("project-"), "campaignid").alias("project"),
                    "campaignid", "sample", "family", "genus", "species",
                    F.col("l_linestatus").alias("legal_sublegal"))
                .agg(F.sum("l_linenumber").cast("double").alias("count")))

    def metadata(self) -> DataFrame:
        supplier = self.read("supplier")
        nation = self.read("nation").select("n_nationkey", "n_name")
        codes = F.explode(F.array(*[F.lit(c) for c in "ANRZ"])).alias("campaignid")
        return (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
                .select(codes, _text("s_suppkey").alias("sample"),
                        F.col("n_name").alias("location"),
                        F.when(F.col("s_nationkey") % 2 == 0, "Fished")
                        .otherwise("No-take").alias("status"),
                        F.col("s_nationkey").cast("double").alias("depth"),
                        F.when(F.col("s_acctbal") < 500, "No").otherwise("Yes")
                        .alias("successful_count"),
                        F.when(F.col("s_acctbal") < 1500, "No").otherwise("Yes")
                        .alias("successful_length")))

    @staticmethod
    def _event_campaign() -> Column:
        return (F.when(F.col("user_id") % 3 == 0, "A").when(F.col("user_id") % 3 == 1, "N")
                .otherwise("R"))

    def points(self) -> DataFrame:
        return self.read("events").select(
            self._event_campaign().alias("campaignid"), _text("user_id").alias("sample"),
            F.date_format("ts", "yyyy-MM-dd").alias("frame"),
            (F.hour("ts") * 60 + F.minute("ts")).cast("double").alias("periodtime"),
            F.lit("Eventidae").alias("family"), F.col("event_type").alias("genus"),
            F.lit("spp").alias("species"), F.lit(1.0).alias("number"))

    def life_history(self) -> DataFrame:
        part = self.read("part").select(*_taxon(), "p_size", "p_retailprice")
        size, price = F.max("p_size"), F.max("p_retailprice")
        sp = F.col("species")
        return (part.groupBy("family", "genus", "species")
                .agg(size.alias("size"), price.alias("price"))
                .filter(~((F.col("family") == "PROMO") & (sp == "sp2")))
                .select(
                    "family", "genus", "species",
                    F.when(F.col("family").isin("ECONOMY", "LARGE"), "SW")
                    .when(F.col("family") == "MEDIUM", "N/NW").otherwise("NW")
                    .alias("marine_region"),
                    F.when(sp == "sp0", "FL").when(sp == "sp1", "TL").otherwise("SL")
                    .alias("length_measure"),
                    F.when((sp != "sp1") & ~((F.col("family") == "LARGE") & (sp == "sp0")),
                           F.col("price") / 1e5).alias("a"),
                    (F.col("size") / 100.0 + 2.5).alias("b"),
                    F.when(sp != "sp2", F.lit(0.5)).alias("all"),
                    F.when(sp != "sp2", F.lit(1.1)).alias("bll"),
                    F.when((sp != "sp0") & ~F.col("genus").endswith("Brand#13"),
                           F.col("size") * 20.0).alias("fb_length_max"),
                    F.when(sp == "sp0", "FL").otherwise("TL").alias("fb_ltypemaxm")))

    def life_history_sheet(self) -> DataFrame:
        """The same table as a sheet holds it: text, with words for gaps."""
        lh = self.life_history()
        text = {c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
                for c in ("a", "b", "all", "bll", "fb_length_max")}
        return lh.withColumns({
            **text, "global_region": F.when(F.col("family") == "SMALL", "Indonesia")
            .otherwise("Australia/Indonesia")})

    def synonyms(self) -> DataFrame:
        """Brand#7 moves to genus Brand#8; sp2 of Brand#9 becomes sp1."""
        taxa = self.taxa()
        old = [F.col(c) for c in ("family", "genus", "species")]
        moved = taxa.filter(F.col("genus").endswith("-Brand#7")).select(
            *old, F.col("family").alias("new_family"),
            F.concat("family", F.lit("-Brand#8")).alias("new_genus"),
            F.col("species").alias("new_species"))
        renamed = taxa.filter(F.col("genus").endswith("-Brand#9")
                              & (F.col("species") == "sp2")).select(
            *old, F.col("family").alias("new_family"), F.col("genus").alias("new_genus"),
            F.lit("sp1").alias("new_species"))
        return moved.unionByName(renamed)

    def habitat(self) -> DataFrame:
        """Point scores per sample, plus samples without any point."""
        def of(kind: str) -> Column:
            return F.sum(F.when(F.col("event_type") == kind, 1.0).otherwise(0.0))

        click, error, purchase, signup, view = (of(t) for t in EVENT_TYPES)
        scored = (self.read("events").groupBy("user_id").agg(
            click.alias("relief_0_flat"), error.alias("relief_1_some"),
            purchase.alias("relief_2_mostly"), signup.alias("relief_3_good"),
            view.alias("relief_4_high"),
            click.alias("fieldofview_open"), error.alias("fieldofview_limited"),
            click.alias("sponges_cups"), error.alias("sponges_tubes"),
            purchase.alias("macroalgae"), signup.alias("sand"), view.alias("open_water"))
            .withColumns({"campaignid": self._event_campaign(),
                          "sample": _text("user_id"), "project": F.lit("habitat")})
            .drop("user_id"))
        empty = self.read("supplier").select(_text("s_suppkey").alias("sample")).withColumns({
            **{c: F.lit(0.0) for c in scored.columns
               if c not in ("campaignid", "sample", "project")},
            "campaignid": F.lit("Z"), "project": F.lit("habitat")})
        return scored.unionByName(empty)

    def info(self) -> DataFrame:
        return (self.read("orders").groupBy(
                    F.concat(F.lit("P"), F.col("o_custkey") % 10).alias("project"),
                    _text("o_custkey").alias("campaignid"),
                    F.col("o_orderpriority").alias("name"))
                .agg(F.max("o_orderstatus").alias("value")))

    def catalog(self) -> DataFrame:
        customer = self.read("customer").select("c_name", "c_nationkey", "c_mktsegment")
        nation, region = self.read("nation"), self.read("region")
        return (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
                .join(region, nation.n_regionkey == region.r_regionkey)
                .select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("project"),
                        F.struct(F.concat(F.lower("n_name"), F.lit("@example.org"))
                                 .alias("email")).alias("user"),
                        F.array(F.struct(F.col("r_name").alias("name")),
                                F.struct(F.col("n_name").alias("name"))).alias("workgroups")))
