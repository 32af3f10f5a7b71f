"""Entity resolution under the source-trust rule over spelling clusters (``spelling``).

A listing's brand is that of its shop: listings whose shop names are variants of each other form a cluster,
and the most trusted brand text in it is everybody's. Brand texts that are spellings of each other then merge in
the same way. Trust is the tier of the source; a labelled ``brand_name``, where there is one, outranks all tiers.

``resolve_listings`` does this for one table. ``ListingIndex`` keeps what a later batch needs: the
spelling index of shop names and, per cluster, its most trusted listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.functions.entity import normalise_name, trust_tier
from lexgrid.operators.components import connected_components, with_singletons
from lexgrid.operators.spelling import (DEFAULT_K, DEFAULT_MIN_LEN, NameStatistics, SpellingIndex, distinct_names,
                                        links_between)
from lexgrid.session import scratch_path

GOLD_TIER = 0


def name_clusters(names: DataFrame, name: str, k: int = DEFAULT_K, min_len: int = DEFAULT_MIN_LEN,
                  statistics: NameStatistics | None = None) -> DataFrame:
    """B3 + B4: ``name, cluster`` (cluster = smallest name of its component)."""
    named = distinct_names(names, name)
    comps = connected_components(links_between(named, k, min_len, statistics), "src", "dst")
    return with_singletons(named, "name", comps) \
        .select(F.col("node").alias("name"), F.col("component").alias("cluster"))


def canonical_names(df: DataFrame, cluster: str, tier: str, key: str, value: str) -> DataFrame:
    """Per cluster, the value of the most trusted row (lowest tier, then smallest key).

    A plain aggregate over ``min(struct(tier, key, value))``: partial
    aggregation, so a cluster holding a third of all rows costs one row per task.
    """
    best = F.min(F.struct(F.col(tier).alias("t"), F.col(key).alias("k"), F.col(value).alias("v")))
    return df.groupBy(cluster).agg(best.alias("_b")).select(
        cluster, F.col("_b.v").alias("canonical"), F.col("_b.t").alias("canonical_tier"),
        F.col("_b.k").alias("canonical_key"))


def blank_to_null(name: Column | str) -> Column:
    return F.nullif(normalise_name(name), F.lit(""))


def staged_listings(listings: DataFrame, key: str, shop_name: str, brand: str, flag: str, brand_id: str, gold: str | None) -> DataFrame:
    """``key, own, text, tier, name_norm``: text and tier of the label where there is one, else of the listing."""
    labelled = F.coalesce(F.col(gold), F.lit("")) != "" if gold else F.lit(False)
    return listings.select(
        F.col(key).alias("key"), F.col(brand).alias("own"),
        (F.when(labelled, F.col(gold)).otherwise(F.col(brand)) if gold else F.col(brand)).alias("text"),
        F.when(labelled, F.lit(GOLD_TIER)).otherwise(trust_tier(flag, brand_id)).alias("tier"), blank_to_null(shop_name).alias("name_norm"))


def _merged_spellings(texts: DataFrame, k: int, min_len: int) -> DataFrame:
    """``brand_norm, best``: of brand texts (``tier, key, text``) that are spellings of each other, the most trusted one."""
    texts = texts.select("tier", "key", "text", blank_to_null("text").alias("brand_norm")).where("brand_norm IS NOT NULL").checkpoint()
    groups = name_clusters(texts, "brand_norm", k, min_len).withColumnsRenamed({"name": "brand_norm", "cluster": "spelling"}).checkpoint()
    best = canonical_names(texts.join(groups, "brand_norm"), "spelling", "tier", "key", "text")
    return groups.join(best.select("spelling", F.col("canonical").alias("best")), "spelling").select("brand_norm", "best")


def resolve_listings(listings: DataFrame, key: str = "id", shop_name: str = "shop_name",
                     brand: str = "shop_brand", flag: str = "laiyuan1_id",
                     brand_id: str = "brand_id", k: int = DEFAULT_K, min_len: int = DEFAULT_MIN_LEN,
                     gold: str | None = None, statistics: NameStatistics | None = None) -> DataFrame:
    """B1 + B2 + B3 + B4 + B5 + B6: every listing gets one canonical brand.

    Listings cluster by the variant clusters of their normalised shop names; the cluster's
    brand is the brand text of its most trusted listing that has one. Then the brand
    texts so far cluster by the variants of their normalised spelling, and each takes
    the text of its most trusted listing. ``gold`` names a column of labelled brands, which outrank all. A blank or null
    shop name never clusters (its ``cluster`` is null); a listing left without any brand text gets the empty text. Every
    row of ``listings`` comes out.
    """
    staged = staged_listings(listings, key, shop_name, brand, flag, brand_id, gold).checkpoint()
    named = name_clusters(staged.select("name_norm").distinct(), "name_norm", k, min_len, statistics)
    shops = staged.join(named.withColumnRenamed("name", "name_norm"), "name_norm", "left").drop("name_norm").checkpoint()
    by_shop = canonical_names(shops.where((F.col("text") != "") & F.col("cluster").isNotNull()), "cluster", "tier", "key", "text")
    spelled = shops.join(by_shop.select("cluster", "canonical"), "cluster", "left").select(
        "key", "own", "tier", "cluster", F.coalesce("canonical", "text").alias("text")).checkpoint()
    # one row per text: its most trusted listing
    texts = spelled.groupBy("text").agg(F.min(F.struct("tier", "key")).alias("m")).select("m.tier", "m.key", "text")
    found = _merged_spellings(texts, k, min_len)
    return spelled.withColumn("brand_norm", blank_to_null("text")).join(found, "brand_norm", "left").select(
        F.col("key").alias(key), "cluster", "tier", F.coalesce("best", normalise_name("own"), F.lit("")).alias("brand_name"))


class ListingIndex:
    """Listings resolved batch by batch, in the folder ``path``: a first batch with labels, then listings without.

    ``add`` takes a batch in: only its new names are looked up in the spelling index, and what is kept per batch is
    a row per cluster (its most trusted listing, and its most trusted one with a brand text) and one per brand text of
    listings without a shop name. ``resolve`` gives every listing its brand by all batches so far. The statistics
    of the first batch's names hold for all later ones.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, k: int = DEFAULT_K, min_len: int = DEFAULT_MIN_LEN, **columns: str | None):
        self.spark, self.path, self.k, self.min_len = spark, path or scratch_path(spark, "listing-index"), k, min_len
        self.columns = {"key": "id", "shop_name": "shop_name", "brand": "shop_brand", "flag": "laiyuan1_id", "brand_id": "brand_id", "gold": None, **columns}
        self.index: SpellingIndex | None = None

    def _names(self, staged: DataFrame | None = None) -> SpellingIndex:
        if self.index is None:
            statistics = None if staged is None else NameStatistics.of(distinct_names(staged, "name_norm"))
            self.index = SpellingIndex(self.spark, f"{self.path}/names", k=self.k, min_len=self.min_len, statistics=statistics)
        return self.index

    def _clustered(self, staged: DataFrame) -> DataFrame:
        found = self._names().clusters().select(F.col("name").alias("name_norm"), "c1", "c2")
        return staged.join(found, "name_norm", "left")

    def add(self, listings: DataFrame) -> None:
        staged = staged_listings(listings, **self.columns).checkpoint()
        self._names(staged).add(staged, "name_norm")
        rows = self._clustered(staged).checkpoint()
        first = F.min(F.struct("tier", "key")).alias("first")
        best = F.min(F.when(F.col("text") != "", F.struct("tier", "key", "text"))).alias("best")
        rows.where("c1 IS NOT NULL").groupBy("c1", "c2").agg(first, best).write.mode("append").parquet(f"{self.path}/clusters")
        rows.where("c1 IS NULL AND text <> ''").groupBy("text").agg(first).write.mode("append").parquet(f"{self.path}/loose")

    def resolve(self, listings: DataFrame) -> DataFrame:
        """``key, tier, brand_name`` of listings whose names were added (others are resolved by their own brand text)."""
        kept = self._names()._now(self.spark.read.parquet(f"{self.path}/clusters"))
        shops = kept.groupBy("c1", "c2").agg(F.min("first").alias("first"), F.min("best").alias("best")).checkpoint()
        texts = shops.where("best IS NOT NULL").select("first.*", "best.text").unionByName(
            self.spark.read.parquet(f"{self.path}/loose").select("first.*", "text"))
        found = _merged_spellings(texts, self.k, self.min_len)
        staged = self._clustered(staged_listings(listings, **self.columns))
        spelled = staged.join(shops.select("c1", "c2", F.col("best.text").alias("canonical")), ["c1", "c2"], "left").withColumn(
            "brand_norm", blank_to_null(F.coalesce("canonical", "text")))
        return spelled.join(found, "brand_norm", "left").select(
            F.col("key").alias(self.columns["key"]), "tier", F.coalesce("best", normalise_name("own"), F.lit("")).alias("brand_name"))


def brand_reduction(before: DataFrame, before_col: str, after: DataFrame, after_col: str,
                    exact: bool = True) -> DataFrame:
    """Distinct non-empty brand names before and after resolution."""
    agg = F.countDistinct if exact else F.approx_count_distinct
    tagged = (before.select(F.lit(True).alias("_before"), F.col(before_col).cast("string").alias("_v"))
              .unionByName(after.select(F.lit(False).alias("_before"),
                                        F.col(after_col).cast("string").alias("_v")))
              .where(F.col("_v") != ""))
    # one aggregation over both sides (null values are not counted)
    return tagged.agg(
        F.coalesce(agg(F.when(F.col("_before"), F.col("_v"))), F.lit(0)).alias("brands_before"),
        F.coalesce(agg(F.when(~F.col("_before"), F.col("_v"))), F.lit(0)).alias("brands_after"))


class BrandCounts:
    """B7 by runs: per run and tier, a sketch of its distinct brands in the folder ``path``.

    A new run writes its own rows; the counts over all runs merge the sketches, so no old listing is read again. The
    relative standard error of an estimate is ``ERROR`` (HyperLogLog with ``2 ** LG_K`` registers), at any number of runs.
    """

    LG_K = 14
    ERROR = 1.04 / 2 ** (LG_K / 2)

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "brand-counts")

    def add(self, run: str, df: DataFrame, brand: str, tier: str) -> None:
        known = df.where(F.coalesce(F.col(brand), F.lit("")) != "")
        known.groupBy(F.lit(run).alias("run"), F.col(tier).alias("tier")).agg(
            F.hll_sketch_agg(brand, F.lit(self.LG_K)).alias("sketch"), F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(self.path)

    def merged(self) -> DataFrame:
        """``tier, runs, rows, brands``: over all runs, per tier and (``tier`` null) in all."""
        kept = self.spark.read.parquet(self.path)
        return kept.rollup("tier").agg(F.count_distinct("run").alias("runs"), F.sum("rows").alias("rows"),
                                       F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("brands"))
