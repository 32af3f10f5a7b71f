"""Registered queries: source-trust tiers, name normalisation, variant clusters,
canonical brands, assignment and brand-count reduction (B1-B7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.functions import entity as EN
from lexgrid.operators import resolve as R
from lexgrid.operators import spelling as SP
from lexgrid.plans.catalog import register
from lexgrid.plans.sqltext import sql_str
from lexgrid.plans.tables import FAMILY, LISTINGS_SQL, PLACE, listings, load

WS = "[ \\t\\n\\r\\f\\x0B]"


def tier_sql(flag: str = "laiyuan1_id", bid: str = "brand_id") -> str:
    return (f"CAST(CASE WHEN lower(trim({flag})) IN ('yes', 'y', 'true', '1', '是') THEN 1 "
            f"WHEN coalesce(trim({bid}), '') LIKE '99998888%' THEN 3 "
            f"WHEN coalesce(trim({bid}), '') LIKE '9999%' THEN 2 ELSE 4 END AS INTEGER)")


def norm_sql(col: str) -> str:
    cut = f"regexp_replace({col}, '{EN.BRANCH_SUFFIX}', '')"
    folded = f"lower(translate({cut}, {sql_str(EN.FULLWIDTH_FROM)}, {sql_str(EN.HALFWIDTH_TO)}))"
    return f"trim(regexp_replace({folded}, '{WS}+', ' ', 'g'))"


def clusters_sql(names: str, min_len: int = SP.DEFAULT_MIN_LEN, p: str = "", known: str | None = None) -> str:
    """Recursive-CTE twin of ``name_clusters`` with k = 1 over a one-column query ``names(name)``; ``p`` is put in
    front of the CTE names, ``known`` is a query of the names whose statistics hold (default: all)."""
    han = f"regexp_matches(name, '{SP.HAN}') AND length(name) >= {SP.STEM}"
    return f"""
{p}names AS (SELECT DISTINCT name FROM ({names}) n0 WHERE name IS NOT NULL),
{p}known AS (SELECT DISTINCT name FROM ({known or names}) n0 WHERE {han}),
{p}total AS (SELECT {SP.PRIOR} + count(*) AS n, CAST(round(2000 * log2({SP.PRIOR} + count(*))) AS BIGINT) AS bound FROM {p}known),
{p}weights AS (SELECT substr(name, i, 2) AS gram, CAST(round(1000 * log2(any_value(t.n) / count(DISTINCT name))) AS BIGINT) AS w
               FROM {p}known, {p}total t, range(1, length(name)) r(i) GROUP BY 1),
{p}told AS (SELECT name, i + 1 AS len, sum(coalesce(w, bound // 2)) OVER (PARTITION BY name ORDER BY i) AS told, bound
            FROM (SELECT name, i, substr(name, i, 2) AS gram FROM {p}names, range(1, length(name)) r(i) WHERE {han}) g
            LEFT JOIN {p}weights USING (gram), {p}total),
{p}v AS (SELECT name, name AS sig FROM {p}names
      UNION
      SELECT name, substr(name, 1, i - 1) || substr(name, i + 1) AS sig
      FROM {p}names, range(1, length(name) + 1) t(i)
      UNION
      SELECT name, chr(1) || left(name, CAST(len AS INT)) FROM {p}told WHERE told >= bound AND len >= greatest({SP.STEM}, ceil(length(name) / 2))),
{p}sig AS (SELECT *, regexp_replace(name, '[^0-9]', '', 'g') AS digits FROM {p}v WHERE length(sig) >= {min_len} OR sig = name),
{p}rep AS (SELECT sig, digits, min(name) AS rep FROM {p}sig GROUP BY sig, digits),
{p}links AS (SELECT DISTINCT s.name AS src, r.rep AS dst FROM {p}sig s JOIN {p}rep r USING (sig, digits)
          WHERE s.name <> r.rep),
{p}und AS (SELECT src AS a, dst AS b FROM {p}links UNION SELECT dst, src FROM {p}links),
{p}cc(node, label) AS (SELECT name, name FROM {p}names
                    UNION
                    SELECT u.b, {p}cc.label FROM {p}cc JOIN {p}und u ON {p}cc.node = u.a),
{p}clusters AS (SELECT node AS name, min(label) AS cluster FROM {p}cc GROUP BY node)
"""


@register("trust_tier_listings", f"""
SELECT id, {tier_sql()} AS tier FROM ({LISTINGS_SQL}) l
""")
def trust_tier_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: 1 source-1 flag, 2 id prefix 9999, 3 id prefix 99998888, 4 other."""
    lst = listings(spark, sf_dir)
    return lst.select("id", EN.trust_tier("laiyuan1_id", "brand_id").alias("tier"))


@register("normalise_names", f"""
SELECT id, {norm_sql('shop_name')} AS name_norm FROM ({LISTINGS_SQL}) l
""")
def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: bracketed branch suffix dropped, width folded, lower case, spaces collapsed."""
    lst = listings(spark, sf_dir)
    return lst.select("id", EN.normalise_name("shop_name").alias("name_norm"))


@register("variant_links", f"""
WITH RECURSIVE {clusters_sql('SELECT p_name AS name FROM part')}
SELECT src, dst FROM links
""")
def variant_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star edges between part names that are one deletion apart on each side."""
    return SP.variant_links(load(spark, sf_dir, "part"), "p_name")


@register("variant_clusters", f"""
WITH RECURSIVE {clusters_sql('SELECT p_name AS name FROM part')}
SELECT name, cluster FROM clusters
""")
def variant_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 + B4: connected components of the variant links over all part names."""
    names = load(spark, sf_dir, "part").select("p_name").distinct()
    return R.name_clusters(names, "p_name")


@register("canonical_by_brand", f"""
SELECT brand_name,
       min({{'t': tier, 'k': id, 'v': shop_name}}).v AS canonical,
       min({{'t': tier, 'k': id, 'v': shop_name}}).t AS canonical_tier,
       min({{'t': tier, 'k': id, 'v': shop_name}}).k AS canonical_key
FROM (SELECT *, {tier_sql()} AS tier FROM ({LISTINGS_SQL}) l) x
GROUP BY brand_name
""")
def canonical_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each gold brand, the shop name of its most trusted listing."""
    lst = listings(spark, sf_dir).withColumn("tier", EN.trust_tier("laiyuan1_id", "brand_id"))
    return R.canonical_names(lst, "brand_name", "tier", "id", "shop_name")


def assign_sql(gold: str, known: str | None = None) -> str:
    """Twin of ``resolve_listings``; ``gold`` is an expression of the labelled brand ('' for none)."""
    return f"""
WITH RECURSIVE
lst AS (SELECT id, shop_brand, CASE WHEN {gold} <> '' THEN {gold} ELSE shop_brand END AS own,
               CASE WHEN {gold} <> '' THEN 0 ELSE {tier_sql()} END AS tier, nullif({norm_sql('shop_name')}, '') AS name_norm
        FROM ({LISTINGS_SQL}) l),
{clusters_sql('SELECT name_norm AS name FROM lst', known=known)},
wc AS (SELECT lst.*, c.cluster FROM lst LEFT JOIN clusters c ON lst.name_norm = c.name),
canon AS (SELECT cluster, min({{'t': tier, 'k': id, 'v': own}}).v AS canonical
          FROM wc WHERE own <> '' AND cluster IS NOT NULL GROUP BY cluster),
sp AS (SELECT wc.*, coalesce(canon.canonical, wc.own) AS text FROM wc LEFT JOIN canon USING (cluster)),
sn AS (SELECT sp.*, nullif({norm_sql('text')}, '') AS brand_norm FROM sp),
{clusters_sql('SELECT brand_norm AS name FROM sn', p='b_')},
sg AS (SELECT sn.*, c.cluster AS spelling FROM sn LEFT JOIN b_clusters c ON sn.brand_norm = c.name),
best AS (SELECT spelling, min({{'t': tier, 'k': id, 'v': text}}).v AS canonical FROM sg WHERE spelling IS NOT NULL GROUP BY spelling)
SELECT sg.id, sg.cluster, sg.tier, coalesce(best.canonical, {norm_sql('sg.shop_brand')}, '') AS brand_name
FROM sg LEFT JOIN best USING (spelling)
"""


_ASSIGN_SQL = assign_sql("''")


@register("assign_canonical", _ASSIGN_SQL)
def assign_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing gets the brand of its cluster's most trusted listing."""
    return R.resolve_listings(listings(spark, sf_dir))


@register("brand_reduction", f"""
WITH a AS ({_ASSIGN_SQL})
SELECT (SELECT count(DISTINCT shop_brand) FROM ({LISTINGS_SQL}) l WHERE shop_brand <> '') AS brands_before,
       (SELECT count(DISTINCT brand_name) FROM a WHERE brand_name <> '') AS brands_after
""")
def brand_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct brands before and after resolution."""
    lst = listings(spark, sf_dir)
    resolved = R.resolve_listings(lst)
    return R.brand_reduction(lst, "shop_brand", resolved, "brand_name")


# the first batch: every second listing, with its label; the second batch: the rest, without
_TRAIN = "CAST(id AS BIGINT) % 2 = 0"


@register("assign_increments", f"""
SELECT id, CAST(tier AS INTEGER) AS tier, brand_name FROM (
{assign_sql(f"CASE WHEN {_TRAIN} THEN brand_name ELSE '' END", known=f"SELECT name_norm AS name FROM lst WHERE CAST(id AS BIGINT) % 2 = 0")})
""")
def assign_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled batch, then one without labels, against one index: the rows of a single run over both."""
    lst = listings(spark, sf_dir)
    index = R.ListingIndex(spark, gold="brand_name")
    train, test = lst.where(_TRAIN), lst.where(f"NOT ({_TRAIN})").withColumn("brand_name", F.lit(""))
    index.add(train)
    index.add(test)
    return index.resolve(train.unionByName(test))


_PLANTED_SQL = f"""
WITH RECURSIVE
lst AS (SELECT CAST(id AS BIGINT) AS n, nullif({norm_sql('shop_name')}, '') AS name FROM ({LISTINGS_SQL}) l),
{clusters_sql('SELECT name FROM lst')},
w AS (SELECT n, cluster, CASE WHEN n % {FAMILY} = 0 THEN 'f' || (n // {2 * FAMILY}) ELSE 'p' || n END AS truth
      FROM lst JOIN clusters USING (name) WHERE n % {FAMILY} = 0 OR n % {PLACE} = 0),
pairs AS (SELECT a.truth = b.truth AS same, a.cluster = b.cluster AS linked FROM w a JOIN w b ON a.n < b.n)
SELECT CAST(count(*) FILTER (same) AS BIGINT) AS true_pairs, CAST(count(*) FILTER (linked) AS BIGINT) AS linked_pairs,
       CAST(count(*) FILTER (same AND linked) AS BIGINT) AS found_pairs,
       round(count(*) FILTER (same AND linked) / nullif(count(*) FILTER (linked), 0), 6) AS precision,
       round(count(*) FILTER (same AND linked) / nullif(count(*) FILTER (same), 0), 6) AS recall
FROM pairs
"""


@register("variant_quality", _PLANTED_SQL)
def variant_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall of the clusters on the planted names: brands of two shops, and shops that share a place name."""
    n = F.col("id").cast("bigint")
    lst = listings(spark, sf_dir).select(n.alias("n"), R.blank_to_null("shop_name").alias("name"))
    clusters = R.name_clusters(lst, "name")
    truth = F.when(F.col("n") % FAMILY == 0, F.concat(F.lit("f"), F.floor(F.col("n") / (2 * FAMILY)))).otherwise(F.concat(F.lit("p"), "n"))
    planted = lst.where((F.col("n") % FAMILY == 0) | (F.col("n") % PLACE == 0)).join(clusters, "name").select("cluster", truth.alias("truth"))
    # pairs counted from group sizes: none is made
    sizes = planted.groupBy("truth", "cluster").agg(F.count(F.lit(1)).alias("m")).checkpoint()
    pairs = lambda *by: sizes.groupBy(*by).agg(F.sum("m").alias("m")).agg(
        F.coalesce(F.sum(F.col("m") * (F.col("m") - 1) / 2), F.lit(0)).cast("bigint")).first()[0]
    same, linked, found = pairs("truth"), pairs("cluster"), pairs("truth", "cluster")
    share = lambda part, whole: round(part / whole, 6) if whole else None
    return spark.createDataFrame([(same, linked, found, share(found, linked), share(found, same))],
                                 "true_pairs bigint, linked_pairs bigint, found_pairs bigint, precision double, recall double")


@register("brand_counts_by_runs", f"""
SELECT tier, count(DISTINCT CAST(id AS BIGINT) % 3) AS runs, count(*) AS rows, count(DISTINCT shop_name) AS exact, true AS within_bound
FROM (SELECT *, {tier_sql()} AS tier FROM ({LISTINGS_SQL}) l) x WHERE shop_name <> '' GROUP BY ROLLUP (tier)
""")
def brand_counts_by_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct shop names per tier from the merged sketches of three runs, beside the exact counts; four standard errors bound the difference."""
    lst = listings(spark, sf_dir).select("id", "shop_name", EN.trust_tier("laiyuan1_id", "brand_id").alias("tier"))
    counts = R.BrandCounts(spark)
    for run in range(3):
        counts.add(f"run {run}", lst.where(F.col("id").cast("bigint") % 3 == run), "shop_name", "tier")
    exact = lst.where("shop_name <> ''").rollup("tier").agg(F.count_distinct("shop_name").alias("exact"))
    both = counts.merged().withColumnRenamed("tier", "t").join(exact, F.col("t").eqNullSafe(F.col("tier")))
    return both.select("tier", "runs", "rows", "exact", (F.abs(F.col("brands") - F.col("exact")) <= 4 * R.BrandCounts.ERROR * F.col("exact") + 1).alias("within_bound"))
