"""Driver tables and the derived views the registered queries run on.

``listings`` stands in for the brand task's shop listing (id, shop_name,
shop_brand, source-1 flag, brand_id, brand_name), derived row by row from
``part`` so that it grows with the data. A few NA-like words and misspelt brands are
planted in it so that cleaning and merging have something to do, and some names without spaces: two shops of one
brand begin alike (``FAMILY``), and unrelated shops begin with one place name (``PLACE``). ``LISTINGS_SQL`` is the
same view for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table, in the splits the scan gives."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


HAN_DIGITS = "云山海风林江月星石竹松梅兰菊茶酒"      # one character per hexadecimal digit
FAMILY, PLACE = 43, 41


def _han_name(seed: Column, length: int) -> Column:
    return F.translate(F.substring(F.md5(seed), 1, length), "0123456789abcdef", HAN_DIGITS)


def _han_shop(key: Column) -> Column:
    """Null for most listings."""
    family = _han_name(F.floor(key / (2 * FAMILY)).cast("string"), 6)
    return (F.when(key % FAMILY == 0, F.concat(family, F.when(key % 2 == 0, F.lit("咖啡")).otherwise(F.lit("饮品连锁"))))
            .when(key % PLACE == 0, F.concat(F.lit("北京大学"), _han_name(key.cast("string"), 3))))


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return part.select(
        key.alias("id"),
        F.coalesce(_han_shop(F.col("p_partkey")), F.concat(F.col("p_name"), F.lit(" ("), F.lower(F.col("p_type")), F.lit(" store)"))).alias("shop_name"),
        F.when(F.col("p_size") % 10 == 0, F.lit("NA"))
         .when(F.col("p_size") % 10 == 5, F.lit("null"))
         .when(F.col("p_partkey") % 7 == 3, F.replace("p_brand", F.lit("Brand"), F.lit("Brannd")))
         .otherwise(F.col("p_brand")).alias("shop_brand"),
        F.when(F.col("p_partkey") % 17 == 0, F.lit("yes")).otherwise(F.lit("N/A")).alias("laiyuan1_id"),
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("99998888"), key))
         .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("9999"), key))
         .otherwise(F.concat(F.lit("1"), key)).alias("brand_id"),
        F.col("p_brand").alias("brand_name"),
    )


def _han_sql(seed: str, length: int) -> str:
    return f"translate(left(md5(CAST({seed} AS VARCHAR)), {length}), '0123456789abcdef', '{HAN_DIGITS}')"


LISTINGS_RAW_SQL = f"""
SELECT CAST(p_partkey AS VARCHAR) AS id,
       CASE WHEN p_partkey % {FAMILY} = 0 THEN {_han_sql(f'p_partkey // {2 * FAMILY}', 6)} || CASE WHEN p_partkey % 2 = 0 THEN '咖啡' ELSE '饮品连锁' END
            WHEN p_partkey % {PLACE} = 0 THEN '北京大学' || {_han_sql('p_partkey', 3)}
            ELSE p_name || ' (' || lower(p_type) || ' store)' END AS shop_name,
       CASE WHEN p_size % 10 = 0 THEN 'NA' WHEN p_size % 10 = 5 THEN 'null'
            WHEN p_partkey % 7 = 3 THEN replace(p_brand, 'Brand', 'Brannd') ELSE p_brand END AS shop_brand,
       CASE WHEN p_partkey % 17 = 0 THEN 'yes' ELSE 'N/A' END AS laiyuan1_id,
       CASE WHEN p_partkey % 3 = 0 THEN '99998888' || CAST(p_partkey AS VARCHAR)
            WHEN p_partkey % 3 = 1 THEN '9999' || CAST(p_partkey AS VARCHAR)
            ELSE '1' || CAST(p_partkey AS VARCHAR) END AS brand_id,
       p_brand AS brand_name
FROM part
"""

# cleaned: NA-like words -> null -> empty string, on every string column
_NA_SQL = ("('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
           "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')")


def _clean_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} IN {_NA_SQL} THEN '' ELSE {c} END AS {c}"


LISTINGS_SQL = (
    "SELECT " + ", ".join(_clean_sql(c) for c in
                          ("id", "shop_name", "shop_brand", "laiyuan1_id", "brand_id", "brand_name"))
    + f" FROM ({LISTINGS_RAW_SQL}) raw"
)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexgrid.functions.clean import fill_missing, null_tokens
    return fill_missing(null_tokens(raw_listings(spark, sf_dir)))
