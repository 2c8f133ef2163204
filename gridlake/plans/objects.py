"""Object-key and name checks as queries over tables.

The path expressions and name rules are column functions, so they apply to
any column of keys or names: a bucket listing, or the URLs and names held in
the driver's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions import names as N
from gridlake.functions import paths as P
from gridlake.plans.racing import read_tpch
from gridlake.sources.listing import list_objects

URL_KEY_RE = r"^[a-z]+://[^/]*/?"
URL_HOST_RE = r"^[a-z]+://([^/?#]*)"


def key_parts(df: DataFrame, key: str = "key", target_format: str = "parquet", target_dir: str = "inputs/") -> DataFrame:
    """Add the path-derived columns of the conversion workflow to ``df``."""
    k = F.col(key)
    return df.select(
        "*",
        P.base_name(k).alias("file_name"),
        P.base_name(k, with_extension=False).alias("stem"),
        P.extension(k).alias("ext"),
        P.file_type(k).alias("file_type"),
        P.data_format(k).alias("read_format"),
        P.is_valid_format(k).alias("valid"),
        P.converted_key(k, target_format).alias("target_key"),
        P.converted_key(k, target_format, target_dir).alias("target_in_dir"),
    )


def page_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL's object key and what the conversion rules make of it."""
    pages = read_tpch(spark, sf_dir, "pages").select("page_id", "url")
    keyed = pages.select("page_id", F.regexp_replace("url", URL_KEY_RE, "").alias("key"))
    return key_parts(keyed)


def name_checks(df: DataFrame, name: str = "name") -> DataFrame:
    """Bucket-name verdict and failure count for a column of names."""
    fails = N.name_failures(name)
    return df.select(
        "*",
        N.name_verdict(name).alias("verdict"),
        F.when(F.col(name).isNotNull(), F.size(fails)).alias("n_failures"),
    )


def bucket_name_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name rules over page hosts, part names and nation names."""
    hosts = read_tpch(spark, sf_dir, "pages").select(
        F.lit("page_host").alias("source"),
        F.col("page_id").alias("id"),
        F.regexp_extract("url", URL_HOST_RE, 1).alias("name"),
    )
    parts = read_tpch(spark, sf_dir, "part").select(
        F.lit("part_name").alias("source"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )
    nations = read_tpch(spark, sf_dir, "nation").select(
        F.lit("nation_name").alias("source"),
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.lower(F.col("n_name")).alias("name"),
    )
    return name_checks(hosts.unionByName(parts).unionByName(nations))


def listing_report(spark: SparkSession, root: str, prefix: str | None = None, **kw) -> DataFrame:
    """A bucket listing with the conversion workflow's derived columns."""
    return key_parts(list_objects(spark, root, prefix=prefix), **kw)
