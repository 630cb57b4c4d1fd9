"""Answers of the open-data portal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.functions.clocks import portal_timestamp
from headway.schemas import PORTAL_RESPONSE


def resource_id(url: Column) -> Column:
    """Last part of a resource address."""
    return F.element_at(F.split(url, "/"), -1)


def dataset_metadata(responses: DataFrame, naive_zone: str = "UTC") -> DataFrame:
    """One row per accepted response; refused ones (``success`` not true) are left out."""
    r = F.col("result")
    return (responses.where("success")
            .select(r["id"].alias("resource_id"), r["name"].alias("name"),
                    portal_timestamp(r["last_modified"], naive_zone).alias("last_modified"),
                    r["format"].alias("format"), r["url"].alias("url"),
                    resource_id(r["url"]).alias("url_resource"),
                    r["package_id"].alias("package_id"),
                    F.coalesce(r["datastore_active"], F.lit(False)).alias("datastore_active")))


def scan_dataset_metadata(spark: SparkSession, path: str, naive_zone: str = "UTC") -> DataFrame:
    return dataset_metadata(spark.read.schema(PORTAL_RESPONSE).json(path), naive_zone)
