"""Lookup seeds: the city/region mapping and a CSV seed reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CITY_REGION_SCHEMA = T.StructType([
    T.StructField("raw_value_normalized", T.StringType(), False),
    T.StructField("mapped_city", T.StringType(), True),
    T.StructField("mapped_region", T.StringType(), True),
])

# A small mapping of our own (upper-case raw value -> city, region).  Blank
# region on MADINAH exercises the "blank mapped region" rule; SAUDI maps to
# nothing at all.
DEFAULT_CITY_REGION = [
    ("RIYADH", "Riyadh", "Riyadh Province"),
    ("JEDDAH", "Jeddah", "Makkah Al-Mukarramah Province"),
    ("AL KHOBAR", "Al Khobar", "Eastern Province"),
    ("MAKKAH", "Makkah", "Makkah Al-Mukarramah Province"),
    ("MECCA", "Makkah", "Makkah Al-Mukarramah Province"),
    ("DAMMAM", "Dammam", "Eastern Province"),
    ("SAUDI", None, None),
    ("EASTERN PROVINCE", None, "Eastern Province"),
    ("MADINAH", "Madinah", " "),
    ("ABHA", "Abha", "Aseer Province"),
]


def city_region_seed(spark: SparkSession, rows=None) -> DataFrame:
    """The mapping as a DataFrame (a local relation of known size)."""
    return spark.createDataFrame(rows if rows is not None else DEFAULT_CITY_REGION, CITY_REGION_SCHEMA)


def city_region_values_sql(rows=None) -> str:
    """The same rows as a SQL ``VALUES`` list (for the oracle)."""
    def lit(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in (rows or DEFAULT_CITY_REGION))
    return f"(SELECT * FROM (VALUES {body}) AS m(raw_value_normalized, mapped_city, mapped_region))"


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              key: str | None = None) -> DataFrame:
    """Read a CSV seed: header row, UTF-8 with or without BOM, empty -> null.

    With ``key`` given the key is checked for uniqueness first, since a
    repeated key would multiply rows in every lookup join.
    """
    reader = (
        spark.read.option("header", True).option("encoding", "UTF-8")
        .option("multiLine", True).option("escape", '"')
        .option("nullValue", "").option("emptyValue", None)
    )
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    # A BOM left in the first header name is removed.
    first = df.columns[0]
    if first.startswith("﻿"):
        df = df.withColumnRenamed(first, first.lstrip("﻿"))
    if key is not None:
        dup = df.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"seed key {key!r} is not unique: {dup[0][key]!r}")
    return df
