"""Delimited text sources: the product file and the rating file.

Product lines have 7 ``^``-separated fields (id, name, category ids, vendor id,
image url, categories, tags); fields 0, 1, 4, 5, 6 are kept and trimmed. The
file is read as plain text, never as quoted CSV, because names contain ``"``.
Rating lines are ``user,product,score,epoch_seconds``; further fields are
ignored. Fields are trimmed of every character up to the blank.

A malformed line fails the job by default. With ``mode="mark"`` every line is
kept, and a column ``malformed`` holds the text of the bad ones (their fields
are null), so that they can be counted and looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise import schemas


def _field(parts: Column, i: int) -> Column:
    # F.get is null past the end of the array instead of failing under ANSI.
    return F.regexp_replace(F.get(parts, i), "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")


def _checked(lines: DataFrame, value_col: str, fields: list[Column], valid: Column, mode: str,
             what: str) -> DataFrame:
    value = F.col(value_col)
    if mode == "mark":
        return lines.select(*fields, valid.alias("_ok"), value.alias("_line")).select(
            *[F.when(F.col("_ok"), F.col(c)).alias(c) for c in lines.select(*fields).columns],
            F.when(~F.col("_ok"), F.coalesce("_line", F.lit(""))).alias("malformed"))
    if mode != "fail":
        raise ValueError(f"unknown mode {mode!r}")
    failed = F.raise_error(F.concat(F.lit(f"malformed {what} line: "), F.coalesce(value, F.lit("null"))))
    return lines.filter(F.when(valid, F.lit(True)).otherwise(failed.cast("boolean"))).select(*fields)


def parse_product_lines(lines: DataFrame, value_col: str = "value", mode: str = "fail") -> DataFrame:
    """``value`` strings -> Product rows. A bad id or fewer than 7 fields make a line malformed."""
    parts = F.split(F.col(value_col), re.escape(schemas.PRODUCT_FIELD_SEPARATOR))
    product_id = _field(parts, 0).try_cast("int")
    fields = [
        product_id.alias("product_id"),
        _field(parts, 1).alias("product_name"),
        _field(parts, 4).alias("image_url"),
        _field(parts, 5).alias("categories"),
        _field(parts, 6).alias("tags"),
    ]
    valid = F.coalesce(product_id.isNotNull() & (F.size(parts) >= 7), F.lit(False))
    return _checked(lines, value_col, fields, valid, mode, "product")


def parse_rating_lines(lines: DataFrame, value_col: str = "value",
                       sep: str = schemas.RATING_FIELD_SEPARATOR, mode: str = "fail") -> DataFrame:
    """``value`` strings -> Rating rows. A field that is missing or no number makes a line malformed."""
    parts = F.split(F.col(value_col), re.escape(sep))
    types = {"user_id": "int", "product_id": "int", "score": "double", "time_stamp": "bigint"}
    values = {name: _field(parts, i).try_cast(kind) for i, (name, kind) in enumerate(types.items())}
    valid = F.lit(True)
    for v in values.values():
        valid = valid & v.isNotNull()
    return _checked(lines, value_col, [v.alias(name) for name, v in values.items()], valid, mode, "rating")


def read_products(spark: SparkSession, path: str, mode: str = "fail") -> DataFrame:
    return parse_product_lines(spark.read.text(path), mode=mode)


def read_ratings(spark: SparkSession, path: str, mode: str = "fail") -> DataFrame:
    return parse_rating_lines(spark.read.text(path), mode=mode)


def format_product_lines(products: DataFrame) -> DataFrame:
    """Product rows -> ``value`` lines in the 7-field product file format."""
    def s(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    return products.select(F.concat_ws(
        schemas.PRODUCT_FIELD_SEPARATOR,
        s("product_id"), s("product_name"), F.lit(""), F.lit(""),
        s("image_url"), s("categories"), s("tags")).alias("value"))


def format_rating_lines(ratings: DataFrame, sep: str = schemas.RATING_FIELD_SEPARATOR) -> DataFrame:
    """Rating rows -> ``value`` lines (rating file, or stream message with ``|``)."""
    return ratings.select(F.concat_ws(
        sep, *[F.col(c).cast("string") for c in ("user_id", "product_id", "score", "time_stamp")]
    ).alias("value"))
