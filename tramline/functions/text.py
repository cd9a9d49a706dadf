"""Text expressions: snapshot stamps, point text, missing-value marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The stamp format in export names, and the field texts a
# CSV reader with default settings takes for "missing".
STAMP_PATTERN = "([0-9]{8}_[0-9]{6})"
STAMP_FORMAT = "yyyyMMdd_HHmmss"
MISSING_MARKS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def snapshot_time(path: Column) -> Column:
    """Time in the last file or folder name of a path that holds a stamp, else NULL.

    Of several stamps in one name the first counts.
    """
    found = F.regexp_extract(path, f"{STAMP_PATTERN}[^/]*(?:/(?![^/]*{STAMP_PATTERN})[^/]*)*$", 1)
    return F.try_to_timestamp(found, F.lit(STAMP_FORMAT)).cast("timestamp_ntz")


def plain_number(value: Column) -> Column:
    """Shortest decimal text of a double, without exponent or trailing zeros."""
    number = value.cast("double")
    digits = F.regexp_replace(F.format_string("%.18f", number), r"\.?0+$", "")
    return F.when(number == 0.0, "0").when(number.isNotNull(), digits)


def wkt_point(lon: Column, lat: Column) -> Column:
    """'POINT (lon lat)' in EPSG:4326 axis order; NULL when either is missing."""
    return F.concat(F.lit("POINT ("), plain_number(lon), F.lit(" "), plain_number(lat), F.lit(")"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def missing_to_null(df: DataFrame) -> DataFrame:
    """Turn the missing-value marks into NULL in every text column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.when(~F.col(f"`{c}`").isin(*MISSING_MARKS), F.col(f"`{c}`")) for c in text}
    )
