"""Code lists: text files of code and label pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.functions.values import strip
from starlog.operators.windows import number_rows
from starlog.sources.files import ARRIVAL, with_arrival_order

# Line form of the port list (fixed value).
PORT_LINE = r"'(.*)'\s=\s'(.*)'"

# Valid address codes with their names (fixed values).
ADDRESS_CODES = {
    "AL": "ALABAMA",
    "AK": "ALASKA",
    "AZ": "ARIZONA",
    "AR": "ARKANSAS",
    "CA": "CALIFORNIA",
    "CO": "COLORADO",
    "CT": "CONNECTICUT",
    "DE": "DELAWARE",
    "DC": "DIST. OF COLUMBIA",
    "FL": "FLORIDA",
    "GA": "GEORGIA",
    "GU": "GUAM",
    "HI": "HAWAII",
    "ID": "IDAHO",
    "IL": "ILLINOIS",
    "IN": "INDIANA",
    "IA": "IOWA",
    "KS": "KANSAS",
    "KY": "KENTUCKY",
    "LA": "LOUISIANA",
    "ME": "MAINE",
    "MD": "MARYLAND",
    "MA": "MASSACHUSETTS",
    "MI": "MICHIGAN",
    "MN": "MINNESOTA",
    "MS": "MISSISSIPPI",
    "MO": "MISSOURI",
    "MT": "MONTANA",
    "NC": "N. CAROLINA",
    "ND": "N. DAKOTA",
    "NE": "NEBRASKA",
    "NV": "NEVADA",
    "NH": "NEW HAMPSHIRE",
    "NJ": "NEW JERSEY",
    "NM": "NEW MEXICO",
    "NY": "NEW YORK",
    "OH": "OHIO",
    "OK": "OKLAHOMA",
    "OR": "OREGON",
    "PA": "PENNSYLVANIA",
    "PR": "PUERTO RICO",
    "RI": "RHODE ISLAND",
    "SC": "S. CAROLINA",
    "SD": "S. DAKOTA",
    "TN": "TENNESSEE",
    "TX": "TEXAS",
    "UT": "UTAH",
    "VT": "VERMONT",
    "VI": "VIRGIN ISLANDS",
    "VA": "VIRGINIA",
    "WV": "W. VIRGINIA",
    "WA": "WASHINGTON",
    "WI": "WISCONSON",
    "WY": "WYOMING",
    "99": "All Other Codes",
}


def address_codes(spark: SparkSession) -> DataFrame:
    """The address code list as (ordinal, code, label)."""
    rows = [(i, code, label) for i, (code, label) in enumerate(ADDRESS_CODES.items())]
    return spark.createDataFrame(rows, "ordinal bigint, code string, label string")


def parse_codes(lines: DataFrame, pattern: str, order: list[str], value: str = "value") -> DataFrame:
    """(ordinal, code, label) of the lines that match, in the given line order.

    A code listed twice keeps its first place and its last label. Lines that do not match,
    such as those with other spacing around the sign, are left out.
    """
    text = F.col(value)
    found = lines.where(F.regexp_like(text, F.lit(pattern))).select(
        F.regexp_extract(text, pattern, 1).alias("code"),
        strip(F.regexp_extract(text, pattern, 2)).alias("label"),
        F.struct(*order).alias("_at"),
    )
    merged = found.groupBy("code").agg(F.min("_at").alias("_at"), F.max_by("label", "_at").alias("label"))
    return number_rows(merged, ["_at"], "ordinal", start=0).select("ordinal", "code", "label")


def read_codes(spark: SparkSession, path: str, pattern: str = PORT_LINE) -> DataFrame:
    """A code list file as (ordinal, code, label)."""
    return parse_codes(with_arrival_order(spark.read.text(path)), pattern, ARRIVAL)
