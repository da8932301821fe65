"""Download manifest of a table of URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sealframe.functions.text import cell

# The error codes of the manifest.
NOT_HTTPS = "not_https"
NO_FILE_NAME = "no_file_name"


def file_name(url: Column) -> Column:
    """Last segment of the URL's path, every character outside [A-Za-z0-9._-] replaced by _."""
    clean = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    path = F.regexp_extract(clean, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    # Parameters start at the first semicolon of the last segment.
    segment = F.regexp_extract(F.regexp_replace(path, r";[^/]*$", ""), r"[^/]*$", 0)
    return F.regexp_replace(segment, r"[^A-Za-z0-9._-]", "_")


def url_manifest(df: DataFrame, url: str = "url") -> DataFrame:
    """Per URL: whether it may be fetched, the file it would be stored as, else the reason. A null URL
    may not be fetched and has no name."""
    address = cell(url)
    name = file_name(address)
    https = F.coalesce(F.startswith(F.lower(address), F.lit("https://")), F.lit(False))
    return df.select(
        address.alias("url"),
        https.alias("is_https"),
        name.alias("file_name"),
        F.when(~https, NOT_HTTPS).when(name == "", NO_FILE_NAME).alias("error"),
    )
