"""Names and paths taken out of URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quiltmap.functions.grid import col

# Patterns and path formats.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^?#]*)"
LAST_EXTENSION = r"(^|/)(\.*[^/.][^/]*)\.[^/.]*$"
REMOTE_PREFIX = "/vsicurl/"
BUCKET_HOST = ".s3.amazonaws.com"


def scheme(uri: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(uri), SCHEME, 1))


def authority(uri: Column | str) -> Column:
    return F.regexp_extract(col(uri), AUTHORITY, 1)


def uri_path(uri: Column | str) -> Column:
    return F.regexp_extract(col(uri), PATH, 1)


def uri_name(uri: Column | str) -> Column:
    """Host and path, without scheme, query, fragment and file extension."""
    host, rest = authority(uri), F.substring(uri_path(uri), 2, 1 << 30)
    whole = F.when(host == "", rest).otherwise(F.concat(host, F.lit("/"), rest))
    return F.regexp_replace(whole, LAST_EXTENSION, "$1$2")


def base_name(path: Column | str) -> Column:
    return F.regexp_extract(col(path), r"([^/]*)$", 1)


def piece_name(uri: Column | str, piece_row, piece_col) -> Column:
    """Where one window of an image is kept: <name>/<basename>_<row>_<col>."""
    name = uri_name(uri)
    return F.concat(
        name, F.lit("/"), base_name(name), F.lit("_"), col(piece_row).cast("string"), F.lit("_"), col(piece_col).cast("string")
    )


def remote_read_path(uri: Column | str) -> Column:
    """A path the raster reader can open over the network; other schemes fail."""
    kind = scheme(uri)
    return (
        F.when(kind == "", col(uri))
        .when(kind == "s3", F.concat(F.lit(REMOTE_PREFIX + "http://"), authority(uri), F.lit(BUCKET_HOST), uri_path(uri)))
        .when(kind.startswith("http"), F.concat(F.lit(REMOTE_PREFIX), col(uri)))
        .otherwise(F.raise_error(F.concat(F.lit("Unsupported scheme: "), kind)).cast("string"))
    )
