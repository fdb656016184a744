"""Keys: stable shards, file names from URLs and positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes that a downloaded image may keep; any other becomes the default.
SUFFIXES = ("jpg", "jpeg", "png", "webp", "gif", "bmp", "tiff")
DEFAULT_SUFFIX = ".jpg"


def md5_shard(key: Column, shards: int) -> Column:
    """The 128-bit md5 of the key modulo shards, folded over four 32-bit parts to stay within a long."""
    if not 1 <= shards < 1 << 31:
        raise ValueError("shards must be from 1 to 2**31 - 1")
    digest, acc = F.md5(key.cast("binary")), F.lit(0).cast("long")
    for part in range(4):
        chunk = F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("long")
        acc = (acc * (1 << 32) + chunk) % shards
    return acc


def url_suffix(url: Column) -> Column:
    """The lower-cased image suffix of the URL's last path part, without its query."""
    pattern = r"(?i)[^/](\.(?:" + "|".join(SUFFIXES) + r"))(?:/+\.?)*$"
    found = F.lower(F.regexp_extract(F.substring_index(url, "?", 1), pattern, 1))
    return F.when(found == "", DEFAULT_SUFFIX).otherwise(found)


def file_name(index: Column, url: Column) -> Column:
    """Six digits or more, then the suffix."""
    return F.concat(F.format_string("%06d", index), url_suffix(url))
