"""Keys derived from text: 64-bit hash, name-based UUID, canonical digest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespace of RFC 4122 for DNS names, and the canonical form of an id.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"
UUID_PATTERN = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def hash64(text: Column) -> Column:
    """First 16 hex digits of the md5 as an unsigned number."""
    return F.conv(F.substring(F.md5(text), 1, 16), 16, 10).cast("decimal(20,0)")


def uuid5_dns(name: Column) -> Column:
    """Version-5 UUID of a name in the DNS namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(name, "utf-8")))
    # The variant nibble keeps its two low bits and becomes one of 8, 9, a, b.
    low_bits = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.substring(F.lit("89ab"), low_bits + 1, F.lit(1)), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def batch_file_id(url: Column) -> Column:
    """Id of a staged file, from its address."""
    return uuid5_dns(url)


def event_file_id(resource_id: Column, version_id: Column) -> Column:
    """Id of a single-resource file, from resource id and version."""
    return uuid5_dns(F.concat(resource_id, version_id.cast("string")))


def is_uuid(text: Column) -> Column:
    return F.coalesce(text.rlike(UUID_PATTERN), F.lit(False))


def row_digest(json_text: Column) -> Column:
    """SHA-256 of the JSON value with sorted keys, so key order does not matter."""
    return F.sha2(F.to_json(F.try_parse_json(json_text)), 256)
