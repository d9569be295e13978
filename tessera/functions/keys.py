"""Keys derived from contents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the public namespace of object identifiers for name-based UUIDs.
NAMESPACE_OID = "6ba7b8129dad11d180b400c04fd430c8"


def short_md5(*parts: Column, length: int = 16) -> Column:
    """The first digits of the MD5 of the parts joined by |; null counts as empty."""
    return F.substring(F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, length)


def uuid5(seed: Column, namespace: str = NAMESPACE_OID) -> Column:
    """The name-based UUID (version 5) of a string."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(seed, "UTF-8")))
    byte = F.conv(F.substring(h, 17, 2), 16, 10).cast("int")
    variant = F.lower(F.hex(byte.bitwiseAND(0x3F).bitwiseOR(0x80)))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12),
    )
