"""Name-based UUID version 5 (RFC 4122) as a native Spark expression.

uuid5(ns, name) = SHA-1(ns bytes || UTF-8 name), first 16 bytes, with the
version nibble set to 5 and the variant bits set to 10xx.  The result is
byte-for-byte what Python's `uuid.uuid5` returns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import UUID_NAMESPACE_DNS_HEX


def uuid5(name: Column, namespace_hex: str = UUID_NAMESPACE_DNS_HEX) -> Column:
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    # Variant: keep the low two bits of the 17th hex digit and set the top
    # bits to 10, i.e. map 0..15 -> '8','9','a','b' by value mod 4.
    variant_digit = F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4
    variant = F.substring(F.lit("89ab"), variant_digit + 1, 1)
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"),
        F.substring(h, 9, 4), F.lit("-5"),
        F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12),
    )


def uuid5_sql(name_sql: str, namespace_hex: str = UUID_NAMESPACE_DNS_HEX) -> str:
    """DuckDB SQL text of the same function (used by the oracle queries)."""
    h = f"sha1(unhex('{namespace_hex}') || encode({name_sql}))"
    return (
        f"substr({h},1,8)||'-'||substr({h},9,4)||'-5'||substr({h},14,3)||'-'||"
        f"substr('89ab', (('0x'||substr({h},17,1))::INTEGER % 4)+1, 1)||substr({h},18,3)||'-'||"
        f"substr({h},21,12)"
    )
