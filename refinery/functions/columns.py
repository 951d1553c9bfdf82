"""Scalar column builders. All return ``Column`` objects built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column) -> Column:
    """String → timestamp; NULL for missing *or* malformed text.

    ``try_to_timestamp`` never raises, so the result does not depend on
    ``spark.sql.ansi.enabled`` (plain ``to_timestamp`` throws under ANSI).
    """
    return F.try_to_timestamp(_col(c))


def datekey(c: str | Column) -> Column:
    """Timestamp → integer yyyyMMdd date key; NULL stays NULL."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


# Longer than a packed digest.
_TEXT = bytearray(33)


def packed_digest(c: str | Column) -> Column:
    """A SHA-256 digest in hex as its 32 bytes, half of what it takes in a
    shuffle (hex does not compress there).  Any other text is kept behind 33
    zero bytes, so equal means equal; :func:`unpacked_digest` undoes it."""
    text = _col(c)
    return F.when(text.rlike("^[0-9a-f]{64}\\z"), F.unhex(text)).when(text.isNotNull(), F.concat(F.lit(_TEXT), text.cast("binary")))


def unpacked_digest(c: str | Column) -> Column:
    packed = _col(c)
    text = F.substring(packed, len(_TEXT) + 1, 2**31 - 1).cast("string")
    return F.when(F.octet_length(packed) == 32, F.lower(F.hex(packed))).otherwise(text)


def row_digest(columns: list[str]) -> Column:
    """SHA-256 over the text form of ``columns`` in the given order.

    Each value contributes ``<length>:<text>`` and a NULL contributes ``-``,
    so the encoding is injective: ("a", NULL) and (NULL, "a") differ, and no
    column's value can be shifted into its neighbour.  Text forms of
    timestamps follow the session time zone (pin it to UTC).
    """
    return digest_of([F.col(name) for name in columns])


def digest_of(values: list[Column]) -> Column:
    """:func:`row_digest` of columns given as such."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)
