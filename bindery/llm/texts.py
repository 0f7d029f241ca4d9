"""Words and checksums of texts, as columns and as SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The six separators of words: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\f\r"

#: The same as a SQL pattern of words.
WORD_SQL = r"[^\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null. Java's ``\\s`` is those six."""
    return F.array_remove(F.split(whole(text), r"\s+"), "")


def remainder(id_: Column, modulus: int) -> Column:
    """CRC-32 of an ID's decimal text, modulo a number; that of '' for null."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % modulus


def remainder_of(id_, modulus: int) -> int:
    """``remainder`` of a Python value."""
    return zlib.crc32(b"" if id_ is None else str(id_).encode()) % modulus


# One row: the 256 remainders of CRC-32, made by its rule.
CRC_TABLE_SQL = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
    n::BIGINT)) AS t)"""


def crc32_sql(text: str) -> str:
    """SQL of the CRC-32 of a text's bytes; needs ``crc_table`` in scope."""
    hex_ = f"hex(encode({text}))"
    bytes_ = (
        f"list_transform(range(0, length({hex_}), 2), "
        f"lambda i: ('0x' || substr({hex_}, i + 1, 2))::BIGINT)"
    )
    return (
        f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), "
        "4294967295::BIGINT), 4294967295)"
    )
