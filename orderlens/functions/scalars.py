"""Scalar expressions shared by the models."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: names accepted for schemas and tables in exports.
IDENTIFIER = r"^[a-zA-Z0-9_]+$"


def is_active(op: str) -> Column:
    """Soft-delete flag: false only for a delete."""
    return F.when(F.col(op) == "d", False).otherwise(True)


def known_true(flag: str) -> Column:
    """Null counts as false."""
    return F.coalesce(F.col(flag), F.lit(False))


def latest_of(*times: str) -> Column:
    """Latest of several times where a missing one counts as the epoch."""
    epoch = F.timestamp_micros(F.lit(0).cast("long"))
    known = [F.coalesce(F.col(t), epoch) for t in times]
    return known[0] if len(known) == 1 else F.greatest(*known)


def text_to_bool(c: str) -> Column:
    """``True``/``False`` as text or boolean; anything else is null."""
    s = F.col(c).cast("string")
    return F.when(s.isin("True", "true"), True).when(s.isin("False", "false"), False)


def contains_word(c: str, word: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(F.col(c)).contains(word.lower())


def number_or_null(c: str, type_name: str = "bigint") -> Column:
    """Numeric cast where a bad value becomes null."""
    return F.expr(f"try_cast(`{c}` as {type_name})")


def cyclic(c: str, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value on a cycle."""
    angle = F.lit(2 * math.pi) * F.col(c) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def version_id(*parts: Column) -> Column:
    """32-character surrogate key of a business key and its validity start."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def packed_id(c: str) -> Column:
    """A text id in bytes: 16 if it is 32 lower-case hex digits, else its own behind 17 zeros; no two ids pack alike."""
    packed = F.unhex(F.col(c))
    is_hex = (F.length(c) == 32) & F.lower(F.hex(packed)).eqNullSafe(F.col(c))
    return F.when(is_hex, packed).otherwise(F.concat(F.lit(bytes(17)), F.col(c).cast("binary")))


def unpacked_id(c: str) -> Column:
    """The text id that was packed."""
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(F.expr(f"cast(substring(`{c}`, 18) as string)"))


def valid_identifier(name: str) -> bool:
    return re.match(IDENTIFIER, name) is not None
