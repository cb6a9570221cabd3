"""What the operators on conversations share: the identity of a turn, and the order of turns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGEST_BYTES = 16


def turn_digest(role: Column, text: Column) -> Column:
    """Sixteen bytes that are equal for equal (role, text) and, but for a chance of 2^-128 per pair, only for these."""
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def in_order(turn: str, role: str, digest: str) -> list[Column]:
    """Sort keys of turns: by number, null first; turns of one number by role, then by digest."""
    return [F.col(turn).asc_nulls_first(), F.col(role).asc(), F.col(digest).asc()]
