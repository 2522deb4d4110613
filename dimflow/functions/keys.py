"""Hash keys over business columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def _c(col: Col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def surrogate_key(*cols: Col) -> Column:
    """md5 of the text forms joined by '-', with null taken as ''.

    Keep raw doubles out: their text form differs between engines. Cast them to
    a decimal first.
    """
    if all(isinstance(c, str) and c.isidentifier() for c in cols):
        # Same expression in one step; a key over many columns is built much faster so.
        texts = ", ".join(f"coalesce(cast(`{c}` as string), '')" for c in cols)
        return F.expr(f"md5(concat_ws('-', {texts}))")
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def row_hash(*cols: Col) -> Column:
    """Change-detection hash over the tracked columns of a row."""
    return surrogate_key(*cols)


def packed(col: Col) -> Column:
    """Text as bytes, of which a hash of 32 lower-case hex digits takes 16; equal just where the texts are.

    For hash keys that are carried through shuffles. Any other text has a byte in front, or
    two where one would make it 16 bytes long.
    """
    c = _c(col)
    raw, plain = F.unhex(c), c.cast("binary")
    front = F.when(F.octet_length(c) == 15, F.lit(b"\x01\x00")).otherwise(F.lit(b"\x00"))
    return F.when((F.octet_length(c) == 32) & (F.lower(F.hex(raw)) == c), raw).otherwise(F.concat(front, plain))


def unpacked(col: Col) -> Column:
    """The text that ``packed`` was given."""
    c = _c(col)
    start = F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lit(3)).otherwise(F.lit(2))
    plain = F.substring(c, start, F.octet_length(c)).cast("string")
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(plain)
