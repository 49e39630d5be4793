"""Words of plain letters, digits and non-ASCII characters: one definition for
the operators that match words, in tasks and in Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsmith.llm.common import ship_by_value

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words stand between runs of these, after lower-casing A-Z.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Per byte of UTF-8: A-Z lower-cased, other ASCII that is no letter or digit a space.
FOLD = bytes(b | 0x20 if chr(b) in UPPER else b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256))


def folded(text: str | None) -> bytes:
    """The text's UTF-8 bytes, each at its place, folded."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD)


def words_of(text: Column) -> Column:
    """The same words as ``folded(text).split()``, in Spark; null has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lower, NOT_WORD, -1), "")


ship_by_value(__name__)
