"""A text fingerprint of a whole row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: these make the fingerprint, so they must not change
NULL_TEXT = "__NULL__"
SEPARATOR = "||"


def row_fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 of the columns as text, in the order given."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit(NULL_TEXT)) for name in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), 256)
