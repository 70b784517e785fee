"""Hashed surrogate keys.

The key is the MD5 hex digest of the fields' string forms joined with a
separator, with a fixed token standing in for NULL, so a NULL input still
yields a (non-null) key.  Restrict inputs to strings, integers and dates: their
string forms are the same in every engine; doubles and timestamps are not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's so keys are bit-identical):
#   separator between fields:  ||
#   token for a NULL field:    ^missing^
KEY_SEPARATOR = "||"
MISSING_TOKEN = "^missing^"


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(MISSING_TOKEN))
             for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
