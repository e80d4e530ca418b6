"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text the dbt-utils package puts in place of a null key part.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 over the parts as text joined by ``-``, null parts kept apart from empty ones."""
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    texts = [F.coalesce(column.cast("string"), F.lit(NULL_PART)) for column in columns]
    return F.md5(F.concat_ws("-", *texts))


def joined_md5(*parts: Column | str) -> Column:
    """MD5 over the parts as text with nothing between them; null parts are skipped."""
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    return F.md5(F.concat_ws("", *[column.cast("string") for column in columns]))
