"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for a null key part, so that null and absent parts hash apart.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str) -> Column:
    """md5 over the key parts joined by a dash; null parts take the marker above."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY_PART)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def version_id(key: str, updated_at: Column) -> Column:
    """md5 identifying one version of one key."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")),
                             updated_at.cast("string")))
