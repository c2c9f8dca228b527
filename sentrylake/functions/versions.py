"""Versions as texts that sort: numbers by value, letters below the end of a version, so that 1.0rc1 < 1.0 < 1.0.1 < 1.10."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def version_key(version: Column) -> Column:
    """A text that sorts as the version does; null for null, for no version (-), any version (*) and texts without letters and digits.

    Parts are runs of digits and of letters A to Z, whatever their case; anything else only parts them. A number becomes N, its digits' count and its digits without
    leading zeros, letters become A with the letters and a blank, and M ends the version. Zeros at the end, or before letters, say nothing: 1.0 = 1.
    """
    parts = F.regexp_extract_all(F.lower(version), F.lit("([0-9]+|[a-z]+)"), F.lit(1))

    def spelled(part: Column) -> Column:
        digits = F.regexp_replace(part, "^0+(?=.)", "")
        return F.when(part.rlike("^[0-9]"), F.concat(F.lit("N"), F.lpad(F.length(digits).cast("string"), 3, "0"), digits)).otherwise(F.concat(F.lit("A"), part, F.lit(" ")))

    key = F.regexp_replace(F.concat(F.array_join(F.transform(parts, spelled), ""), F.lit("M")), "(?:N0010)+([AM])", "$1")
    return F.when(F.size(parts) > 0, key)
