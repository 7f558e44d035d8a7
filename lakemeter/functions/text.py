"""Text normalisation for labels and number-like strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: characters stripped from displayed numbers ("99,657", "$30.92", "-4,843")
NUMBER_NOISE = "[$,]"


def normalise_label(col) -> Column:
    """Upper-cased, trimmed label."""
    return F.upper(F.trim(F.col(col) if isinstance(col, str) else col))


def clean_number(col, target: str = "double") -> Column:
    """Displayed number -> numeric; NULL when it still does not parse."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.trim(c), NUMBER_NOISE, "").try_cast(target)
