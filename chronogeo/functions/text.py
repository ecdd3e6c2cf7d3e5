"""The few text functions that the JVM lacks, as Arrow-batched pandas UDFs."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_OTHER = re.compile("[^a-z0-9]+")


def slug_of(s: str) -> str:
    """Lower case, decomposed, other characters as hyphens (so an accent leaves one), at most 90 characters."""
    return _OTHER.sub("-", unicodedata.normalize("NFKD", s.lower())).strip("-")[:90]


def fold_of(s: str) -> str:
    """Lower case without diacritics."""
    return "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def slugify(s: pd.Series) -> pd.Series:
    return s.map(slug_of, na_action="ignore")


@F.pandas_udf(StringType())
def fold(s: pd.Series) -> pd.Series:
    return s.map(fold_of, na_action="ignore")
