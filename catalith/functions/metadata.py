"""Metadata normalisation: raw values stay beside the cleaned ones."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from catalith.functions.html import inner_text
from catalith.functions.text import clean_text, fingerprint

# Python workers receive this module's functions by value, so a cluster needs no
# installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.pandas_udf(StringType())
def nfc(values: pd.Series) -> pd.Series:
    """Unicode NFC; Spark has no built-in for it, hence one Arrow-batched UDF."""
    return values.str.normalize("NFC")


def normalize_field(c: Column) -> Column:
    """Markup, control characters and whitespace cleaned; nothing is invented."""
    return clean_text(F.regexp_replace(inner_text(c), "\\p{Cntrl}", " "))


def normalize_metadata(df: DataFrame, title: str, description: str, keywords: str) -> DataFrame:
    """Add cleaned title, description and keyword list plus a content hash.

    A missing field stays missing.  The hash covers the cleaned values, so a
    re-collected row with the same content is recognised.
    """
    out = df
    for name, c in (("title_norm", title), ("description_norm", description), ("keywords_norm", keywords)):
        out = out.withColumn(name, F.nullif(normalize_field(nfc(F.col(c))), F.lit("")))
    words = F.filter(F.transform(F.split("keywords_norm", ","), lambda x: F.trim(x)), lambda x: x != "")
    out = out.withColumn("keyword_list", words)
    return out.withColumn("content_hash", fingerprint(
        title=F.col("title_norm"), description=F.col("description_norm"), keywords=F.col("keywords_norm")))
