"""Query tags: comma-separated pairs of a key and a value; ``controls.REQUIRED_TAG_KEYS`` names the keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_tagged(tag: Column) -> Column:
    """NULL and empty tags both count as untagged."""
    return F.coalesce(tag != "", F.lit(False))


def tag_value(tag: Column, key: str) -> Column:
    """Value of ``key`` in the tag, NULL when missing or empty.

    A repeated key yields its first value; a map built from the tag would fail
    the whole job on one such tag.
    """
    pattern = rf"(?:^|,)\s*{re.escape(key)}\s*=\s*([^,]*)"
    return F.nullif(F.trim(F.regexp_extract(tag, pattern, 1)), F.lit(""))
