"""Field access with defaults.

P2 (blank text -> language 'unknown') needs no helper: blank text has no
letter, hence no trigram and no detection, and a missing detection becomes
the default here (see ``eddy.operators.language.detect_language``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_default(col: Column, default) -> Column:
    """``dict.get(k, default)``: null becomes the default."""
    return F.coalesce(col, F.lit(default))
