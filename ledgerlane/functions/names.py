"""Column references that survive spaces, dots and backticks in names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    return F.col(quoted(name))
