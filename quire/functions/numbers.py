"""Numbers as readers see them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 4


def rounded(value: Column, digits: int = DIGITS) -> Column:
    """The nearest decimal of a double's exact binary value, ties to even. The built-in functions round the shortest
    decimal that stands for the double instead, which turns 1/160 to 0.0062 where the double lies above the middle."""

    @F.pandas_udf("double")
    def near(values: pd.Series) -> pd.Series:
        return values.map(lambda x: round(x, digits), na_action="ignore")

    return near(value.cast("double"))
