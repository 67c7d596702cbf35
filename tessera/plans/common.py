"""Small helpers shared by the query modules."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round (half-even) every double column (the oracles round the same columns)."""
    return df.select(*[F.bround(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])
