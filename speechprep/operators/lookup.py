"""Looking rows up in a table with one row per key, when one key may be hot.

A plain hash join sends all rows of a key to one task. Here rows are salted by
their own identity and the looked-up table, which is small (one row per key), is
repeated once per salt, so the rows of one key meet it in ``SALTS`` places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    by: list[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` to ``table`` on ``key``. ``by`` names columns that tell rows
    of one key apart; ``how`` is ``inner``, ``left`` or ``left_anti``. Fewer salts
    suit tables about as large as the rows."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
