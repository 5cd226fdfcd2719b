"""Bronze: a raw feed as it came, plus audit columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import LOAD_DATE


def add_audit(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Adds uuid, process_id (the load day as a number) and load_date.

    ``uuid()`` is drawn again whenever the plan is evaluated; values are settled once written.
    """
    return (
        df.withColumn("uuid", F.expr("uuid()"))
        .withColumn("process_id", F.date_format(F.lit(as_of), "yyyyMMdd").cast("long"))
        .withColumn(LOAD_DATE, F.lit(as_of))
    )
