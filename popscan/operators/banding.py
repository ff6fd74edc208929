"""Values relative to their reference range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.operators.counts import COUNT

# fixed values: band names
BELOW, WITHIN, ABOVE, OTHER = "Below Range Low", "Within Range", "Above Range High", "Other"


def relative_to_range(
    df: DataFrame, concept: str, unit: str, value: str = "value_as_number", low: str = "range_low", high: str = "range_high"
) -> DataFrame:
    """Records per concept, unit and band; needs value, unit and both limits."""
    v, lo, hi = F.col(value), F.col(low), F.col(high)
    band = (
        F.when(v < lo, BELOW).when((v >= lo) & (v <= hi), WITHIN).when(v > hi, ABOVE).otherwise(OTHER)
    )
    complete = df.filter(v.isNotNull() & F.col(unit).isNotNull() & lo.isNotNull() & hi.isNotNull())
    return complete.groupBy(concept, unit, band.alias("band")).agg(F.count("person_id").alias(COUNT))
