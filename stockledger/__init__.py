"""Stock ledger and retail KPIs on Spark DataFrames.

Subpackages: ``sources`` (readers, writers, input adapter), ``functions``
(column expressions), ``operators`` (ledger, KPIs, unpriced branch,
validation), ``plans`` (the batch job, the query catalog and its oracles).
"""

from .config import ADAPTER_PERIOD, RETAIL_PERIOD, Period, build_session

__all__ = ["ADAPTER_PERIOD", "RETAIL_PERIOD", "Period", "build_session"]
