"""Order analytics on Spark: raw text to staging, marts, features, models and reports.

The names below are the usual entry points; every operator behind them is a
function from DataFrame to DataFrame in ``plans``, ``operators`` and ``streaming``.
"""

from .plans.brief import brief_json as brief_payload
from .plans.marts import build_marts, fct_orders
from .plans.models import train_delay, train_forecast
from .plans.refresh import refresh_all
from .plans.registry import drift_score as drift_psi
from .plans.registry import promote as registry_update
from .plans.staging import build_staging
from .session import build_session, configure
from .sources.csv_tables import load_raw

__all__ = [
    "brief_payload",
    "build_marts",
    "build_session",
    "build_staging",
    "configure",
    "drift_psi",
    "fct_orders",
    "load_raw",
    "refresh_all",
    "registry_update",
    "train_delay",
    "train_forecast",
]
