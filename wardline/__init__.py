"""wardline: layered analytics tables (bronze -> silver -> gold -> serving) on Spark.

Main entry points::

    from wardline import build_session, Catalog, run_pipeline, refresh_incremental
    from wardline import view, sql_view, Check
    from wardline.functions import clean, keys
    from wardline.operators import feeds, incremental, quality, dedup
"""

__version__ = "0.1.0"

from .operators.quality import Check, apply_checks, split_by_checks, violation_counts  # noqa: E402,F401
from .plans import VIEWS, Catalog, sql_view, view  # noqa: E402,F401
from .plans.pipeline import run_pipeline  # noqa: E402,F401
from .plans.refresh import refresh_incremental  # noqa: E402,F401
from .session import build_session  # noqa: E402,F401
