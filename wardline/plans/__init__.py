"""The views (silver, gold, serving) and the query catalog built from them."""

from . import gold, serving, silver  # noqa: F401  (registers the views)
from .registry import VIEWS, Catalog, sql_view, topo_order, view  # noqa: F401
