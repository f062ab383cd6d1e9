"""Contract queries: one module per domain, all registered in ``registry``."""

from skyledger.plans import access, billing, catalog, nested, network, objects, streams, text, traffic  # noqa: F401
from skyledger.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
