"""All registered queries."""

from tierworks.plans import control, erp, movement, sensors  # noqa: F401 - registers its queries
from tierworks.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
