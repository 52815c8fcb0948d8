"""All named queries."""

from odsflow.registry import dashboards, marts, reports, storage  # noqa: F401
from odsflow.registry.base import QUERIES

__all__ = ["QUERIES"]
