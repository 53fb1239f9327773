"""The registered queries; importing this package fills the catalogue."""

from sluice.plans import files, formats, grouping, naming, objects  # noqa: F401
from sluice.plans.catalogue import QUERIES

__all__ = ["QUERIES"]
