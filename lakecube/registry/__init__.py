"""All registered queries.  Importing a module registers its queries."""

from . import (q_clean, q_climate, q_grid, q_io, q_kernel, q_normalize, q_placement,  # noqa: F401
               q_quality, q_scoring, q_tasks)
from .base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
