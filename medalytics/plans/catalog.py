"""All registered queries and their oracles."""

from . import bronze, gold, monitor, silver  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
