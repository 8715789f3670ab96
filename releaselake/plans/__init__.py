"""The registered queries."""

from . import stored, streams, surfaces, syncing  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
