"""Imports every query module, which fills the registry."""

from finecast.plans import (  # noqa: F401
    q_aggs, q_clean, q_ingest, q_joins, q_serving, q_streams, q_training, q_windows,
)
from finecast.plans.registry import ORACLES, QUERIES  # noqa: F401
