"""Query catalogue: each plan module registers its queries on import."""

from sightline.plans import boxes_q, crowd_q, events_q, frames_q, identity_q, messages_q, scoring_q  # noqa: F401
from sightline.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
