"""All registered queries: importing the modules registers them."""

from flatspan.plans import q_clean, q_evaluate, q_facts, q_features, q_flatten, q_jobs, q_profile, q_split, q_tables, q_train  # noqa: F401
from flatspan.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
