"""Import every query module so the registry is complete."""

from adherence.plans import registry  # noqa: F401
from adherence.plans import q_quality  # noqa: F401
from adherence.plans import q_energy  # noqa: F401
from adherence.plans import q_match  # noqa: F401
from adherence.plans import q_rollup  # noqa: F401
from adherence.plans import q_stream  # noqa: F401
from adherence.plans.registry import ORACLE, QUERIES  # noqa: F401
