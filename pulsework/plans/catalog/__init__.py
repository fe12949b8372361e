"""All registered queries, each next to the plain SQL that gives the same rows."""

from pulsework.plans.catalog import incremental, landing, nested, relational, streams, variants  # noqa: F401
from pulsework.plans.catalog.registry import ORACLES, QUERIES  # noqa: F401
