"""Every registered query of the engine: those that read, and those that write, stream and restart."""

from tillflow.plans.registry import QUERIES as READ_QUERIES
from tillflow.plans.write_queries import WRITE_QUERIES

QUERIES = {**READ_QUERIES, **WRITE_QUERIES}
