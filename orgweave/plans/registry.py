"""All queries of the library and their oracle SQL."""

from . import domain, expressions, files, records, relations  # noqa: F401  they register themselves
from .base import QUERIES, SQL

FLAGSHIP = "partner_link_exact"

__all__ = ["FLAGSHIP", "QUERIES", "SQL"]
