"""Every operator as a query on the driver tables, with the SQL it must agree with."""

from checks import (  # noqa: F401  (importing registers the queries)
    aligning,
    checking,
    cleaning,
    filling,
    portfolios,
    reading,
    writing,
)
from checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
