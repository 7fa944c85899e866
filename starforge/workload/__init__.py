"""One runnable query per operator, over the driver tables."""

from . import (  # noqa: F401  (importing registers the queries)
    columns,
    groups,
    joining,
    loads,
    reading,
    reports,
    stars,
    streams,
)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
