from . import aggregates, calendar, constraints, joins, keys, load, projection, quality, ranking, sketches

__all__ = [
    "aggregates",
    "calendar",
    "constraints",
    "joins",
    "keys",
    "load",
    "projection",
    "quality",
    "ranking",
    "sketches",
]
