from . import catalog, dictionary, immigration, query_tables, songplay, staged_load

__all__ = ["catalog", "dictionary", "immigration", "query_tables", "songplay", "staged_load"]
