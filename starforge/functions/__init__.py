from . import dates, predicates, text
from .sql import register_functions

__all__ = ["dates", "predicates", "text", "register_functions"]
