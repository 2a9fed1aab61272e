"""All queries over the supplied tables. Importing the modules registers them."""

from . import derived, more, rules
from .catalog import REGISTRY, flagship

__all__ = ["REGISTRY", "derived", "flagship", "more", "rules"]
