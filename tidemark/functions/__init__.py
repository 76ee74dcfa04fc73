"""Column-level building blocks: the data-quality rule vocabulary."""

from .rules import (Rule, equals, has_type, in_range, in_set, not_blank, not_null, positive,
                    types_of, unique)

__all__ = ["Rule", "equals", "has_type", "in_range", "in_set", "not_blank", "not_null",
           "positive", "types_of", "unique"]
