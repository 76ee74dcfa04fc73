"""Data-quality rule vocabulary.

A rule is a value: kind, columns, parameters. Row rules turn into a boolean
*violation* ``Column`` (Spark three-valued logic: a NULL predicate does not
count, so value rules never count NULL cells); ``unique`` is evaluated by a
group-by and ``type`` on the driver from the schema alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report texts, blank strings and gate titles that must read
# exactly as the reference pipeline's.
MESSAGES = {
    "type": "Wrong data type for {column}: expected {expected}, found {actual}",
    "not_null": "{column} contains {n} NULL values",
    "unique": "Found {n} duplicate {column} values",
    "unique_composite": "Found {n} duplicate {column} combinations",
    "range": "Found {n} invalid {column} values",
    "positive": "Found {n} invalid {column} values",
    "in_set": "Found {n} invalid {column} values",
    "equals": "Found {n} rows where {column} is not '{value}'",
    "not_blank": "Found {n} empty {column} values",
}
COMPOSITE_KEY_JOINER = " + "
BLANK_VALUES = ("", " ")
GATE_FAILED = "{title} DATA QUALITY CHECK FAILED:"
GATE_FAILED_INCREMENTAL = "{title} INCREMENTAL DATA QUALITY CHECK FAILED:"

ROW_KINDS = ("not_null", "range", "positive", "in_set", "equals", "not_blank")


@dataclass(frozen=True)
class Rule:
    kind: str
    columns: tuple[str, ...]
    expected: str | None = None      # dtype string, for kind == "type"
    params: tuple = ()

    @property
    def column(self) -> str:
        """Column label used in reports (composite keys joined by ``,``)."""
        return ",".join(self.columns)

    def template(self) -> str:
        """The report text with ``{n}`` (and for type rules ``{actual}``) open."""
        if self.kind == "unique" and len(self.columns) > 1:
            label = COMPOSITE_KEY_JOINER.join(self.columns)
            return MESSAGES["unique_composite"].replace("{column}", label)
        text = MESSAGES[self.kind].replace("{column}", self.columns[0])
        if self.kind == "type":
            text = text.replace("{expected}", str(self.expected))
        if self.kind == "equals":
            text = text.replace("{value}", str(self.params[0]))
        return text

    def message(self, n: int | None = None, actual: str | None = None) -> str:
        text = self.template()
        if self.kind == "type":
            return text.replace("{actual}", str(actual))
        return text.replace("{n}", str(n))

    def predicate_sql(self, value: Callable[[str], str] | None = None) -> str:
        """Spark SQL predicate that is TRUE for a violating row.

        ``value(name)`` yields the SQL of the column, already ``try_cast`` to the
        type the rule set demands when the frame holds another type.
        """
        value = value or quote
        if self.kind == "not_null":
            return f"{quote(self.columns[0])} IS NULL"   # the raw cell, never the cast one
        c = value(self.columns[0])
        if self.kind == "range":
            lo, hi = self.params
            return f"({c} < {sql_literal(lo)} OR {c} > {sql_literal(hi)})"
        if self.kind == "positive":
            return f"{c} <= 0"
        if self.kind == "in_set":
            return f"NOT ({c} IN ({', '.join(sql_literal(v) for v in self.params)}))"
        if self.kind == "equals":
            return f"{c} != {sql_literal(self.params[0])}"
        if self.kind == "not_blank":
            return f"{c} IN ({', '.join(sql_literal(v) for v in BLANK_VALUES)})"
        raise ValueError(f"rule kind {self.kind!r} has no row predicate")

    def violation(self, value: Callable[[str], str] | None = None) -> Column:
        """The predicate as a ``Column``."""
        return F.expr(self.predicate_sql(value))


def quote(name: str) -> str:
    """Backtick-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(v) -> str:
    """Spark SQL literal for a Python scalar (strings backslash-escaped)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def has_type(column: str, expected: str) -> Rule:
    return Rule("type", (column,), expected=expected)


def not_null(column: str) -> Rule:
    return Rule("not_null", (column,))


def unique(*columns: str) -> Rule:
    return Rule("unique", tuple(columns))


def in_range(column: str, lo, hi) -> Rule:
    """Closed range ``lo <= c <= hi``."""
    return Rule("range", (column,), params=(lo, hi))


def positive(column: str) -> Rule:
    return Rule("positive", (column,))


def in_set(column: str, *values) -> Rule:
    return Rule("in_set", (column,), params=tuple(values))


def equals(column: str, value) -> Rule:
    return Rule("equals", (column,), params=(value,))


def not_blank(column: str) -> Rule:
    """Exactly ``""`` or one space is blank; two spaces are not."""
    return Rule("not_blank", (column,))


def types_of(schema) -> list[Rule]:
    """One type rule per field of a ``StructType``, in field order."""
    return [has_type(f.name, f.dataType.simpleString()) for f in schema.fields]
