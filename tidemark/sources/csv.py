"""CSV scans of the raw zone.

Columns are bound by header name. Every cell is read as text and cast with
``try_cast`` to the declared type; cells that are not empty but don't cast are
*malformed*. What kinds of cells a column holds rides along with the first action
over the frame (a Spark ``Observation``), so the gate can report type errors
without a pass of its own. Files of one source must share one header; Spark
refuses the scan otherwise.

Types are found by a lattice: each cell has the narrowest of the kinds int, bigint,
decimal, double, date, timestamp, boolean and text, a column the union of its cells'
kinds as a bit mask (one ``bit_or`` a column, merged in any order), and the mask says
what type inference calls it. The inferring reader takes the masks of all columns in
one aggregate over the text, then casts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import SourceSpec

KINDS = "_cell_kinds"
# Kinds of cells, one bit each; integers beyond bigint have a bit for each precision.
INT, BIGINT, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << k for k in range(7))
_DECIMAL_FROM, _DECIMAL_BITS = 19, range(19, 39)


def _decimal_bit(precision: int) -> int:
    return 1 << (7 + precision - _DECIMAL_FROM)


DECIMALS = sum(_decimal_bit(p) for p in _DECIMAL_BITS)
# Looks that settle the kind without a cast.
_SHORT_INT, _SHORT_FRACTION = "^[0-9]{1,9}$", r"^[0-9]{1,9}\.[0-9]{1,9}$"
_INT_RANGE = (-2**31, 2**31 - 1)
# Kinds that a column of the type may hold.
_FITS = {"int": INT, "bigint": INT | BIGINT, "double": INT | BIGINT | DECIMALS | DOUBLE, "date": DATE,
         "timestamp": DATE | TIMESTAMP, "boolean": BOOLEAN}


def merged_type(mask: int) -> str:
    """What type inference calls a column whose cells are of these kinds."""
    if mask & DECIMALS and not mask & ~(INT | BIGINT | DECIMALS):
        digits = max(p for p in _DECIMAL_BITS if mask & _decimal_bit(p))
        return f"decimal({max(digits, 20 if mask & BIGINT else 10)},0)"
    for name in ("int", "bigint", "double", "date", "timestamp", "boolean"):
        if mask and not mask & ~_FITS[name]:
            return name
    return "string"


def scan_cells(spark: SparkSession, path: str | list[str], quoted: bool = False) -> DataFrame:
    """Header CSV scan, all cells as text; any Hadoop path (object stores included).

    ``quoted=True`` reads RFC-4180 fields where a quote inside a quoted field
    is doubled (``"Salt ""Fine"", Sea"``).
    """
    reader = spark.read.option("header", "true").option("enforceSchema", "false")
    if quoted:
        reader = reader.option("quote", '"').option("escape", '"')
    return reader.csv(path)


def _cell(cells: DataFrame, name: str) -> Column:
    return cells[f"`{name}`"]


def cell_kind(cell: Column) -> Column:
    """The narrowest kind of a text cell as its bit; 0 for an empty cell. A cast is tried only
    on cells of the right look: one that fails costs as much as hundreds that don't. The looks
    of most cells come first; what they leave goes through the whole list."""
    integer = cell.rlike(r"^\s*[+-]?[0-9]+\s*$")
    digits = F.length(F.regexp_replace(cell, "^[+-]?0*", ""))
    return (F.when(cell.isNull(), 0)
            .when(cell.rlike(_SHORT_INT), INT)
            .when(cell.rlike(_SHORT_FRACTION), DOUBLE)
            .when(cell.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & cell.try_cast("date").isNotNull(), DATE)
            .when(cell.rlike("^[0-9]{4}-[0-9]") & cell.try_cast("timestamp").isNotNull(), TIMESTAMP)
            .when(F.lower(cell).isin("true", "false"), BOOLEAN)
            .when(integer & ((F.length(cell) < 12) | (digits < 11))
                  & cell.try_cast("bigint").between(*_INT_RANGE), INT)
            .when(integer & cell.try_cast("bigint").isNotNull(), BIGINT)
            .when(cell.rlike("^[+-]?[0-9]+$") & digits.between(_DECIMAL_FROM, _DECIMAL_BITS[-1]),
                  F.call_function("shiftleft", F.lit(1), F.lit(7 - _DECIMAL_FROM) + digits))
            .when(cell.rlike(r"^\s*[+-]?(\.|[0-9]|(?i:nan|inf))") & ~cell.rlike("^[0-9]{4}-")
                  & cell.try_cast("double").isNotNull(), DOUBLE)
            .otherwise(TEXT))


def _with_kinds(cells: DataFrame, names: list[str]) -> tuple[DataFrame, list[Column]]:
    """``cells`` with the kinds of the named columns, and one ``bit_or`` for each. Rows whose cells
    are all empty, short integers or short fractions take their kinds from two patterns; for the
    others one function goes over an array, not an expression a column: the generated code stays
    small enough to be compiled."""
    own = [_cell(cells, n) for n in names]
    plain = [F.when(c.isNull(), 0).when(c.rlike(_SHORT_INT), INT).when(c.rlike(_SHORT_FRACTION), DOUBLE) for c in own]
    easy = cells.withColumn(KINDS, F.array(*plain))
    whole = F.transform(F.array(*[_cell(easy, n) for n in names]), cell_kind)
    out = easy.withColumn(KINDS, F.when(F.exists(F.col(KINDS), F.isnull), whole).otherwise(F.col(KINDS)))
    return out, [F.bit_or(F.col(KINDS)[k]) for k in range(len(names))]


def infer_types(cells: DataFrame) -> dict[str, str]:
    """Column -> type of a frame of text cells, all columns in one aggregate."""
    df, masks = _with_kinds(cells, cells.columns)
    found = df.agg(*[m.alias(str(k)) for k, m in enumerate(masks)]).first()
    return {c: merged_type(m or 0) for c, m in zip(cells.columns, found)}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             quoted: bool = False, observation: Observation | None = None,
             file_column: str | None = None) -> DataFrame:
    """The declared columns by name, cast; a column the header lacks is left out.

    ``schema=None`` infers the types (see :func:`infer_types`). ``observation`` collects,
    per column that is not text, the kinds of its cells (see :func:`found_types`);
    ``file_column`` adds the file each row came from.
    """
    cells = scan_cells(spark, path, quoted)
    if schema is None:
        schema = T.StructType([T.StructField(c, T.DataType.fromDDL(t)) for c, t in infer_types(cells).items()])
    if file_column is not None:
        cells = cells.withColumn(file_column, F.col("_metadata.file_path"))
    fields = [f for f in schema.fields if f.name in cells.columns]
    watched = [f for f in fields if not isinstance(f.dataType, T.StringType)]
    if observation is not None and watched:
        cells, masks = _with_kinds(cells, [f.name for f in watched])
        cells = cells.observe(observation, *[
            m.alias(f"{f.dataType.simpleString()} {f.name}") for f, m in zip(watched, masks)])
    return cells.select(*[_cell(cells, f.name).try_cast(f.dataType).alias(f.name) for f in fields],
                        *([file_column] if file_column is not None else []))


def found_types(observation: Observation) -> dict[str, str]:
    """Column -> type that its cells give it, where that is not the declared one's; call it
    after an action."""
    if observation._jo is None:          # no such column in the header: nothing was observed
        return {}
    found = {}
    for label, mask in observation.get.items():
        declared, name = label.split(" ", 1)
        if (mask or 0) & ~_FITS[declared]:
            found[name] = merged_type(mask)
    return found


def read_source(spark: SparkSession, spec: SourceSpec, raw_root: str, infer: bool = False,
                observation: Observation | None = None, file_column: str | None = None) -> DataFrame:
    """Scan a registered raw file with its schema (or inferred types)."""
    return read_csv(spark, spec.path(raw_root), None if infer else spec.schema, quoted=spec.quoted,
                    observation=observation, file_column=file_column)


def write_csv(df: DataFrame, path: str, quoted: bool = False) -> None:
    """Write a header CSV folder the readers above can scan back."""
    writer = df.write.mode("overwrite").option("header", "true")
    if quoted:
        writer = writer.option("quote", '"').option("escape", '"')
    writer.csv(path)
