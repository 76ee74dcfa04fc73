"""Single-pass data-quality evaluation and the gate built on it.

``evaluate`` turns a rule set into ONE lazily planned DataFrame of results:

* every row rule of the table becomes a ``count_if`` inside a single global
  aggregate (one scan, partial aggregation per task, one row to merge);
* every ``unique`` rule is one ``groupBy(key).count()`` whose partial
  (map-side) aggregation collapses hot keys before the shuffle;
* type rules are decided from the schema alone - no job.

The result has one row per rule, so collecting it for the gate moves a few
dozen values to the driver regardless of table size.

:class:`Watched` lets the row rules ride on a write: their counts are observed metrics
of the pass that lands the rows, and the gate is left with the keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import job_label
from ..functions.rules import (GATE_FAILED, GATE_FAILED_INCREMENTAL, ROW_KINDS, Rule, quote,
                               sql_literal)

RESULT_COLUMNS = ("rule_no", "rule_kind", "column_name", "violations", "message")


@dataclass(frozen=True)
class RuleResult:
    rule_no: int
    rule_kind: str
    column_name: str
    violations: int | None     # None: rule skipped because its column is missing
    message: str | None        # set only when the rule failed


class QualityGateError(ValueError):
    """Raised by :func:`gate`; ``str()`` is the full report, one line per failure."""

    def __init__(self, text: str, results: list[RuleResult]):
        super().__init__(text)
        self.results = results


def _message_sql(rule: Rule, n: str) -> str:
    """Report text for a counted rule, NULL when nothing was violated."""
    head, _, tail = rule.template().partition("{n}")
    return (f"CASE WHEN {n} > 0 THEN concat({sql_literal(head)}, CAST({n} AS STRING), "
            f"{sql_literal(tail)}) END")


def _entry_sql(no: int, rule: Rule, n: str, message: str) -> str:
    return (f"named_struct('rule_no', CAST({no} AS INT), "
            f"'rule_kind', {sql_literal(rule.kind)}, "
            f"'column_name', {sql_literal(rule.column)}, "
            f"'violations', CAST({n} AS BIGINT), 'message', CAST({message} AS STRING))")


ROWS_RULE_NO = 0   # optional row-count entry of :func:`evaluate`


def _typed(df: DataFrame, rules: list[Rule]):
    """name -> SQL of the column, ``try_cast`` where it has not the type the rules demand. Casts
    known to fail are spelled as NULL: one that fails costs as much as hundreds that don't."""
    actual = dict(df.dtypes)
    expected = {r.columns[0]: r.expected for r in rules if r.kind == "type"}

    def value(name: str) -> str:
        want = expected.get(name)
        if actual.get(name) in ("date", "timestamp", "timestamp_ntz") and want in ("int", "bigint", "double"):
            return f"CAST(NULL AS {want})"                                   # no date reads as a number
        if actual.get(name) == "bigint" and want == "int":
            return f"CASE WHEN {quote(name)} BETWEEN -2147483648 AND 2147483647 THEN CAST({quote(name)} AS INT) END"
        if actual.get(name) in ("date", "timestamp", "timestamp_ntz") and want not in (None, "string"):
            return f"try_cast(CAST({quote(name)} AS STRING) AS {want})"      # no direct cast: NULL
        if want is not None and actual.get(name) != want:
            return f"try_cast({quote(name)} AS {want})"
        return quote(name)
    return value


class Watched:
    """Row rules counted while the rows are written, as observed metrics of that write.

    ``where`` (SQL) limits the counts to the rows that the gate is about, ``extra`` adds
    named aggregates. A column that is missing is not counted. Only rows of tasks that
    succeeded count. Use one object for one action.
    """

    def __init__(self, rules: list[Rule], where: str | None = None, extra: dict[str, Column] | None = None):
        self.rules, self.where, self.extra = rules, where, extra or {}
        self.observation = Observation()

    def over(self, df: DataFrame) -> DataFrame:
        value, have = _typed(df, self.rules), set(df.columns)

        def counted(predicate: str) -> str:
            return f"count_if({predicate})" if self.where is None else f"count_if(({self.where}) AND ({predicate}))"
        metrics = [F.expr(counted("TRUE")).alias("rows")]
        metrics += [F.expr(counted(r.predicate_sql(value))).alias(f"rule_{no}")
                    for no, r in enumerate(self.rules, start=1) if r.kind in ROW_KINDS and have.issuperset(r.columns)]
        return df.observe(self.observation, *metrics, *[c.alias(n) for n, c in self.extra.items()])

    @property
    def counts(self) -> dict[str, int]:
        """The metrics by name, after the action; None for an aggregate of no rows."""
        return self.observation.get


def evaluate(df: DataFrame, rules: list[Rule], count_rows: bool = False,
             found_types: dict[str, str] | None = None, counts: dict[str, int] | None = None) -> DataFrame:
    """Lazily planned results ``(rule_no, rule_kind, column_name, violations, message)``.

    ``rule_no`` is 1-based in rule order. Rules on a missing column are
    reported with NULL violations (the type rule reports ``found None``).
    Value rules on a column of the wrong type compare ``try_cast`` values, so
    a malformed cell is NULL instead of an ANSI cast error. ``count_rows``
    adds a row ``(0, 'rows', '*', count(*), NULL)`` from the same aggregate.
    ``found_types`` names the types of columns whose raw cells did not all have
    the declared one; these fail their type rule. ``counts`` are the row rules'
    counts where a :class:`Watched` write has them already; ``df`` is then read
    for its keys only.

    The row rules are assembled into ONE SQL aggregate expression (parsed
    once on the JVM), so plan building costs a handful of calls however
    many rules a table has.
    """
    actual = dict(df.dtypes)
    value = _typed(df, rules)

    entries: list[str] = []
    if count_rows:
        n = "count(1)" if counts is None else f"{int(counts['rows'])}L"
        entries.append(f"named_struct('rule_no', CAST({ROWS_RULE_NO} AS INT), "
                       "'rule_kind', 'rows', 'column_name', '*', "
                       f"'violations', {n}, 'message', CAST(NULL AS STRING))")
    key_frames: list[DataFrame] = []
    for no, rule in enumerate(rules, start=1):
        present = all(c in actual for c in rule.columns)
        if rule.kind == "type":
            found = (found_types or {}).get(rule.columns[0], actual.get(rule.columns[0]))
            bad = found != rule.expected
            text = sql_literal(rule.message(actual=found)) if bad else "NULL"
            entries.append(_entry_sql(no, rule, str(int(bad)), text))
        elif not present:
            entries.append(_entry_sql(no, rule, "NULL", "NULL"))
        elif rule.kind in ROW_KINDS:
            n = f"count_if({rule.predicate_sql(value)})" if counts is None else f"{int(counts[f'rule_{no}'])}L"
            entries.append(_entry_sql(no, rule, n, _message_sql(rule, n)))
        elif rule.kind == "unique":
            entry = _entry_sql(no, rule, "count(1)", _message_sql(rule, "count(1)"))
            key_frames.append(
                df.groupBy(*[quote(c) for c in rule.columns]).count()
                .filter("count > 1")
                .agg(F.expr(entry).alias("e"))
                .select("e.*"))
        else:
            raise ValueError(f"unknown rule kind {rule.kind!r}")

    out = None
    if entries:
        array = F.expr(f"array({', '.join(entries)})").alias("e")
        out = (df.agg(array) if counts is None else df.sparkSession.range(1).select(array)).select(F.inline("e"))
    for frame in key_frames:
        out = frame if out is None else out.unionByName(frame)
    if out is None:
        raise ValueError("empty rule set")
    return out.select(*RESULT_COLUMNS)


def failures(results: list[RuleResult]) -> list[str]:
    """Failure texts in rule order."""
    return [r.message for r in sorted(results, key=lambda r: r.rule_no)
            if r.violations and r.message]


class GateResults(list):
    """Per-rule results of a gate (a list of :class:`RuleResult`) plus ``rows``,
    the number of rows the gate saw (counted in the same aggregate)."""

    rows: int | None = None


def collect_results(df: DataFrame, rules: list[Rule],
                    found_types: dict[str, str] | None = None) -> list[RuleResult]:
    """Run :func:`evaluate` as one action; returns one small row per rule."""
    rows = evaluate(df, rules, found_types=found_types).collect()
    return sorted((RuleResult(**r.asDict()) for r in rows), key=lambda r: r.rule_no)


def gate(df: DataFrame, rules: list[Rule], title: str,
         incremental: bool = False, found_types: dict[str, str] | None = None,
         counts: dict[str, int] | None = None) -> GateResults:
    """Evaluate every rule at once; raise one :class:`QualityGateError` listing all failures.
    ``counts``: the row rules' counts, if a :class:`Watched` write has them."""
    with job_label(df.sparkSession, f"gate {title}"):
        rows = evaluate(df, rules, count_rows=True, found_types=found_types, counts=counts).collect()
    everything = sorted((RuleResult(**r.asDict()) for r in rows), key=lambda r: r.rule_no)
    results = GateResults(r for r in everything if r.rule_no != ROWS_RULE_NO)
    results.rows = next((r.violations for r in everything if r.rule_no == ROWS_RULE_NO), None)
    errors = failures(results)
    if errors:
        head = (GATE_FAILED_INCREMENTAL if incremental else GATE_FAILED).format(title=title)
        raise QualityGateError(head + "\n" + "\n".join(f"- {e}" for e in errors), results)
    return results
