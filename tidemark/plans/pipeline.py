"""The three loads and the run that picks between them.

Every stage is a lazily built DataFrame; the actions are the writes, one
group-by of the keys per gate, and the mark. **Each raw file is parsed once a
run**: the raw orders are staged (typed, in a partition of their own), and on that
same pass Spark observes malformed cells, the guard's count, the batch's upper bound
and all row rules of the gate; the lines are observed while they land in Bronze.
Everything later reads the staged or landed columns. Only scalars and per-rule counts
reach the driver; nothing is cached. Malformed cells fail the gate's type rules
before the mark moves.

Batch protocol (transactional tables, see ``sinks.store``):

* ``lo``  = the mark at the start of the run; the batch owns partition ``lo`` of
  the current epoch (a forced reload: partition 0 of the next epoch, which readers
  see only when the mark's append names it);
* ``hi``  = the largest prior ``order_id`` the batch brings (never below ``lo``);
* orders  = raw orders with ``order_id > lo`` (the initial load takes all);
* lines   = raw lines with ``lo < order_id <= hi`` - clamped at ``hi`` so a
  line that arrives before its order is loaded once, in the batch that
  brings the order, instead of twice;
* the mark moves to ``hi`` for both transaction files, in one append, as
  the very last step; a failure anywhere before leaves it unmoved and a
  retry overwrites the same partitions.

``other_eval_set``: ``"fail"`` keeps the incremental gate on the raw batch,
so a new non-prior order fails the run; ``"skip"`` drops non-prior orders
before guard, gate and mark.

``skip_unchanged_raw`` (default off) lets incremental runs skip raw files the
manifest proves hold no key above the mark, for write-once drops
(``sources.manifest``);
``silver_copy=False`` serves the Silver transaction tables as the committed
Bronze batches instead of writing a second copy.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from ..operators import gold, late, quality
from ..operators.watermark import WatermarkLog, newer_than, within
from ..sinks.store import Lakehouse, empty_frame
from ..sources import registry, schemas
from ..sources.csv import found_types, read_csv, read_source
from ..sources.manifest import RawManifest
from . import rulesets

NO_NEW_DATA = "NO_NEW_DATA"
SUCCESS = "SUCCESS"
TRANSACTION_FILES = [registry.ORDERS.file_name, registry.ORDER_PRODUCTS.file_name]
DIM_TABLES = {"products": "dim_product", "aisles": "dim_aisle", "departments": "dim_department"}
TRANSACTION_TABLES = ("orders", "order_products_prior")
FACT_TABLE = "fact_order_products"
BATCH_TABLES = (("bronze", "orders"), ("bronze", "order_products_prior"), ("silver", "orders"),
                ("silver", "order_products_prior"), ("gold", FACT_TABLE))
STAGING = "staging"
FILE_COLUMN = "_raw_file"
GLOB_CHARACTERS = "*?[]{}\\"


def concurrently(*tasks: Callable[[], Any]) -> list[tuple[Any, BaseException | None]]:
    """Submit independent Spark actions from driver threads so their jobs share
    the executors; returns ``(result, error)`` per task, in task order."""
    if len(tasks) <= 1:
        out = []
        for task in tasks:
            try:
                out.append((task(), None))
            except Exception as e:  # noqa: BLE001 - handed back to the caller
                out.append((None, e))
        return out
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [pool.submit(t) for t in tasks]
        out = []
        for f in futures:
            try:
                out.append((f.result(), None))
            except Exception as e:  # noqa: BLE001
                out.append((None, e))
        return out


def run_all(*tasks: Callable[[], Any]) -> list[Any]:
    """:func:`concurrently`, raising the first error in task order."""
    outcomes = concurrently(*tasks)
    for _, error in outcomes:
        if error is not None:
            raise error
    return [r for r, _ in outcomes]


@dataclass(frozen=True)
class Batch:
    """The partition that a run owns, and how it is written."""
    epoch: int
    lo: int
    initial: bool                    # takes all history, not only rows above ``lo``
    reload: bool = False             # a forced initial load, into an epoch of its own


@dataclass
class Staged:
    """The raw orders of a run, parsed once, and what that pass observed."""
    rows: DataFrame                  # stored, typed; with the raw file's name under the manifest
    counts: dict[str, int]           # rows the gate is about, violations by rule
    found: dict[str, str]            # types of the columns with malformed cells
    new: int                         # rows above the mark that decide NO_NEW_DATA
    top: int | None                  # largest prior order id


@dataclass
class LoadResult:
    status: str                      # SUCCESS | NO_NEW_DATA
    mode: str                        # initial | incremental | reference
    lo: int | None = None            # mark before the run
    hi: int | None = None            # mark after the run
    new_orders: int | None = None    # raw orders above the mark seen by the guard
    quality: dict[str, list[quality.RuleResult]] = field(default_factory=dict)
    raw_files: dict[str, tuple[int, int]] = field(default_factory=dict)   # read, skipped

    @property
    def rows(self) -> dict[str, int | None]:
        """Rows each gate saw (= rows promoted to Silver on success), per table."""
        return {t: getattr(r, "rows", None) for t, r in self.quality.items()}


class Pipeline:
    def __init__(self, spark: SparkSession, store: Lakehouse, raw_root: str,
                 other_eval_set: str = "fail", infer_schema: bool = False,
                 broadcast_max_rows: int = gold.DEFAULT_BROADCAST_MAX_ROWS,
                 skip_unchanged_raw: bool = False, silver_copy: bool = True):
        if other_eval_set not in ("fail", "skip"):
            raise ValueError("other_eval_set must be 'fail' or 'skip'")
        self.spark = spark
        self.store = store
        self.raw_root = raw_root
        self.other_eval_set = other_eval_set
        self.infer_schema = infer_schema
        self.broadcast_max_rows = broadcast_max_rows
        self.marks = WatermarkLog(store)
        # file skipping needs the declared schema: inference must see every file
        self.skip_unchanged_raw = skip_unchanged_raw and not infer_schema
        self.manifest = RawManifest(store)
        # Silver of the transaction tables is an identity copy of the gated
        # Bronze batch; with silver_copy=False it is served zero-copy as the
        # committed Bronze batches (every committed batch passed its gates).
        self.silver_copy = silver_copy

    # -- helpers -----------------------------------------------------------------
    def _raw(self, spec: registry.SourceSpec, seen: Observation | None = None) -> DataFrame:
        return read_source(self.spark, spec, self.raw_root, infer=self.infer_schema, observation=seen)

    def _found(self, seen: Observation) -> dict[str, str]:
        """Types of the columns with malformed cells, after an action over the frame."""
        return {} if self.infer_schema else found_types(seen)

    def _check_key(self, df: DataFrame, gate: Callable[[DataFrame, bool], Any], incremental: bool) -> None:
        """Before any comparison with the mark: a key column that is missing or no
        integer (or a missing ``eval_set``) fails the gate, which reports everything at once."""
        kinds = dict(df.dtypes)
        if (kinds.get("order_id") not in ("tinyint", "smallint", "int", "bigint")
                or gate == self._gate_orders and "eval_set" not in kinds):
            gate(df, incremental)
            raise AssertionError("the gate must refuse a key that is no integer")

    def _incremental_source(self, spec: registry.SourceSpec, lo: int, seen: Observation
                            ) -> tuple[DataFrame, DataFrame | None, tuple[int, int]]:
        """Raw rows for a run at mark ``lo``, the files read (for the manifest) and the
        numbers of files (read, skipped).

        With the manifest, files that provably hold no key above ``lo`` are not
        read (see ``sources.manifest``) and rows carry their file in ``_raw_file``.
        """
        if not self.skip_unchanged_raw:
            return self._raw(spec, seen), None, (0, 0)
        files, paths, skipped = self.manifest.plan(spec.file_name, spec.path(self.raw_root), lo)
        if any(ch in p for p in paths for ch in GLOB_CHARACTERS):
            # a listed name would be read as a glob pattern: read the source as a
            # whole and record nothing for it
            return self._raw(spec, seen), None, (0, 0)
        if not paths:
            empty = empty_frame(self.spark, spec.schema)
            return empty.withColumn(FILE_COLUMN, F.lit(None).cast("string")), None, (0, skipped)
        df = read_csv(self.spark, paths, spec.schema, quoted=spec.quoted, observation=seen,
                      file_column=FILE_COLUMN)
        return df, files, (len(paths), skipped)

    def _record(self, spec: registry.SourceSpec, lo: int, files: DataFrame | None, staged: DataFrame | None) -> None:
        """Files read and their largest keys (of the staged rows), for the manifest."""
        if files is not None and staged is not None:
            bounds = (newer_than(staged, "order_id", lo).groupBy(F.col(FILE_COLUMN).alias("path"))
                      .agg(F.max("order_id").alias("bound")))
            self.manifest.record(spec.file_name, lo, files, bounds)

    def _prior(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col("eval_set") == F.lit(rulesets.PRIOR))

    def _silver_products(self) -> tuple[DataFrame, int]:
        """silver.products and its row count (one job serves both checks).

        An empty dimension would drop every line in the inner join while the
        mark still advances: refuse instead of losing the batch.
        """
        products = self.store.read("silver", "products", schema=schemas.PRODUCTS,
                                   partitioned=False)
        rows = gold.counted_rows(products)
        if rows == 0:
            raise RuntimeError("silver.products is missing or empty: run reference_load() first")
        return products, rows

    def _fact(self, lines: DataFrame, orders: DataFrame) -> DataFrame:
        products, rows = self._silver_products()
        return gold.build_fact(lines, orders, products,
                               broadcast_max_rows=self.broadcast_max_rows, product_rows=rows)

    def _stored_layer(self, layer: str, table: str) -> str:
        """Where a layer's table physically lives (zero-copy Silver -> Bronze)."""
        if layer == "silver" and table in TRANSACTION_TABLES and not self.silver_copy:
            return "bronze"
        return layer

    def _read(self, layer: str, table: str, schema, batch: Batch) -> DataFrame:
        # With inferred raw types Bronze holds whatever the files gave; read it
        # as stored so the gate's type rules see the real types.
        if self.infer_schema and layer == "bronze":
            schema = None
        return self.store.read(layer, table, schema=schema, batch=batch.lo, epoch=batch.epoch)

    def _put(self, df: DataFrame, layer: str, table: str, schema, batch: Batch) -> None:
        """Write a run's rows of a table: a first load replaces the table, a reload lands in
        its own epoch, an increment in its own partition."""
        if batch.reload:
            self.store.write_batch(df, layer, table, batch.lo, epoch=batch.epoch, conformed=False, sort_by="order_id")
        elif batch.initial:
            self.store.replace(df, layer, table, batch.lo, batch.epoch, sort_by="order_id")
        else:
            self.store.write_batch(df, layer, table, batch.lo, schema, batch.epoch, sort_by="order_id")

    def _stage(self, df: DataFrame, table: str, batch: Batch) -> DataFrame:
        """``df`` stored for this run only, as parsed."""
        self.store.replace(df, STAGING, table, batch.lo, batch.epoch)
        return self.store.read(STAGING, table, schema=df.schema, batch=batch.lo, epoch=batch.epoch)

    def _unstage(self) -> None:
        for table in TRANSACTION_TABLES:
            self.store.drop_table(STAGING, table)

    # -- loads -------------------------------------------------------------------
    def reference_load(self) -> LoadResult:
        """Products, aisles, departments: Bronze, gated Silver, Gold dimensions (full refresh).

        Silver is written for the tables before the first failing gate (table
        order); that failure is raised and no dimension is rebuilt.
        """
        specs = registry.reference_sources()
        found = run_all(*[partial(self._land_reference, s) for s in specs])
        bronze = {s.table: self.store.read("bronze", s.table) for s in specs}
        outcomes = concurrently(*[
            partial(quality.gate, bronze[s.table], rulesets.RULESETS[s.table](),
                    rulesets.TITLES[s.table], False, f) for s, f in zip(specs, found)])
        checks, passed, failure = {}, [], None
        for spec, (result, error) in zip(specs, outcomes):
            if error is not None:
                failure = error
                break
            checks[spec.table] = result
            passed.append(spec)
        promote = [partial(self.store.replace, bronze[s.table], "silver", s.table) for s in passed]
        if failure is not None:
            run_all(*promote)
            raise failure
        # Silver is an identity copy of the gated Bronze, so the dimensions are
        # built from the same frames while Silver is written.
        run_all(*promote, *[partial(self.store.replace, gold.build_dim(bronze[s.table]), "gold",
                                    DIM_TABLES[s.table]) for s in specs])
        return LoadResult(SUCCESS, "reference", quality=checks)

    def _land_reference(self, spec: registry.SourceSpec) -> dict[str, str]:
        seen = Observation()
        self.store.replace(self._raw(spec, seen), "bronze", spec.table)
        return self._found(seen)

    def _gate_orders(self, df: DataFrame, incremental: bool, found: dict[str, str] | None = None,
                     counts: dict[str, int] | None = None):
        return quality.gate(df, rulesets.orders_rules(), rulesets.TITLES["orders"],
                            incremental=incremental, found_types=found, counts=counts)

    def _gate_lines(self, df: DataFrame, incremental: bool, found: dict[str, str] | None = None,
                    counts: dict[str, int] | None = None):
        return quality.gate(df, rulesets.order_products_rules(),
                            rulesets.TITLES["order_products_prior"], incremental=incremental,
                            found_types=found, counts=counts)

    def initial_load(self, force: bool = False) -> LoadResult:
        """Full history into all three layers; the mark moves to the largest prior id.

        Over committed data (a mark above 0 and loaded orders) it is refused unless
        ``force`` is set. A forced load is written into an epoch of its own: what was
        committed is served until the new mark names that epoch, and stays if the load
        fails. The replaced partitions are deleted by the next load that succeeds.
        """
        epoch, lo = self.marks.current(registry.ORDERS.file_name)
        if force and lo > 0:
            return self._load(Batch(epoch + 1, 0, initial=True, reload=True))
        return self._load(Batch(epoch, lo, initial=True))

    def incremental_load(self) -> LoadResult:
        """Only orders above the mark (and their lines) are loaded; results appended."""
        epoch, lo = self.marks.current(registry.ORDERS.file_name)
        return self._load(Batch(epoch, lo, initial=False))

    def _load(self, batch: Batch) -> LoadResult:
        lo, mode = batch.lo, "initial" if batch.initial else "incremental"
        seen = Observation()
        raw, order_files, order_counts = self._incremental_source(registry.ORDERS, lo, seen)
        files = {registry.ORDERS.file_name: order_counts}
        if order_counts[1] and not order_counts[0] and not batch.initial:
            return LoadResult(NO_NEW_DATA, mode, lo=lo, hi=lo, new_orders=0, raw_files=files)
        self._check_key(raw, self._gate_orders, not batch.initial)
        orders = self._stage_orders(raw, batch, seen)
        gated = self._gated_rows(orders.rows, batch)
        gate_orders = partial(self._gate_orders, gated.drop(FILE_COLUMN), not batch.initial, orders.found, orders.counts)
        if orders.found:              # also rows whose key does not parse, which no batch would hold
            gate_orders()
        if orders.new == 0 or batch.initial and orders.top is None:
            self._unstage()
            return LoadResult(NO_NEW_DATA, mode, lo=lo, hi=lo, new_orders=orders.new, raw_files=files)
        if batch.initial and lo > 0 and not self.store.is_empty("bronze", "orders", batch.epoch):
            raise RuntimeError(f"orders up to {lo} are loaded: run an incremental load, "
                               "or force the initial load to rebuild everything")
        hi = lo if orders.top is None else max(lo, int(orders.top))

        # The lines land while the orders are gated. In an incremental run the orders land
        # after their gate, so that a batch of wrong types is reported by the gate, not
        # refused by the append; an initial load fills Bronze first, as a fresh copy of raw.
        land_orders = partial(self._put, self._prior(orders.rows).drop(FILE_COLUMN), "bronze", "orders",
                              schemas.ORDERS, batch)
        land_lines = partial(self._land_lines, batch, hi, files)
        if batch.initial:
            (_, orders_land), (lines, lines_land), (orders_ok, orders_err) = concurrently(
                land_orders, land_lines, gate_orders)
        else:
            (lines, lines_land), (orders_ok, orders_err) = concurrently(land_lines, gate_orders)
            orders_land = None
        for error in (orders_land, lines_land, orders_err) if batch.initial else (orders_err, lines_land):
            if error is not None:
                raise error
        line_files, staged_lines, found_lines, line_counts = lines
        bronze_lines = self._read("bronze", "order_products_prior", schemas.ORDER_PRODUCTS, batch)
        gate_lines = partial(self._gate_lines, bronze_lines, not batch.initial, found_lines, line_counts)
        if batch.initial:
            (lines_ok, lines_err), = concurrently(gate_lines)
        else:
            (_, orders_land), (lines_ok, lines_err) = concurrently(land_orders, gate_lines)
            if orders_land is not None:
                raise orders_land
        bronze_orders = self._read("bronze", "orders", schemas.ORDERS, batch)
        promote = [partial(self._put, bronze_orders, "silver", "orders", schemas.ORDERS, batch)]
        if lines_err is not None:
            run_all(*(promote if self.silver_copy else []))
            raise lines_err
        promote.append(partial(self._put, bronze_lines, "silver", "order_products_prior",
                               schemas.ORDER_PRODUCTS, batch))
        # Silver is an identity copy of the gated Bronze batch, so the fact is
        # built from the same frames while Silver is written.
        fact = self._fact(bronze_lines, bronze_orders)
        run_all(*(promote if self.silver_copy else []),
                partial(self._put, fact, "gold", FACT_TABLE, _fact_schema(), batch))

        self._record(registry.ORDERS, lo, order_files, orders.rows)
        self._record(registry.ORDER_PRODUCTS, lo, line_files, staged_lines)
        self.marks.advance(TRANSACTION_FILES, hi, batch.epoch)
        self._unstage()
        if not batch.reload:          # readers of a replaced epoch had until now
            for layer, table in BATCH_TABLES:
                self.store.drop_epochs_before(layer, table, batch.epoch)
        return LoadResult(SUCCESS, mode, lo=lo, hi=hi, new_orders=orders.new, raw_files=files,
                          quality={"orders": orders_ok, "order_products_prior": lines_ok})

    def _gated_rows(self, orders: DataFrame, batch: Batch) -> DataFrame:
        """What the orders gate is about: prior orders, or in "fail" mode the whole increment."""
        return orders if self.other_eval_set == "fail" and not batch.initial else self._prior(orders)

    def _stage_orders(self, raw: DataFrame, batch: Batch, seen: Observation) -> Staged:
        """Parse the raw orders, once, into the staging partition; guard and row rules are
        observed on the way."""
        rows = raw if batch.initial else newer_than(raw, "order_id", batch.lo)
        prior = f"eval_set = '{rulesets.PRIOR}'"
        new = F.col("order_id") > F.lit(batch.lo)
        watched = quality.Watched(
            rulesets.orders_rules(),
            where=prior if batch.initial or self.other_eval_set == "skip" else None,
            extra={"new_rows": F.count_if(new & F.expr(prior) if self.other_eval_set == "skip" else new),
                   "top": F.max(F.when(F.expr(prior), F.col("order_id")))})
        staged = self._stage(watched.over(rows), "orders", batch)
        counts = watched.counts
        return Staged(staged, counts, self._found(seen), int(counts["new_rows"]), counts["top"])

    def _land_lines(self, batch: Batch, hi: int, files: dict[str, tuple[int, int]]
                    ) -> tuple[DataFrame | None, DataFrame | None, dict[str, str], dict[str, int]]:
        """Parse the raw lines, once, and land the batch's in Bronze; returns the files read and
        their staged rows (under the manifest), malformed columns and the row rules' counts."""
        seen = Observation()
        # an initial load does not skip files and records none
        raw, line_files, counts = ((self._raw(registry.ORDER_PRODUCTS, seen), None, (0, 0)) if batch.initial
                                   else self._incremental_source(registry.ORDER_PRODUCTS, batch.lo, seen))
        if not batch.initial:
            files[registry.ORDER_PRODUCTS.file_name] = counts
        self._check_key(raw, self._gate_lines, not batch.initial)
        staged = None
        if line_files is not None:    # the manifest wants the keys above ``hi`` too
            staged = raw = self._stage(newer_than(raw, "order_id", batch.lo), "order_products_prior", batch)
        watched = quality.Watched(rulesets.order_products_rules())
        lines = within(raw, "order_id", None if batch.initial else batch.lo, hi).drop(FILE_COLUMN)
        self._put(watched.over(lines), "bronze", "order_products_prior", schemas.ORDER_PRODUCTS, batch)
        nothing_read = counts[1] and not counts[0]
        return line_files, staged, {} if nothing_read else self._found(seen), watched.counts

    # -- orchestration -------------------------------------------------------------
    def bronze_row_count(self) -> int:
        """Rows in bronze.orders (all batches of the epoch, committed or not); 0 if absent."""
        return self.store.row_count("bronze", "orders", self.marks.current(registry.ORDERS.file_name)[0])

    def choose_mode(self) -> str:
        """Initial load while bronze.orders is empty, else incremental (needs one row, not a count)."""
        epoch = self.marks.current(registry.ORDERS.file_name)[0]
        return "initial" if self.store.is_empty("bronze", "orders", epoch) else "incremental"

    @staticmethod
    def mode_for(bronze_rows: Column) -> Column:
        """The mode decision as a column: an empty Bronze means initial load."""
        return F.when(bronze_rows == 0, F.lit("initial")).otherwise(F.lit("incremental"))

    @staticmethod
    def status_for(new_rows: Column) -> Column:
        return F.when(new_rows == 0, F.lit(NO_NEW_DATA)).otherwise(F.lit("NEW_DATA"))

    def run(self) -> LoadResult:
        """Pick initial or incremental load from the Bronze row count and run it."""
        if self.choose_mode() == "initial":
            return self.initial_load()
        return self.incremental_load()

    # -- serving -------------------------------------------------------------------
    def committed(self, layer: str, table: str, schema) -> DataFrame:
        """A transactional table without rows of unfinished batches."""
        epoch, mark = self.marks.current(registry.ORDERS.file_name)
        return self.store.read(self._stored_layer(layer, table), table, schema=schema,
                               committed_below=mark, epoch=epoch)

    def fact(self) -> DataFrame:
        fact_schema = _fact_schema()
        return self.committed("gold", FACT_TABLE, fact_schema)

    def dims(self) -> dict[str, DataFrame]:
        by_table = {s.table: s for s in registry.REGISTRY.values()}
        return {dim: self.store.read("gold", dim, schema=by_table[table].schema,
                                     partitioned=False)
                for table, dim in DIM_TABLES.items()}

    def star(self) -> DataFrame:
        d = self.dims()
        return gold.star(self.fact(), d["dim_product"], d["dim_aisle"], d["dim_department"],
                         broadcast_max_rows=self.broadcast_max_rows)

    def late_lines(self) -> DataFrame:
        """Raw lines at or below the mark that never reached Silver.

        A line arriving after the mark passed its order is never selected
        again; this opt-in report makes such rows visible (``operators.late``: orders
        whose lines all arrived are ruled out before anything is joined by line).
        """
        mark = self.marks.get(registry.ORDERS.file_name)
        raw = self._raw(registry.ORDER_PRODUCTS).filter(F.col("order_id") <= F.lit(mark))
        silver = self.committed("silver", "order_products_prior", schemas.ORDER_PRODUCTS)
        return late.missing_rows(raw, silver, "order_id", "product_id")

    def stored_sizes(self) -> DataFrame:
        """(layer, table_name, row_count, high_water) of the committed transactional tables, from file
        footers: the row count that decides the mode, and the largest order id of each layer."""
        epoch, mark = self.marks.current(registry.ORDERS.file_name)
        rows = [self.store.footer_frame(self._stored_layer(layer, table), table, "order_id", epoch, mark)
                .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count", "high_water")
                for layer, table in BATCH_TABLES]
        out = rows[0]
        for more in rows[1:]:
            out = out.unionByName(more)
        return out

    def orphans(self) -> DataFrame:
        """Committed Silver lines the fact dropped, per reason (see ``gold.orphan_lines``)."""
        return gold.orphan_lines(
            self.committed("silver", "order_products_prior", schemas.ORDER_PRODUCTS),
            self.committed("silver", "orders", schemas.ORDERS), self._silver_products()[0],
            broadcast_max_rows=self.broadcast_max_rows)

    def register_tables(self) -> list[str]:
        """``<layer>.<table>`` names in the session catalog, for SQL users.

        One database per layer (located under the store root, not in a local
        warehouse) holding views over the stored tables; transactional tables
        show committed batches only. Re-run after a load to move the views to
        the new mark.
        """
        epoch, mark = self.marks.current(registry.ORDERS.file_name)
        names = []
        for layer in ("bronze", "silver", "gold", "control"):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} "
                           f"LOCATION '{self.store.root}/_catalog/{layer}.db'")
        tables = [("bronze", "orders", True), ("bronze", "order_products_prior", True),
                  ("silver", "orders", True), ("silver", "order_products_prior", True),
                  ("gold", FACT_TABLE, True)]
        tables += [(layer, s.table, False) for s in registry.reference_sources()
                   for layer in ("bronze", "silver")]
        tables += [("gold", dim, False) for dim in DIM_TABLES.values()]
        for layer, table, batched in tables:
            stored = self._stored_layer(layer, table)
            schema = self.store.table_schema(stored, table)
            if schema is None:
                continue
            cols = ", ".join(f"`{f.name}`" for f in schema.fields)
            src = f"{self.store.fmt}.`{self.store.path(stored, table)}`"
            where = (f" WHERE {schemas.EPOCH_COLUMN} = {epoch} AND {schemas.BATCH_COLUMN} < {mark}"
                     if batched else "")
            self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{table} AS "
                           f"SELECT {cols} FROM {src}{where}")
            names.append(f"{layer}.{table}")
        log = self.store.path("control", "watermark")
        if self.store.table_schema("control", "watermark") is not None:
            self.spark.sql(
                "CREATE OR REPLACE VIEW control.watermark AS SELECT file_name, "
                "max_by(last_watermark, seq) AS last_watermark, max_by(updated_at, seq) AS updated_at "
                f"FROM {self.store.fmt}.`{log}` GROUP BY file_name")
            names.append("control.watermark")
        return names

    def register_views(self) -> list[str]:
        """Temp views ``<layer>_<table>`` over committed data, for SQL users."""
        names = []
        views = {
            "bronze_orders": self.committed("bronze", "orders", schemas.ORDERS),
            "bronze_order_products_prior": self.committed("bronze", "order_products_prior",
                                                          schemas.ORDER_PRODUCTS),
            "silver_orders": self.committed("silver", "orders", schemas.ORDERS),
            "silver_order_products_prior": self.committed("silver", "order_products_prior",
                                                          schemas.ORDER_PRODUCTS),
            "gold_fact_order_products": self.fact(),
            "control_watermark": self.marks.table(),
        }
        for dim, df in self.dims().items():
            views[f"gold_{dim}"] = df
        for spec in registry.reference_sources():
            for layer in ("bronze", "silver"):
                views[f"{layer}_{spec.table}"] = self.store.read(
                    layer, spec.table, schema=spec.schema, partitioned=False)
        for name, df in views.items():
            df.createOrReplaceTempView(name)
            names.append(name)
        return names


def _fact_schema():
    by_name = {f.name: f for s in (schemas.ORDERS, schemas.ORDER_PRODUCTS, schemas.PRODUCTS)
               for f in s.fields}
    return T.StructType([by_name[c] for c in schemas.FACT_COLUMNS])
