"""Full build and monthly batches on a warehouse folder.

Layout below the root::

    <table>/day=<D>/...     what the build of day D added to a table; a table as of D is all parts up to D
    marts/<table>/day=<D>/  marts and KPIs as of D, written whole by each build that asks for them
    builds/day=<D>/         one row, written last: which tables the build of D has added to

A full build fills an empty root, which the caller names; batches follow in date order. Every build writes
directories of its own day and nothing else, so running the newest batch again replaces what it wrote before, and
every earlier day can still be read: ``table(name, day)``. Readers see days whose build was finished.

What a batch writes follows the batch: new orders (``fact_sales``), what they add to their customers
(``buyer_months``, ``customer_parts``), versions opened or closed (``code_history``,
``dim_*``), locations first seen (``store_seen``) and source files that are new or changed (``sales_files``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.operators import facts, identity, mergeable, snapshots
from tillwise.operators.customer_marts import RfmConfig, customer_parts, merge_customer_parts
from tillwise.operators.quality import check_unique, freshness, run_checks
from tillwise.operators.relational import one_batch, upto_batch
from tillwise.plans.layers import DOMAINS, KPIS, MARTS, SORT_KEYS, Layers
from tillwise.schemas import CUSTOMER_CHECK_COLUMNS, SALES_CHECK_COLUMNS, STORE_CHECK_COLUMNS
from tillwise.sources.shared import store
from tillwise.sources.tables import rows_of_files, source_files, write_table


@dataclass(frozen=True)
class Dimension:
    """Where a dimension comes from, what is compared, and how all versions are built at once."""

    source: str
    key: str
    check_columns: Sequence[str]
    rebuild: Callable[[DataFrame], DataFrame]


DIMENSIONS = {
    "dim_customer": Dimension("src_customer", "customer_id", CUSTOMER_CHECK_COLUMNS, snapshots.customer_history),
    "dim_store": Dimension("src_store_detail", "store_code", STORE_CHECK_COLUMNS, snapshots.store_history),
    "dim_sales": Dimension("src_sales", "order_id", SALES_CHECK_COLUMNS, snapshots.sales_history),
}


# what every build adds to, besides dimensions
STATES = ("sales_files", "fact_sales", "buyer_months", "customer_parts", "store_seen", "code_history")


class BatchRejected(ValueError):
    """A batch holds rows that would make its result ambiguous, or comes out of order."""


def _require_empty(violations: DataFrame, message: str) -> None:
    found = violations.limit(1).collect()
    if found:
        raise BatchRejected(f"{message}: {found[0].asDict()}")


class RetailWarehouse:
    def __init__(self, spark: SparkSession, root: str, rfm: RfmConfig = RfmConfig()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rfm = rfm

    # --- parts -------------------------------------------------------------------------------------

    def _builds(self) -> dict[dt.date, dict]:
        """Finished builds by day; one row each."""
        try:
            rows = self.spark.read.schema("tables array<string>, unique_orders boolean, day date").parquet(f"{self.root}/builds").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {r.day: r.asDict() for r in sorted(rows, key=lambda r: r.day)}

    def _finish(self, day: dt.date, tables: Sequence[str], unique_orders: bool) -> None:
        row = self.spark.createDataFrame([(list(tables), unique_orders)], "tables array<string>, unique_orders boolean")
        write_table(row.coalesce(1), f"{self.root}/builds/day={day}")

    def _write(self, name: str, day: dt.date, df: DataFrame, *, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
        """Write the part of a day, in place of an earlier one, and give it back as read from there."""
        write_table(df, f"{self.root}/{name}/day={day}", partition_by=partition_by, sort_by=sort_by)
        return self._parts(name, day).filter(F.col("day") == F.lit(day)).drop("day")

    def _parts(self, name: str, upto: dt.date, *, before: bool = False) -> DataFrame:
        """All parts of a table up to a day, or before it, with the column ``day``. Prunes directories."""
        day = F.col("day")
        return self.spark.read.parquet(f"{self.root}/{name}").filter(day < F.lit(upto) if before else day <= F.lit(upto))

    def table(self, name: str, day: dt.date | None = None) -> DataFrame:
        """A table as of the newest finished build, or as of an earlier one."""
        builds = self._builds()
        day = day or max(builds, default=dt.date.min)
        built = {n for d, b in builds.items() if d <= day for n in b["tables"]}
        return self._table(name, day, built)

    def _table(self, name: str, day: dt.date, built: set[str]) -> DataFrame:
        if name not in built:
            raise KeyError(f"{name} has not been built")
        if name in DOMAINS:
            parts = self._parts(f"marts/{name}", day)
            newest = max(d for d, b in self._builds().items() if d <= day and name in b["tables"])
            return parts.filter(F.col("day") == F.lit(newest)).drop("day")
        if name in DIMENSIONS:
            return snapshots.versions_of(self._parts(name, day).drop("day"), DIMENSIONS[name].key)
        parts = self._parts(name, day)
        if name == "code_history":
            return identity.history_of_changes(parts, "day")
        if name == "buyer_months":
            return mergeable.merge_buyer_months(parts.drop("day"))
        if name == "customer_parts":
            return merge_customer_parts(parts.drop("day"))
        return parts.drop("day")

    # --- builds ------------------------------------------------------------------------------------

    def full(self, sources: Mapping[str, DataFrame], cutoff: dt.date, as_of: dt.date, *, with_marts: bool = True) -> None:
        """Build everything from all batches up to the cut-off, in a root that holds no build yet.

        Without marts, here or in ``batch``, when more batches follow and would rebuild them anyway.
        """
        if self._builds():
            raise ValueError(f"{self.root} holds a build; give a new one a root of its own")
        sales = upto_batch(sources["src_sales"], cutoff)
        _require_empty(sales.filter("order_id is null").select("partition_time"), "orders without an id")
        self._write("sales_files", cutoff, source_files(sales))
        fact = self._write("fact_sales", cutoff, facts.clean_sales(sales), partition_by=["partition_time"])
        # one pass over the order ids here spares every mart, and every later batch, its own
        unique = check_unique(fact, ["order_id"]).isEmpty()
        self._add_customers(fact, cutoff, unique)

        stores = sources["src_store"]
        self._write("store_seen", cutoff, identity.first_seen(upto_batch(stores, cutoff)), sort_by=["latitude", "longitude"])
        self._write("code_history", cutoff, identity.build_code_history(stores, cutoff), sort_by=["store_code"])
        tables = list(STATES)
        for name, dim in DIMENSIONS.items():
            if dim.source in sources:
                self._write_first_versions(name, sources[dim.source], cutoff)
                tables.append(name)
        self._complete(cutoff, as_of, tables, unique, with_marts)

    def batch(self, sources: Mapping[str, DataFrame], day: dt.date, as_of: dt.date, *, with_marts: bool = True) -> None:
        """Add one batch: store codes, sales, dimensions, then rebuild marts and KPIs.

        Batches are to be run in date order; running the newest one again changes nothing. Orders are looked for
        in source files that are new or have changed since the batches before, whatever their date.
        """
        builds = self._builds()
        if not builds:
            raise KeyError("there is no full build yet")
        if day < max(builds) or day == min(builds):
            raise BatchRejected(f"the batch of {day} has to come after {max(builds)}")
        before = {d: b for d, b in builds.items() if d < day}
        known = {n for b in before.values() for n in b["tables"]}
        # a batch is read many times below: a source may be costly to derive, or hold all batches in one file
        self._add_codes(store(one_batch(sources["src_store"], day), "src_store"), day)
        sales = upto_batch(sources["src_sales"], day)
        changed = self._changed_files(sales, day)
        unique = all(b["unique_orders"] for b in before.values()) & self._add_sales(sales, changed, day)
        tables = list(STATES)
        for name, dim in DIMENSIONS.items():
            if dim.source not in sources:
                continue
            tables.append(name)
            if name not in known:
                self._write_first_versions(name, sources[dim.source], day)
                continue
            newest = None
            if dim.source == "src_sales":
                rows, newest = self._newest_loads(sales, changed), "partition_time"
            else:
                rows = store(one_batch(sources[dim.source], day), dim.source)
                _require_empty(snapshots.ambiguous_keys(rows, dim.key), f"{dim.source} repeats or lacks a key on {day}")
                rows = rows.withColumnRenamed("partition_time", "partition_date")
            events = self._parts(name, day, before=True).drop("day")
            opened = snapshots.opened_versions(events, rows, dim.key, dim.check_columns, day, newest)
            self._write(name, day, opened, sort_by=[dim.key])
        self._complete(day, as_of, tables, unique, with_marts)

    def _complete(self, day: dt.date, as_of: dt.date, tables: list[str], unique: bool, with_marts: bool) -> None:
        if with_marts:
            earlier = {n for b in self._builds().values() for n in b["tables"]}
            tables = [*tables, *self._write_marts(day, as_of, earlier | set(tables), unique)]
        self._finish(day, tables, unique)

    def _add_codes(self, src_store: DataFrame, day: dt.date) -> None:
        """Code versions that the batch closes or opens, and locations it is the first to see."""
        _require_empty(identity.conflicting_codes(src_store, day), f"one location reports several codes on {day}")
        seen = identity.merge_first_seen(self._parts("store_seen", day, before=True).drop("day"))
        target = identity.history_of_changes(self._parts("code_history", day, before=True), "day")
        self._write("code_history", day, identity.code_changes(target, src_store, day, seen), sort_by=["store_code"])
        self._write("store_seen", day, identity.first_seen_changes(seen, one_batch(src_store, day)), sort_by=["latitude", "longitude"])

    def _changed_files(self, sales: DataFrame, day: dt.date) -> list[tuple[str, dt.date]]:
        """(path, batch) of source files that are new or differ in size or time from what was loaded before."""
        loaded = self._parts("sales_files", day, before=True)
        changed = source_files(sales).join(loaded, ["path", "size", "modified"], "left_anti")
        return [(r.path, r.batch) for r in self._write("sales_files", day, changed).collect()]

    def _add_sales(self, sales: DataFrame, changed: Sequence[tuple], day: dt.date) -> bool:
        """Append the orders of changed files that the fact lacks; whether the appended ids are distinct."""
        rows = rows_of_files(sales, [path for path, _ in changed])
        _require_empty(rows.filter("order_id is null").select("partition_time"), "orders without an id")
        new = facts.arrived_rows(rows, self._parts("fact_sales", day, before=True))
        fresh = self._write("fact_sales", day, new, partition_by=["partition_time"])
        # fresh ids are not in the fact, so only they can repeat among themselves
        unique = check_unique(fresh, ["order_id"]).isEmpty()
        self._add_customers(fresh, day, unique)
        return unique

    def _add_customers(self, fresh: DataFrame, day: dt.date, unique: bool) -> None:
        """What new sales add to their customers."""
        self._write("buyer_months", day, mergeable.buyer_months(fresh), sort_by=["customer_id"])
        self._write("customer_parts", day, customer_parts(fresh, unique_orders=unique), sort_by=["customer_id"])

    @staticmethod
    def _newest_loads(sales: DataFrame, changed: Sequence[tuple]) -> DataFrame:
        """Rows of the changed files, with newer loads of the same orders if an old batch has changed."""
        rows = rows_of_files(sales, [path for path, _ in changed])
        oldest = min((batch for _, batch in changed), default=None)
        if oldest is None or sales.filter(F.col("partition_time") > F.lit(oldest)).select("partition_time").isEmpty():
            return rows
        later = sales.filter(F.col("partition_time") >= F.lit(oldest))
        return later.join(rows.select("order_id").distinct(), "order_id", "left_semi")

    def _write_first_versions(self, name: str, source: DataFrame, day: dt.date) -> None:
        dim = DIMENSIONS[name]
        batches = upto_batch(source, day)
        if dim.source != "src_sales":
            doubled = batches.groupBy(dim.key, "partition_time").count().filter(f"count > 1 or {dim.key} is null")
            _require_empty(doubled, f"{dim.source} repeats or lacks a key inside a batch")
        self._write(name, day, snapshots.events_of(dim.rebuild(batches)), sort_by=[dim.key])

    # --- marts and checks --------------------------------------------------------------------------

    def layers(
        self, as_of: dt.date, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df, *, unique_orders: bool = False
    ) -> Layers:
        base = {name: self.table(name) for name in ("fact_sales", "code_history", "dim_customer")}
        return Layers(base, as_of, self.rfm, keep, unique_orders)

    def _write_marts(self, day: dt.date, as_of: dt.date, built: set[str], unique: bool) -> tuple[str, ...]:
        def keep(df: DataFrame, name: str) -> DataFrame:
            if name not in DOMAINS:
                return store(df, name) if name == "month_base" else df
            return self._write(f"marts/{name}", day, df, sort_by=SORT_KEYS[name])

        base = {name: self._table(name, day, built) for name in ("fact_sales", "code_history", "dim_customer", "buyer_months")}
        base["customer_parts"] = store(self._table("customer_parts", day, built), "customer_parts")  # two marts read it
        layers = Layers(base, as_of, self.rfm, keep, unique)
        for name in (*MARTS, *KPIS):
            layers[name]
        return (*MARTS, *KPIS)

    def marts(self, as_of: dt.date) -> None:
        """Rebuild marts and KPIs of the newest build from the stored fact, history and dimensions."""
        builds = self._builds()
        day, built = max(builds), {n for b in builds.values() for n in b["tables"]}
        added = self._write_marts(day, as_of, built, all(b["unique_orders"] for b in builds.values()))
        self._finish(day, sorted({*builds[day]["tables"], *added}), builds[day]["unique_orders"])

    def check(self, as_of: dt.date) -> DataFrame:
        """Outcome of every declared rule on the stored tables, and the age of the newest sales batch."""
        stored = {name: self.table(name) for name in (*MARTS, *KPIS)}
        views = self.layers(as_of)
        stored |= {name: views[name] for name in ("fact_sales", "code_history", "active_store", "closed_store")}
        age = freshness(stored["fact_sales"], "partition_time", as_of)
        late = (F.col("status") == "error").cast("bigint")
        newest = age.select(
            F.lit("freshness").alias("check"), F.lit("fact_sales").alias("table"), F.lit("partition_time").alias("column"),
            late.alias("violations"), (late == 0).alias("passed"),
        )
        return run_checks(stored).unionByName(newest)
