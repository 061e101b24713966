"""How every derived table follows from the others.

``Layers`` builds tables on demand: asking for one builds what it needs first. Every table built
passes through ``keep``, which may write it and return the stored copy, or leave it lazy.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

from tillwise.operators import customer_marts, kpis, mergeable, sales_marts, store_marts
from tillwise.operators.customer_marts import RfmConfig
from tillwise.operators.identity import active_store, closed_store

MARTS = (
    "store_performance", "store_directory", "sales_summary", "sales_by_product", "sales_by_customer", "customer_profile",
)
KPIS = ("kpi_revenue", "kpi_orders", "kpi_customer_retention", "kpi_store", "kpi_product", "kpi_exec_summary")

# output folder of each table
DOMAINS = {
    "store_performance": "marts_store", "store_directory": "marts_store",
    "sales_summary": "marts_sales", "sales_by_product": "marts_sales", "sales_by_customer": "marts_sales",
    "customer_profile": "marts_customer", **dict.fromkeys(KPIS, "marts_kpi"),
}
# readers look these up by key
SORT_KEYS = {
    "store_performance": ("initial_store_code", "month"), "store_directory": ("initial_store_code",),
    "sales_summary": ("grain", "period"), "sales_by_product": ("month", "product_id"),
    "sales_by_customer": ("customer_id",), "customer_profile": ("customer_id",), **dict.fromkeys(KPIS, ("month",)),
}


class Layers(Mapping[str, DataFrame]):
    """Tables by name. ``base`` holds at least ``fact_sales``, ``code_history`` and ``dim_customer``.

    With ``buyer_months`` or ``customer_parts`` in it, retention or customers come from there and not from the fact.
    """

    def __init__(
        self,
        base: Mapping[str, DataFrame],
        as_of: dt.date,
        rfm: RfmConfig = RfmConfig(),
        keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
        unique_orders: bool = False,
    ):
        self._tables = dict(base)
        self._as_of = as_of
        self._rfm = rfm
        self._keep = keep
        self._unique = {"unique_orders": unique_orders}

    def _build(self, name: str) -> DataFrame:
        t = self.__getitem__
        match name:
            case "active_store":
                return active_store(t("code_history"))
            case "closed_store":
                return closed_store(t("code_history"), self._as_of)
            case "store_performance":
                return store_marts.store_performance(t("fact_sales"), t("code_history"), **self._unique)
            case "store_directory":
                return store_marts.store_directory(t("fact_sales"), t("code_history"), **self._unique)
            case "sales_summary":
                return sales_marts.sales_summary(t("fact_sales"), **self._unique)
            case "sales_by_product":
                return sales_marts.sales_by_product(t("fact_sales"), **self._unique)
            case "sales_by_customer":
                if "customer_parts" in self._tables:
                    return customer_marts.customer_value(t("customer_parts"), self._as_of, self._rfm)
                return customer_marts.sales_by_customer(t("fact_sales"), self._as_of, self._rfm, **self._unique)
            case "customer_profile":
                if "customer_parts" in self._tables:
                    lifetime = customer_marts.lifetime_of_parts(t("customer_parts"))
                    return customer_marts.profile_with_sales(t("dim_customer"), lifetime, self._as_of)
                return customer_marts.customer_profile(t("dim_customer"), t("fact_sales"), self._as_of, **self._unique)
            case "month_base":
                return kpis.month_base(t("fact_sales"), **self._unique)
            case "kpi_revenue":
                return kpis.revenue_of_months(t("month_base"))
            case "kpi_orders":
                return kpis.orders_of_months(t("month_base"))
            case "kpi_customer_retention":
                if "buyer_months" in self._tables:
                    return kpis.retention_of_months(mergeable.retention_months(t("buyer_months")))
                return kpis.kpi_customer_retention(t("fact_sales"))
            case "kpi_store":
                return kpis.kpi_store(t("store_performance"))
            case "kpi_product":
                return kpis.kpi_product(t("sales_by_product"))
            case "kpi_exec_summary":
                return kpis.kpi_exec_summary(*[t(k) for k in KPIS[:5]])
        raise KeyError(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._keep(self._build(name), name)
        return self._tables[name]

    def __contains__(self, name: object) -> bool:
        return name in self._tables or name in DOMAINS or name in ("active_store", "closed_store", "month_base")

    def __iter__(self) -> Iterator[str]:
        return iter([*self._tables, *(n for n in (*MARTS, *KPIS, "active_store", "closed_store", "month_base") if n not in self._tables)])

    def __len__(self) -> int:
        return len(list(iter(self)))
