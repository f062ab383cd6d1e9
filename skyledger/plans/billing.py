"""Contract queries over the billing export (the eleven lab queries)."""

from __future__ import annotations

from skyledger.operators import billing as B
from skyledger.plans.loaded import billing_table as billing
from skyledger.plans.registry import register

_TIE = "order_key, line_number, part_key, supp_key, usage_amount, usage_end_time"
_FLAT = ("billing_account_id, project_id, project_name, service_description, sku_description, "
         "country, CAST(cost AS DOUBLE) AS cost, currency, currency_conversion_rate, usage_amount, "
         "usage_unit, pricing_unit, usage_end_time")
_DETAIL = ("service_description, sku_description, country, CAST(cost AS DOUBLE) AS cost, project_id, "
           "project_name, currency, currency_conversion_rate, usage_amount, usage_unit")
_Q1 = ("billing_account_id, project_id, project_name, service_description, currency, "
       "currency_conversion_rate, CAST(cost AS DOUBLE) AS cost, usage_amount, pricing_unit")
F = ("billing",)


@register("billing_total_rows", "SELECT COUNT(*) AS total_rows FROM billing", F)
def billing_total_rows(spark, sf):
    return B.total_rows(billing(spark, sf))


@register("billing_preview", f"SELECT {_FLAT} FROM billing ORDER BY {_TIE} LIMIT 10", F)
def billing_preview(spark, sf):
    return B.preview(billing(spark, sf), 10)


@register("billing_rows_with_cost",
          "SELECT COUNT(*) AS records_with_cost FROM billing WHERE cost > 0", F)
def billing_rows_with_cost(spark, sf):
    return B.rows_with_cost(billing(spark, sf), 0)


@register("billing_sample_with_cost",
          f"SELECT {_FLAT} FROM billing WHERE cost > 0 ORDER BY {_TIE} LIMIT 10", F)
def billing_sample_with_cost(spark, sf):
    return B.sample_with_cost(billing(spark, sf), 10, 0)


@register("billing_all_records", f"SELECT {_Q1} FROM billing", F)
def billing_all_records(spark, sf):
    return B.all_records(billing(spark, sf))


@register("billing_latest_100",
          f"SELECT {_DETAIL} FROM billing WHERE cost > 0 "
          f"ORDER BY usage_end_time DESC, {_TIE} LIMIT 100", F)
def billing_latest_100(spark, sf):
    return B.latest(billing(spark, sf), 100, 0)


@register("billing_over_10", f"SELECT {_DETAIL} FROM billing WHERE cost > 10", F)
def billing_over_10(spark, sf):
    return B.over_threshold(billing(spark, sf), 10)


@register("records_by_service",
          "SELECT service_description, COUNT(*) AS billing_records FROM billing "
          "GROUP BY service_description ORDER BY billing_records DESC, service_description", F)
def records_by_service(spark, sf):
    return B.records_by(billing(spark, sf), "service.description")


@register("records_by_service_over_1",
          "SELECT service_description, COUNT(*) AS billing_records FROM billing WHERE cost > 1 "
          "GROUP BY service_description ORDER BY billing_records DESC, service_description", F)
def records_by_service_over_1(spark, sf):
    return B.records_by(billing(spark, sf), "service.description", 1)


@register("records_by_unit",
          "SELECT usage_unit, COUNT(*) AS billing_records FROM billing WHERE cost > 0 "
          "GROUP BY usage_unit ORDER BY billing_records DESC, usage_unit", F)
def records_by_unit(spark, sf):
    return B.records_by(billing(spark, sf), "usage.unit", 0)


_COST_BY_SERVICE = ("SELECT service_description, CAST(ROUND(SUM(cost), 2) AS DOUBLE) AS total_cost "
                    "FROM billing GROUP BY service_description")


@register("cost_by_service", _COST_BY_SERVICE + " ORDER BY total_cost DESC, service_description", F)
def cost_by_service(spark, sf):
    return B.cost_by_service(billing(spark, sf))


@register("top_service_by_cost",
          f"SELECT * FROM ({_COST_BY_SERVICE}) ORDER BY total_cost DESC, service_description LIMIT 1", F)
def top_service_by_cost(spark, sf):
    return B.top_service_by_cost(billing(spark, sf))


def _top1_sql(inner: str, value: str, key: str) -> str:
    return f"SELECT * FROM ({inner}) ORDER BY {value} DESC, {key} LIMIT 1"


_BY_SERVICE = ("SELECT service_description, COUNT(*) AS billing_records FROM billing{where} "
               "GROUP BY service_description")


@register("top_service_by_records",
          _top1_sql(_BY_SERVICE.format(where=""), "billing_records", "service_description"), F)
def top_service_by_records(spark, sf):
    return B.top1(B.records_by(billing(spark, sf), "service.description"),
                  "billing_records", "service_description")


@register("top_service_over_1",
          _top1_sql(_BY_SERVICE.format(where=" WHERE cost > 1"), "billing_records", "service_description"), F)
def top_service_over_1(spark, sf):
    return B.top1(B.records_by(billing(spark, sf), "service.description", 1),
                  "billing_records", "service_description")


@register("top_unit_with_cost",
          _top1_sql("SELECT usage_unit, COUNT(*) AS billing_records FROM billing WHERE cost > 0 "
                    "GROUP BY usage_unit", "billing_records", "usage_unit"), F)
def top_unit_with_cost(spark, sf):
    return B.top1(B.records_by(billing(spark, sf), "usage.unit", 0), "billing_records", "usage_unit")
