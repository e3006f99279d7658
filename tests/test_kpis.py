from datetime import date
from decimal import Decimal

import pytest

from tallyhouse.operators import kpis

from .conftest import d, rows


def order(id, customer, day, total="100.00", status="Completed", channel="Website", discount="0.00"):
    return {"id": id, "customer_id": customer, "order_date": date.fromisoformat(day), "total_amount": d(total),
            "status": status, "channel": channel, "discount_amount": d(discount)}


def test_ltv_and_monthly_revenue_count_completed_only(table):
    o = table("orders", order(1, 1, "2024-01-05"), order(2, 1, "2024-01-31", "50.00"), order(3, 1, "2024-02-01", status="Shipped"))
    assert rows(kpis.kpi_customer_ltv(o)) == [(1, d("150.00"))]
    assert rows(kpis.kpi_monthly_revenue(o)) == [(date(2024, 1, 1), 2, d("150.00"))]


def test_periods_start_on_monday_and_reject_unknown_grains(table):
    o = table("orders", order(1, 1, "2024-01-07"), order(2, 1, "2024-01-08"), order(3, 1, "2024-01-08", status="Cancelled"))
    assert rows(kpis.kpi_revenue_by_period(o, "week")) == [(date(2024, 1, 1), 1, d("100.00")), (date(2024, 1, 8), 1, d("100.00"))]
    assert len(rows(kpis.kpi_revenue_by_channel(o, "day"))) == 2
    with pytest.raises(ValueError):
        kpis.kpi_revenue_by_period(o, "hour")


def test_growth_fills_months_without_revenue(table):
    o = table("orders", order(1, 1, "2023-01-10", "100.00"), order(2, 1, "2023-03-10", "50.00"), order(3, 1, "2024-01-10", "120.00"))
    by_month = {r.month: r for r in kpis.kpi_revenue_growth(o).collect()}
    assert len(by_month) == 13
    assert by_month[date(2023, 2, 1)].revenue == d("0.00") and by_month[date(2023, 2, 1)].mom_percent == -100.0
    assert by_month[date(2023, 3, 1)].mom_percent is None  # from zero
    assert by_month[date(2024, 1, 1)].yoy_percent == 20.0
    assert by_month[date(2023, 1, 1)].previous_month is None


def test_net_revenue_takes_refunds_of_known_orders_once(table):
    o = table("orders", order(1, 1, "2024-01-01", discount="10.00"), order(2, 1, "2024-01-01", status="Refunded"))
    p = table("payments", {"id": 1, "order_id": 2, "amount": d("40.00"), "status": "Refunded"},
              {"id": 2, "order_id": 2, "amount": d("20.00"), "status": "Refunded"},
              {"id": 3, "order_id": 9, "amount": d("5.00"), "status": "Refunded"})
    assert kpis.kpi_net_revenue(o, p).first().net_revenue == d("130.00")
    assert kpis.kpi_gross_revenue(o).first().gross_revenue == d("100.00")
    assert tuple(kpis.kpi_aov(o).first()) == (d("100.00"), 1, 100.0)


def test_margin_leaves_out_unknown_costs_and_counts_them(table):
    items = table("order_items", {"id": 1, "product_id": 1, "quantity": 2, "line_total": d("100.00")},
                  {"id": 2, "product_id": 2, "quantity": 1, "line_total": d("70.00")},
                  {"id": 3, "product_id": 2, "quantity": 1, "line_total": d("70.00")})
    products = table("products", {"id": 1, "category_id": 1, "cost_price": d("30.00")}, {"id": 2, "category_id": 1, "cost_price": None})
    categories = table("categories", {"id": 1, "name": "Home"})
    found = kpis.kpi_gross_margin_by_category(items, products, categories).where("category_id IS NOT NULL").first()
    assert (found.revenue, found.cost, found.margin_percent, found.lines_without_cost) == (d("100.00"), d("60.00"), 40.0, 2)


def test_customer_rates(table):
    customers = table("customers", {"id": 1, "is_active": True, "segment": "VIP"}, {"id": 2, "is_active": True, "segment": "VIP"},
                      {"id": 3, "is_active": True, "segment": None}, {"id": 4, "is_active": False, "segment": "New"})
    o = table("orders", order(1, 1, "2024-01-01"), order(2, 1, "2024-03-02"), order(3, 2, "2024-03-01"), order(4, 4, "2024-03-01"))
    assert tuple(kpis.kpi_repeat_rate(customers, o).first()) == (1, 4, 0.25)
    # 90 days before 2024-05-31 is 2024-03-02: bought that day is not churned, the day before is.
    assert tuple(kpis.kpi_churn_rate(customers, o, date(2024, 5, 31)).first()) == (2, 3, 2 / 3)
    shares = {r.segment: r.share for r in kpis.kpi_segment_distribution(customers).collect()}
    assert shares == {"VIP": 0.5, None: 0.25, "New": 0.25}


def test_churn_risk_uses_the_mean_gap(table):
    customers = table("customers", *({"id": i} for i in (1, 2, 3, 4)))
    o = table("orders", order(1, 1, "2024-01-01"), order(2, 1, "2024-01-11"), order(3, 1, "2024-01-21"),
              order(4, 2, "2024-01-26"), order(5, 3, "2024-01-01"), order(6, 3, "2024-01-01"))
    found = {r.customer_id: r for r in kpis.kpi_churn_risk(customers, o, date(2024, 1, 31)).collect()}
    assert (found[1].mean_gap_days, found[1].risk_score, found[1].risk_band) == (10.0, 1.0, "Medium")
    assert (found[2].mean_gap_days, found[2].risk_band) == (None, "Low")
    assert (found[3].mean_gap_days, found[3].risk_score) == (0.0, 30 / 90)
    assert (found[4].orders, found[4].risk_band) == (0, "No purchase")


def test_clv_is_spend_per_active_month_times_lifespan(table):
    o = table("orders", order(1, 1, "2024-01-31", "100.00"), order(2, 1, "2024-03-01", "50.00"), order(3, 2, "2024-01-01", "10.00"))
    found = {r.customer_id: r for r in kpis.kpi_clv(o, 24).collect()}
    assert (found[1].active_months, found[1].clv, found[1].avg_order_value) == (3, d("1200.00"), 75.0)
    assert found[2].clv == d("240.00")
    assert kpis.kpi_average_clv(o, 24).first().avg_clv == 720.0


def test_cac_without_new_customers_is_null(spark, table):
    spend = spark.createDataFrame([(date(2024, 1, 1), Decimal("90.00")), (date(2024, 2, 1), Decimal("10.00"))], "month DATE, spend DECIMAL(15,2)")
    customers = table("customers", *({"id": i, "registration_date": date(2024, 1, i)} for i in (1, 2, 3)))
    assert rows(kpis.kpi_cac(spend, customers).select("month", "new_customers", "cac")) == [(date(2024, 1, 1), 3, 30.0), (date(2024, 2, 1), 0, None)]


def test_status_distribution_and_top_products(table):
    o = table("orders", order(1, 1, "2024-01-01"), order(2, 1, "2024-01-01"), order(3, 1, "2024-01-01", status="Pending"))
    assert {r.status: r.share for r in kpis.kpi_order_status_distribution(o).collect()} == {"Completed": 2 / 3, "Pending": 1 / 3}
    items = table("order_items", {"id": 1, "product_id": 1, "quantity": 3, "line_total": d("3.00")},
                  {"id": 2, "product_id": 2, "quantity": 3, "line_total": d("9.00")})
    products = table("products", {"id": 1, "sku": "A"}, {"id": 2, "sku": "B"})
    assert [r.sku for r in kpis.kpi_top_products(items, products, 1).collect()] == ["A"]
    assert [r.sku for r in kpis.kpi_top_products(items, products, 1, "revenue").collect()] == ["B"]
