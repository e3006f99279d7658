from datetime import date

from tallyhouse.operators import reconciliation as recon

from .conftest import d, rows


def order(id, total, status="Completed", subtotal=None):
    return {"id": id, "order_number": f"O{id}", "order_date": date(2024, 1, 1), "total_amount": d(total), "status": status,
            "subtotal": d(subtotal or total), "tax_amount": d("0.00")}


def payment(id, order_id, amount, status="Completed"):
    return {"id": id, "order_id": order_id, "amount": d(amount), "status": status, "payment_date": date(2024, 1, 2)}


def invoice(id, order_id, amount):
    return {"id": id, "order_id": order_id, "subtotal": d(amount), "tax_amount": d("0.00"), "total_amount": d(amount),
            "invoice_date": date(2024, 2, 1)}


def test_tolerance_is_exclusive(table):
    o = table("orders", order(1, "100.00"), order(2, "100.00"), order(3, "100.00"), order(4, "100.00"))
    p = table("payments", payment(1, 1, "99.00"), payment(2, 2, "98.99"), payment(3, 3, "60.00"), payment(4, 3, "40.00"),
              payment(5, 4, "100.00", "Failed"))
    found = rows(recon.recon_order_payment(o, p).select("order_number", "discrepancy"))
    assert found == [("O2", d("1.01")), ("O4", d("100.00"))]
    assert tuple(recon.recon_unpaid_orders(o, p).first()) == (1, d("100.00"))


def test_every_class_of_the_three_way_match(table):
    o = table("orders", *(order(i, "100.00") for i in range(1, 7)), order(7, "100.00", "Pending"), order(8, "100.00", "Shipped"))
    p = table(
        "payments",
        payment(1, 1, "50.00"), payment(2, 1, "50.00"),
        payment(3, 3, "90.00"),
        payment(4, 4, "110.00"),
        payment(5, 5, "100.00"),
        payment(6, 6, "100.00"),
        payment(7, 99, "7.00"), payment(8, 99, "7.00"),
        payment(9, 7, "100.00", "Pending"),
        payment(10, 8, "100.00"),
    )
    i = table("invoices", invoice(1, 1, "100.00"), invoice(2, 3, "100.00"), invoice(3, 4, "100.00"), invoice(4, 6, "103.00"),
              invoice(5, 2, "100.00"), invoice(6, 77, "1.00"))
    fact = recon.fact_reconciliation(o, p, i)
    classes = {r.order_id: r.match_class for r in fact.collect()}
    assert classes == {
        1: "MATCHED", 2: "UNPAID", 3: "UNDERPAID", 4: "OVERPAID", 5: "MISSING_INVOICE", 6: "INVOICE_MISMATCH",
        7: "UNPAID", 8: "MATCHED", 99: "PAYMENT_WITHOUT_ORDER", 77: "INVOICE_MISMATCH",
    }
    stray = fact.where("order_id = 99").first()
    assert (stray.paid_amount, stray.payment_count, stray.payment_difference) == (d("14.00"), 2, d("-14.00"))
    summary = recon.recon_class_summary(fact)
    assert sum(r["keys"] for r in summary.collect()) == fact.count() == 10


def test_material_alerts_start_above_the_limit(table):
    o = table("orders", order(1, "100000.00"), order(2, "100000.01"), order(3, "1.00"))
    p = table("payments", payment(1, 3, "1.00"))
    i = table("invoices", invoice(1, 3, "200000.00"))
    fact = recon.fact_reconciliation(o, p, i)
    assert rows(recon.recon_material_alerts(fact).select("order_id")) == [(2,), (3,)]


def test_invoices_compare_subtotal_and_tax(table):
    o = table("orders", order(1, "95.00", subtotal="100.00"), order(2, "100.00"))
    i = table("invoices", invoice(1, 1, "100.00"), invoice(2, 2, "98.00"))
    found = rows(recon.recon_order_invoice(o, i).select("order_number", "discrepancy", "total_difference"))
    assert found == [("O2", d("2.00"), d("2.00"))]


def test_discrepancies_split_by_direction(table):
    o = table("orders", order(1, "100.00"), order(2, "100.00"))
    p = table("payments", payment(1, 1, "130.00"), payment(2, 2, "90.00"))
    assert tuple(recon.recon_discrepancy_total(o, p).first())[1:] == (2, d("10.00"), d("30.00"), d("40.00"))


def test_system_totals_keep_one_sided_periods(table):
    o, p, i = table("orders", order(1, "100.00")), table("payments", payment(1, 1, "60.00")), table("invoices", invoice(1, 1, "100.00"))
    found = rows(recon.recon_system_totals(o, p, i, "day").select("period", "orders", "payments", "invoices"))
    assert found == [(date(2024, 1, 1), 1, 0, 0), (date(2024, 1, 2), 0, 1, 0), (date(2024, 2, 1), 0, 0, 1)]
    assert recon.recon_system_totals(o, p, i, "month").count() == 2


def test_status_pairs(table):
    o = table("orders", order(1, "1.00", "Pending"), order(2, "1.00", "Completed"), order(3, "1.00", "Refunded"), order(4, "1.00", "Lost"))
    p = table("payments", payment(1, 2, "1.00"), payment(2, 2, "1.00"), payment(3, 3, "1.00"))
    found = rows(recon.recon_status_consistency(o, p))
    assert found == [("Completed", "Completed", 1, True), ("Lost", "none", 1, False), ("Pending", "none", 1, True),
                     ("Refunded", "Completed", 1, False)]
    broken = recon.recon_status_violations(o, p).select("order_id", "order_status", "payment_status", "payments", "paid")
    assert rows(broken) == [(3, "Refunded", "Completed", 1, d("1.00")), (4, "Lost", "none", 0, d("0.00"))]
    unmatched = table("payments", payment(1, 2, "1.00"), payment(2, 50, "1.00"))
    assert rows(recon.recon_unmatched_payments(unmatched, o).select("id")) == [(2,)]
