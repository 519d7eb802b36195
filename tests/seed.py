"""Seed rows. Expectations in the tests depend on every one of them."""
import json

ORDER_FIELDS = ["order_id", "customer_id", "customer_email", "region", "channel", "order_status", "order_ts",
                "currency", "promo_codes", "city", "state", "ingested_at"]
FIRST, LATER = "2026-08-30 23:05:00", "2026-08-31 02:10:00"
ORDERS = [
    ("ORD-1001", "CUST-77", "  Ana.Silva@Example.COM ", "na", "web", "COMPLETED", "2026-08-30 14:23:11", "USD", ["SUMMER10", "FREESHIP"], "Austin", "TX", FIRST),
    ("ORD-1002", "CUST-42", "bob@shop.io", "NA", "app", "completed", "2026-08-30 09:02:44", "USD", [], "Denver", "CO", FIRST),
    ("ORD-1003", "CUST-19", "  Chen.W@mail.cn", "apac", "store", "COMPLETED", "2026-08-30 22:41:05", "SGD", ["WELCOME5"], "Singapore", "SG", FIRST),
    ("ORD-1004", "CUST-77", "Ana.Silva@example.com", "Na", None, "REFUNDED", "2026-08-30 16:10:00", "USD", ["SUMMER10"], "Austin", "TX", FIRST),
    ("ORD-1005", "CUST-88", "dana@corp.de", "emea", "web", "COMPLETED", "2026-08-30 07:55:12", "EUR", [], "Berlin", "BE", FIRST),
    ("ORD-1006", "CUST-42", "bob@shop.io ", "NA", "app", "PENDING", "2026-08-30 18:30:00", "USD", None, "Denver", "CO", FIRST),
    ("ORD-1007", "CUST-51", "eve@x.co.uk ", "EMEA", "store", "COMPLETED", "2026-08-30 11:15:33", "GBP", ["VIP20", "FREESHIP"], "London", "LDN", FIRST),
    ("ORD-1008", "CUST-19", "chen.w@MAIL.CN", "APAC", "web", "COMPLETED", "2026-08-30 03:20:00", "SGD", [], "Singapore", "SG", FIRST),
    ("ORD-1009", "CUST-63", None, "na", "app", "COMPLETED", "2026-08-30 13:47:29", "USD", ["SUMMER10"], "Miami", "FL", FIRST),
    ("ORD-1010", "CUST-88", "dana@corp.de", "emea", "web", "CANCELLED", "2026-08-30 20:05:00", "EUR", [], "Berlin", "BE", FIRST),
    ("ORD-1011", "CUST-05", "frank@nordic.se", "EMEA", "store", "COMPLETED", "2026-08-30 08:00:00", "EUR", ["WELCOME5"], "Stockholm", "ST", FIRST),
    ("ORD-1012", "CUST-51", "eve@x.co.uk", "APAC", "web", "COMPLETED", "2026-08-30 19:12:00", "SGD", [], "Singapore", "SG", FIRST),
    ("ORD-1002", "CUST-42", "bob@shop.io", "NA", "app", "REFUNDED", "2026-08-30 09:02:44", "USD", [], "Denver", "CO", LATER),
]
ITEM_FIELDS = ["order_id", "line_no", "sku", "department", "qty", "unit_price", "discount_pct"]
ITEMS = [
    ("ORD-1001", 1, "SKU-GR-088", "Grocery", 3, 4.50, 0.00),
    ("ORD-1001", 2, "SKU-EL-201", "Electronics", 1, 249.99, 0.10),
    ("ORD-1002", 1, "SKU-AP-410", "Apparel", 2, 39.00, 0.00),
    ("ORD-1003", 1, "SKU-EL-115", "Electronics", 1, 899.00, 0.05),
    ("ORD-1003", 2, "SKU-HO-007", "Home", 4, 12.25, 0.00),
    ("ORD-1004", 1, "SKU-GR-088", "Grocery", -3, 4.50, 0.00),
    ("ORD-1005", 1, "SKU-BE-330", "Beauty", 2, 18.75, 0.00),
    ("ORD-1005", 2, "SKU-AP-410", "Apparel", 1, 39.00, 0.20),
    ("ORD-1006", 1, "SKU-EL-201", "Electronics", 1, 249.99, 0.00),
    ("ORD-1007", 1, "SKU-AP-522", "Apparel", 3, 75.00, 0.15),
    ("ORD-1007", 2, "SKU-BE-330", "Beauty", 1, 18.75, 0.00),
    ("ORD-1007", 3, "SKU-HO-007", "Home", 2, 12.25, 0.00),
    ("ORD-1008", 1, "SKU-EL-115", "Electronics", 2, 899.00, 0.00),
    ("ORD-1009", 1, "SKU-GR-044", "Grocery", 5, 3.20, 0.00),
    ("ORD-1010", 1, "SKU-BE-901", "Beauty", 1, 55.00, 0.00),
    ("ORD-1011", 1, "SKU-HO-118", "Home", 1, 129.00, 0.10),
    ("ORD-1011", 2, "SKU-GR-044", "Grocery", 2, 3.20, 0.00),
    ("ORD-9999", 1, "SKU-XX-000", "Unknown", 1, 10.00, 0.00),
]


def write_raw(folder) -> tuple[str, str]:
    orders, items = folder / "orders", folder / "items"
    orders.mkdir(), items.mkdir()
    with open(orders / "a.json", "w") as fh:
        for row in ORDERS:
            r = dict(zip(ORDER_FIELDS, row))
            r["ship_address"] = {"city": r.pop("city"), "state": r.pop("state")}
            fh.write(json.dumps(r) + "\n")
    with open(items / "a.csv", "w") as fh:
        fh.write(",".join(ITEM_FIELDS) + "\n")
        fh.writelines(",".join(map(str, r)) + "\n" for r in ITEMS)
    return str(orders), str(items)
