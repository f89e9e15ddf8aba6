"""A small shop as change events: the same at every call, drawn by a fixed random sequence."""

import random
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from chronomart.schemas import ENVELOPE

BASE = "2026-08-01T08:00:00+00:00"

PRICES = [round(4.99 + 7.35 * n, 2) for n in range(30)]
STATES = ["pending", "shipped", "delivered", "cancelled"]
DAYS = 17


class Log:
    def __init__(self):
        self.rows = []

    def add(self, table, operation, before, after, captured_at=BASE):
        def text(image):
            return None if image is None else {k: None if v is None else str(v) for k, v in image.items()}

        self.rows.append((table, operation, text(before), text(after), captured_at, len(self.rows) + 1))
        return self

    def insert(self, table, image, captured_at=BASE):
        return self.add(table, "insert", None, image, captured_at)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, ENVELOPE)


def customer(i, **changes):
    image = {
        "customer_id": i, "name": f"Customer {i}", "email": f"user{i}@example.com", "address": f"{i} First Street",
        "created_at": BASE, "updated_at": BASE,
    }
    return image | changes


def product(i, **changes):
    return {
        "product_id": i, "name": f"Product {i}", "category": "Goods", "price": PRICES[i - 1], "updated_at": BASE,
    } | changes


def order(i, customer_id, date, status, total):
    return {"order_id": i, "customer_id": customer_id, "order_date": date, "status": status, "total_amount": total}


def item(i, order_id, product_id, quantity):
    return {
        "order_item_id": i, "order_id": order_id, "product_id": product_id, "quantity": quantity,
        "unit_price": PRICES[product_id - 1],
    }


def _orders():
    """100 orders, five or six a day: (id, customer, time, state, [(product, units), (product, units)])."""
    draw = random.Random(2026)
    for i in range(1, 101):
        at = datetime(2026, 8, 1) + timedelta(days=(i - 1) * DAYS // 100, minutes=draw.randrange(24 * 60))
        lines = [(p, draw.randint(1, 4)) for p in draw.sample(range(1, 31), 2)]
        yield i, draw.randint(1, 50), at, draw.choice(STATES), lines


def _cents(lines):
    return sum(round(PRICES[p - 1] * 100) * n for p, n in lines)


def seed() -> Log:
    log = Log()
    for i in range(1, 51):
        log.insert("customers", customer(i))
    for i in range(1, 31):
        log.insert("products", product(i))
        log.insert("inventory", {"product_id": i, "warehouse_id": f"W{i % 3}", "stock_level": 20 * i, "updated_at": BASE})
    for i, buyer, at, state, lines in _orders():
        stamp = at.isoformat() + "+00:00"
        log.insert("orders", order(i, buyer, stamp, state, _cents(lines) / 100), stamp)
        for n, (p, units) in enumerate(lines):
            log.insert("order_items", item(2 * i - 1 + n, i, p, units), stamp)
    return log


def orders():
    """(id, customer, time, state, cents, units) of the seed's orders."""
    return [(i, buyer, at, state, _cents(lines), sum(n for _, n in lines)) for i, buyer, at, state, lines in _orders()]


def half_up(a, b):
    return (2 * a + b) // (2 * b) if b else 0


def daily_rows():
    """The daily mart of the seed, added up order by order."""
    days = {}
    for _, _, at, state, cents, units in orders():
        days.setdefault(at.date(), []).append((state, cents, units))
    out = []
    for day, own in days.items():
        sold = [c for state, c, _ in own if state != "cancelled"]
        count = {state: sum(o[0] == state for o in own) for state in STATES}
        out.append((
            str(day), len(own), sum(sold) / 100, sum(c for state, c, _ in own if state == "delivered") / 100,
            count["delivered"], count["shipped"], count["pending"], count["cancelled"],
            half_up(sum(sold), len(sold)) / 100, sum(u for _, _, u in own), half_up(count["cancelled"] * 10000, len(own)) / 100,
        ))
    return sorted(out)
