"""Feature job against a row-by-row Python restatement of the rules."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tillmart.operators import features as ft
from tillmart.operators.mart import FEATURES_KEY
from tillmart.plans import sample

AS_OF = datetime(2026, 3, 8, 12)
GROUPS = ["молочные продукты", "фрукты и ягоды", "овощи и зелень", "мясо рыба яйца и бобовые",
          "зерновые и хлебобулочные изделия", "unknown", "рыба", None]

SCHEMAS = {
    "purchases": "purchase_id string, customer_id string, store_id string, purchase_date_sk int, "
                 "payment_method string, total_amount decimal(12,2), is_delivery int, items_count int, "
                 "raw_event_time timestamp_ntz",
    "items": "purchase_id string, product_id string",
    "products": "product_id string, product_group string, is_organic int",
    "stores": "store_id string, store_location_sk bigint",
    "dates": "date_sk int, is_weekend int",
    "customers": "customer_id string, customer_sk bigint, registration_date timestamp_ntz, "
                 "is_loyalty_member int",
}


def frames(spark, data):
    return {n: spark.createDataFrame(data[n], SCHEMAS[n]) for n in SCHEMAS}


def date_key(t):
    return int(f"{t:%Y%m%d}")


def random_data(seed, lines_per_purchase=None):
    rng = random.Random(seed)
    customers = [(f"c{i}", i, rng.choice([None, AS_OF - timedelta(days=rng.choice([0, 29, 30, 31, 400]))]),
                  rng.choice([0, 1, None])) for i in range(30)]
    products = [(f"p{i}", GROUPS[i % len(GROUPS)], rng.choice([0, 1, None])) for i in range(24)]
    stores = [(f"s{i}", rng.choice([1, 2, 3, None])) for i in range(5)]
    purchases, items = [], []
    for i in range(400):
        # A third of all purchases belongs to one customer.
        owner = "c0" if i % 3 == 0 else f"c{rng.randrange(26)}" if i % 50 else "stranger"
        when = AS_OF - timedelta(days=rng.choice([-1, 0, 6, 7, 8, 13, 14, 15, 29, 30, 31, 89, 90, 91]),
                                 hours=rng.randrange(24))
        purchases.append((
            f"o{i}", owner, rng.choice(["s0", "s1", "s2", "s9", "s4"]), date_key(when),
            rng.choice(["cash", "card", "online"]),
            rng.choice([None, Decimal(rng.randrange(0, 300000)) / 100]), rng.choice([0, 1]),
            rng.choice([1, 1, 3, 4, 6]), when,
        ))
        count = rng.choice([0, 1, 2, 5]) if lines_per_purchase is None else lines_per_purchase
        items += [(f"o{i}", f"p{rng.randrange(26)}") for _ in range(count)]
    days = {p[3]: p[8] for p in purchases}
    dates = [(k, int(t.isoweekday() >= 6)) for k, t in days.items() if k % 7]
    return {"purchases": purchases, "items": items, "products": products, "stores": stores,
            "dates": dates, "customers": customers}


def brute_force(data, grain, s=ft.DEFAULTS):
    products = {p[0]: p for p in data["products"]}
    stores = dict(data["stores"])
    weekend = dict(data["dates"])
    lines = {}
    for purchase, product in data["items"]:
        lines.setdefault(purchase, []).append(products.get(product, (product, None, None)))
    result = {}
    for customer, sk, registered, loyal in data["customers"]:
        mine = [p for p in data["purchases"] if p[1] == customer]
        full = [(p, line) for p in mine for line in lines.get(p[0], [None])]
        headers = [p for p, _ in full] if grain == "item" else mine

        def age(t):
            return (AS_OF.date() - t.date()).days

        def count(rule):
            return sum(1 for p in headers if rule(p))

        def cat(stems, days=None):
            return sum(1 for p, line in full if line and line[1]
                       and any(x in line[1] for x in stems)
                       and (days is None or age(p[8]) <= days))

        n = len({p[0] for p in mine})
        rows = len(headers)
        amounts = [p[5] for p in headers if p[5] is not None]
        spent = sum(amounts) if amounts else None
        cart = (spent / len(amounts)).quantize(Decimal("0.000001"), ROUND_HALF_UP) if amounts else None
        mean_items = sum(p[7] for p in headers) / rows if rows else 0
        wk = [weekend.get(p[3]) for p in headers]
        wk = sum(w for w in wk if w is not None)
        last = max((p[8] for p in mine), default=None)
        locations = {stores.get(p[2]) for p in mine} - {None}
        groups = {line[1] for _, line in full if line} - {None}
        week = sum(p[5] for p in headers if p[5] is not None and age(p[8]) <= s.week_days)
        none = not mine
        flags = {
            "bought_milk_last_30d": None if none else cat(s.dairy, 30) > 0,
            "bought_fruits_last_14d": None if none else cat(s.fruit, 14) > 0,
            "not_bought_veggies_14d": cat(s.veggie, 14) == 0,
            "recurrent_buyer": count(lambda p: age(p[8]) <= 30) > 2,
            "inactive_14_30": None if none else 14 <= age(last) <= 30,
            "new_customer": None if registered is None else age(registered) <= 30,
            "delivery_user": count(lambda p: p[6]) > 0,
            "organic_preference": sum(1 for _, line in full if line and line[2]) > 0,
            "bulk_buyer": (cart or 0) > 1000,
            "low_cost_buyer": (cart or 0) < 200,
            "buys_bakery": cat(s.bakery) > 0,
            "loyal_customer": (None if n >= 3 else False) if loyal is None else loyal == 1 and n >= 3,
            "multicity_buyer": len(locations) > 1,
            "bought_meat_last_week": cat(s.meat, 7) > 0,
            "night_shopper": count(lambda p: p[8].hour >= 20) > 0,
            "morning_shopper": count(lambda p: p[8].hour < 10) > 0,
            "prefers_cash": count(lambda p: p[4] == "cash") / max(n, 1) >= 0.7,
            "prefers_card": count(lambda p: p[4] == "card") / max(n, 1) >= 0.7,
            "weekend_shopper": wk / max(rows, 1) >= 0.6,
            "weekday_shopper": (rows - wk) / max(rows, 1) >= 0.6,
            "single_item_buyer": count(lambda p: p[7] == 1) / max(n, 1) >= 0.5,
            "varied_shopper": len(groups) >= 4,
            "store_loyal": len({p[2] for p in mine}) == 1,
            "switching_store": len({p[2] for p in mine}) > 1,
            "family_shopper": mean_items >= 4,
            "early_bird": count(lambda p: 12 <= p[8].hour < 15) > 0,
            "no_purchases": n == 0,
            "recent_high_spender": week > 2000,
            "fruit_lover": cat(s.fruit, 30) >= 3,
            "vegetarian_profile": cat(s.meat, 90) == 0 and n > 0,
        }
        values = [None if flags[f] is None else int(flags[f]) for f in ft.FLAGS]
        result[customer] = (sk, *values, None if none else n, spent, cart)
    return result


def computed(df):
    return {r.customer_id: (r.customer_sk, *[r[f] for f in ft.FLAGS], *[r[t] for t in ft.TOTALS])
            for r in df.collect()}


@pytest.mark.parametrize("grain", ["item", "purchase"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, grain, seed):
    data = random_data(seed)
    got = computed(ft.customer_features(frames(spark, data), AS_OF, grain))
    want = brute_force(data, grain)
    assert got.keys() == want.keys()
    for customer, row in want.items():
        names = ("customer_sk", *ft.FLAGS, *ft.TOTALS)
        different = {n: (a, b) for n, a, b in zip(names, got[customer], row, strict=True) if a != b}
        assert not different, customer


def one_customer(spark, purchases, lines=(), registered=None, loyal=1, settings=ft.DEFAULTS, grain="purchase"):
    """Flags of one customer; purchases are dicts over sensible defaults."""
    rows = []
    for i, p in enumerate(purchases):
        when = p.get("when", AS_OF)
        rows.append((f"o{i}", "c", p.get("store", "s0"), date_key(when), p.get("pay", "cash"),
                     Decimal(p.get("amount", "500")), p.get("delivery", 0), p.get("items", 2), when))
    data = {
        "purchases": rows,
        "items": [(f"o{i}", product) for i, product in lines],
        "products": [(f"p{i}", g, 0) for i, g in enumerate(GROUPS)],
        "stores": [("s0", 1), ("s1", 1), ("s2", 2)],
        "dates": [(r[3], int(r[8].isoweekday() >= 6)) for r in {r[3]: r for r in rows}.values()],
        "customers": [("c", 1, registered, loyal)],
    }
    return ft.customer_features(frames(spark, data), AS_OF, grain, settings).first()


def ago(days, hour=12):
    return (AS_OF - timedelta(days=days)).replace(hour=hour)


def test_day_edges(spark):
    fresh = one_customer(spark, [{"when": ago(30)}], [(0, "p0"), (0, "p1")])
    assert fresh.bought_milk_last_30d == 1 and fresh.inactive_14_30 == 1 and fresh.bought_fruits_last_14d == 0
    stale = one_customer(spark, [{"when": ago(31)}], [(0, "p0")])
    assert stale.bought_milk_last_30d == 0 and stale.inactive_14_30 == 0
    assert one_customer(spark, [{"when": ago(14)}], [(0, "p1")]).bought_fruits_last_14d == 1
    assert one_customer(spark, [{"when": ago(13)}]).inactive_14_30 == 0
    assert one_customer(spark, [{"when": ago(7)}], [(0, "p3")]).bought_meat_last_week == 1
    assert one_customer(spark, [{"when": ago(8)}], [(0, "p3")]).bought_meat_last_week == 0
    assert one_customer(spark, [{"when": ago(90)}], [(0, "p3")]).vegetarian_profile == 0
    assert one_customer(spark, [{"when": ago(91)}], [(0, "p3")]).vegetarian_profile == 1
    assert one_customer(spark, [{"when": ago(0)}], registered=ago(30)).new_customer == 1
    assert one_customer(spark, [{"when": ago(0)}], registered=ago(31)).new_customer == 0


def test_hour_and_amount_edges(spark):
    hours = {h: one_customer(spark, [{"when": ago(1, h)}]) for h in (9, 10, 11, 12, 14, 15, 19, 20)}
    assert [h for h, r in hours.items() if r.morning_shopper] == [9]
    assert [h for h, r in hours.items() if r.early_bird] == [12, 14]
    assert [h for h, r in hours.items() if r.night_shopper] == [20]
    exact = one_customer(spark, [{"amount": "1000"}, {"amount": "1000"}])
    assert exact.bulk_buyer == 0 and exact.recent_high_spender == 0
    above = one_customer(spark, [{"amount": "1000"}, {"amount": "1000.01"}])
    assert above.bulk_buyer == 1 and above.recent_high_spender == 1
    assert one_customer(spark, [{"amount": "200"}]).low_cost_buyer == 0
    assert one_customer(spark, [{"amount": "199.99"}]).low_cost_buyer == 1


def test_share_edges(spark):
    seven = [{"pay": "cash"}] * 7 + [{"pay": "card"}] * 3
    row = one_customer(spark, seven)
    assert row.prefers_cash == 1 and row.prefers_card == 0
    assert one_customer(spark, seven[1:] + [{"pay": "card"}]).prefers_cash == 0
    half = one_customer(spark, [{"items": 1}, {"items": 7}])
    assert half.single_item_buyer == 1 and half.family_shopper == 1
    saturday, monday = datetime(2026, 3, 7, 12), datetime(2026, 3, 2, 12)
    row = one_customer(spark, [{"when": saturday}] * 3 + [{"when": monday}] * 2)
    assert row.weekend_shopper == 1 and row.weekday_shopper == 0
    assert one_customer(spark, [{"store": "s0"}, {"store": "s1"}]).multicity_buyer == 0
    moved = one_customer(spark, [{"store": "s0"}, {"store": "s2"}])
    assert moved.multicity_buyer == 1 and moved.switching_store == 1 and moved.store_loyal == 0
    assert one_customer(spark, [{}] * 3).loyal_customer == 1
    assert one_customer(spark, [{}] * 2).loyal_customer == 0


def test_customer_without_purchases(spark):
    row = one_customer(spark, [], registered=None)
    assert row.no_purchases == 1 and row.low_cost_buyer == 1 and row.not_bought_veggies_14d == 1
    nulls = {f for f in ft.FLAGS if row[f] is None}
    assert nulls == {"bought_milk_last_30d", "bought_fruits_last_14d", "inactive_14_30", "new_customer"}
    assert row.total_purchases is None and row.total_spent is None
    filled = ft.customer_features(frames(spark, random_data(4)), AS_OF, null_as_zero=True)
    assert filled.where(" or ".join(f"{f} is null" for f in ft.FLAGS)).count() == 0


def test_future_events_and_past_only(spark):
    later = [{"when": AS_OF + timedelta(days=3), "amount": "5000"}]
    assert one_customer(spark, later).recent_high_spender == 1
    strict = replace(ft.DEFAULTS, past_only=True)
    assert one_customer(spark, later, settings=strict).recent_high_spender == 0


def test_item_grain_repeats_headers_per_line(spark):
    purchases = [{"amount": "100", "pay": "cash"}, {"amount": "400", "pay": "card"}]
    lines = [(0, "p0"), (0, "p1"), (0, "p2")]
    item = one_customer(spark, purchases, lines, grain="item")
    assert (item.total_purchases, item.total_spent) == (2, Decimal("700.00"))
    assert item.avg_cart_amount == Decimal("175.000000") and item.prefers_cash == 1
    purchase = one_customer(spark, purchases, lines)
    assert (purchase.total_purchases, purchase.total_spent) == (2, Decimal("500.00"))
    assert purchase.avg_cart_amount == Decimal("250.000000") and purchase.prefers_cash == 0


def test_grains_agree_with_one_line_per_purchase(spark):
    tables = frames(spark, random_data(5, lines_per_purchase=1))
    assert computed(ft.customer_features(tables, AS_OF, "item")) == computed(
        ft.customer_features(tables, AS_OF, "purchase"))


def test_row_order_and_partitions_do_not_matter(spark):
    tables = frames(spark, random_data(6))
    shuffled = {n: df.repartition(5).orderBy(F.rand(1)) for n, df in tables.items()}
    assert computed(ft.customer_features(tables, AS_OF)) == computed(
        ft.customer_features(shuffled, AS_OF))


def test_unknown_grain(spark):
    with pytest.raises(ValueError):
        ft.customer_metrics(frames(spark, random_data(1)), AS_OF, "line")


def test_result_columns(spark):
    df = ft.customer_features(frames(spark, random_data(1)), AS_OF)
    assert len(ft.FLAGS) == 30
    assert df.columns == [*reversed(FEATURES_KEY), *ft.FLAGS, *ft.TOTALS, "created_at"]


def test_reports(spark):
    df = ft.customer_features(frames(spark, random_data(1)), AS_OF)
    top = ft.top_customers(df, 3).collect()
    assert len(top) == 3 and top[0].total_spent >= top[1].total_spent >= top[2].total_spent
    kpis = ft.feature_kpis(df).first()
    assert kpis.customers == 30 and 0 <= kpis.loyal_share <= 1
    shares = {r.feature: r for r in ft.flag_totals(df).collect()}
    assert shares["no_purchases"].customers_known == 30
    assert shares["no_purchases"].customers_set == df.where("no_purchases = 1").count()


def test_plan_has_no_expand_no_python_and_combines_before_shuffles(spark):
    plan = plan_of(ft.customer_features(frames(spark, random_data(1)), AS_OF))
    for bad in ("Expand", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
        assert bad not in plan
    assert "partial_sum" in plan


def test_customers_without_purchases_and_unknown_buyers_occur(spark, sample_dir):
    from tillmart.plans.queries import QUERIES

    plain = QUERIES["customer_features_item_grain"].run(spark, sample_dir).collect()
    zero = QUERIES["customer_features_null_as_zero"].run(spark, sample_dir).collect()
    assert sum(r.no_purchases for r in plain) > 0
    assert any(r.bought_milk_last_30d is None for r in plain)
    assert all(r.bought_milk_last_30d is not None for r in zero)
    known = {r.customer_id for r in plain}
    buyers = {r.customer_id for r in sample.mart_tables(spark, sample_dir)["purchases"].select("customer_id").collect()}
    assert buyers - known and known - buyers
