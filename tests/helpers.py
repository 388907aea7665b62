"""Literal point-of-sale rows and plan inspection."""

import datetime
import random

from shelfwise.schemas import POS, SKUS, STORES

DAY = datetime.date(2024, 1, 1)


def day(n):
    return DAY + datetime.timedelta(days=n)


def sale(store, sku, n, qty, stock=10, price=1.0):
    return (store, sku, day(n), qty, price, stock)


def pos_frame(spark, rows):
    return spark.createDataFrame(rows, POS)


def dims(spark, stores=(1, 2), skus=(1, 2)):
    return (
        spark.createDataFrame([(s, f"store {s}", "north", "N1") for s in stores], STORES),
        spark.createDataFrame([(k, f"sku {k}", "dairy", 2.5) for k in skus], SKUS),
    )


def random_sales(seed, n=600, stores=4, skus=5, days=40):
    pick = random.Random(seed)
    return [
        sale(pick.randrange(stores), pick.randrange(skus), pick.randrange(days),
             pick.choice([0, 0, pick.randrange(60)]), pick.choice([0, pick.randrange(120)]),
             float(pick.randrange(1, 9)))
        for _ in range(n)
    ]


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute_signals(sales):
    """Signals of every cell in plain Python: the rule, written as directly as possible."""
    cells = {}
    for store, sku, date, qty, price, stock in sales:
        row = (qty, price, stock)
        key = (store, sku, date)
        cells[key] = min(cells.get(key, row), row)
    out = {}
    for store, sku in {k[:2] for k in cells}:
        dates = sorted(d for s, k, d in cells if (s, k) == (store, sku))
        sold = [cells[store, sku, d][0] for d in dates]
        for i, date in enumerate(dates):
            short = sold[max(0, i - 6): i + 1]
            long = sold[max(0, i - 13): i + 1]
            demand = sum(short) / len(short)
            stock = cells[store, sku, date][2]
            ratio = stock / demand if demand else None
            status = "OK"
            if ratio is not None and ratio < 7:
                status = "REORDER NOW" if ratio < 3 else "WATCH"
            out[store, sku, date] = (stock, demand, sum(long) / len(long), ratio, status)
    return out
