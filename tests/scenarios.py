"""Four weeks of one kitchen's exports, small enough to work every outcome out by hand.

Each day has one plain order per channel. CASES lists, entry by entry, the orders that are
not plain. A week's entries are paid on the Wednesday after it; two payouts differ from the
ledger, one at each edge of the window.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator
from datetime import date, datetime, time, timedelta
from decimal import Decimal
from pathlib import Path
from typing import NamedTuple

from quittance.sources import specs

OPENS, DAYS = date(2024, 3, 4), 28  # a Monday
IDENTITY = {
    "Business ID": "5310",
    "Business name": "Quay Kitchen",
    "Store ID": "41",
    "Store name": "Quay Kitchen - Dock 4",
    "Merchant store ID": "NULL",
}
ADDRESS = "4 Lower Dock"

#: Amounts of an order of 1.00 beside its subtotal: one channel takes commission, the other a fee.
RATES = {"Marketplace": ("Commission", Decimal("-0.20")), "Storefront": ("Payment processing fee", Decimal("-0.04"))}
PLAIN = {"Marketplace": (time(12, 15), Decimal("14.20")), "Storefront": (time(18, 30), Decimal("9.50"))}


class Entry(NamedTuple):
    order: str
    channel: str
    at: datetime
    kind: str
    amount: Decimal
    text: str = "NULL"


# day since OPENS, clock, kind, amount, description; all on the marketplace
CASES = {
    "rebooked": [(2, "18:00", "Order", "40.00"), (2, "18:25", "Order", "-40.00"), (2, "18:40", "Order", "36.50")],
    "cancelled": [(9, "12:00", "Order", "22.00"), (9, "12:10", "Order", "-22.00")],
    "paid back in days": [
        (3, "19:00", "Order", "25.00"),
        (4, "09:00", "Error Charge", "-6.20", "Missing drink"),
        (6, "09:00", "Adjustment", "6.20"),
    ],
    "paid back in a week": [
        (10, "20:00", "Order", "48.00"),
        (11, "08:00", "Error Charge", "-12.00", "Wrong dish"),
        (16, "07:00", "Adjustment", "12.00"),
    ],
    "paid back in two weeks": [
        (5, "13:00", "Order", "30.00"),
        (6, "10:00", "Error Charge", "-7.50", "Poor food quality"),
        (16, "10:00", "Adjustment", "7.50"),
    ],
    "paid back late": [
        (1, "13:00", "Order", "16.00"),
        (2, "10:00", "Error Charge", "-4.00", "2 items missing"),
        (19, "10:00", "Adjustment", "4.00"),
    ],
    "never paid back": [(12, "19:30", "Order", "35.20"), (13, "11:00", "Error Charge", "-8.80", "Incorrect order")],
    "paid back in part": [
        (7, "19:30", "Order", "12.00"),
        (8, "11:00", "Error Charge", "-3.00", "Courier was late"),
        (10, "11:00", "Adjustment", "2.00"),
    ],
    "paid back twice": [
        (14, "12:30", "Order", "20.00"),
        (15, "11:00", "Error Charge", "-5.00", "Missing sauce"),
        (16, "11:00", "Adjustment", "5.00"),
        (17, "11:00", "Adjustment", "5.00"),
    ],
}


def entries() -> Iterator[Entry]:
    for n in range(DAYS):
        day = OPENS + timedelta(days=n)
        for channel, (clock, price) in PLAIN.items():
            yield Entry(f"{channel} {day}", channel, datetime.combine(day, clock), "Order", price)
    for order, told in CASES.items():
        for n, clock, kind, amount, *text in told:
            at = datetime.combine(OPENS + timedelta(days=n), time.fromisoformat(clock))
            yield Entry(order, "Marketplace", at, kind, Decimal(amount), *text)


def payday(at: datetime) -> date:
    week = (at.date() - OPENS).days // 7
    return OPENS + timedelta(days=7 * (week + 1) + 2)


def amounts(entry: Entry) -> dict[str, Decimal]:
    if entry.kind != "Order":
        return {"Error charges" if entry.kind == "Error Charge" else "Adjustments": entry.amount}
    fee, rate = RATES[entry.channel]
    return {"Subtotal": entry.amount, fee: entry.amount * rate}


def _row(export: specs.Export, **cells: object) -> dict[str, str]:
    """A row of ``export``: zeros for amounts and counts, NULL elsewhere, then ``cells``."""
    zero = {"amount": "0.00", "count": "0"}
    return {c.heading: zero.get(c.cast, "NULL") for c in export.columns} | {k: str(v) for k, v in cells.items()}


def _money(found: dict[str, Decimal]) -> dict[str, str]:
    return {name: f"{value:.2f}" for name, value in found.items()}


def _transaction(number: int, entry: Entry) -> dict[str, str]:
    about = {
        "DoorDash transaction ID": f"T{number:04}",
        "DoorDash order ID": entry.order,
        "Delivery UUID": "NULL" if entry.kind == "Order" else f"delivery of {entry.order}",
        "Transaction type": entry.kind,
        "Channel": entry.channel,
        "Final order status": "Delivered",
        "Description": entry.text,
        "Timestamp local time": entry.at,
        "Timestamp local date": entry.at.date(),
        "Payout date": payday(entry.at),
    }
    return _row(specs.TRANSACTIONS, **IDENTITY, **about, **_money(amounts(entry)))


def _fed(entry: Entry) -> dict[str, str]:
    about = {
        "Store address": ADDRESS,
        "Timezone": "Europe/Oslo",
        "Order placed date": entry.at.date(),
        "Order placed time": entry.at.time(),
        "Pickup timestamp": entry.at,
        "Delivery date": entry.at.date(),
        "Delivery time": entry.at.time(),
        "Channel": entry.channel,
        "Is cancelled": str(entry.order == "cancelled").lower(),
        "Currency": "NOK",
        "Subtotal": entry.amount,
    }
    return _row(specs.ORDER_FEED, **IDENTITY, **about)


def _payouts(booked: list[Entry]) -> list[dict[str, str]]:
    sums: dict[tuple[date, str], dict[str, Decimal]] = defaultdict(lambda: defaultdict(Decimal))
    for entry in booked:
        for name, value in amounts(entry).items():
            sums[payday(entry.at), entry.channel][name] += value
    # orders from before the first export
    sums[OPENS + timedelta(days=2), "Marketplace"] = {"Subtotal": Decimal("612.40"), "Commission": Decimal("-122.48")}
    # the last day's storefront order is left to a payout after the last export
    held = max((e for e in booked if e.channel == "Storefront"), key=lambda e: e.at)
    for name, value in amounts(held).items():
        sums[payday(held.at), held.channel][name] -= value
    found = []
    for number, ((day, channel), parts) in enumerate(sorted(sums.items(), key=lambda item: item[0])):
        about = {"Payout ID": f"P{number:02}", "Payout date": day, "Channel": channel, "Currency": "NOK"}
        total = {"Payout status": "PAID", "Net total": f"{sum(parts.values()):.2f}"}
        found.append(_row(specs.PAYOUTS, **IDENTITY, **about, **_money(parts), **total))
    return found


def _item(name: str, popular: bool, **sold: str) -> dict[str, str]:
    when = {"Start date": OPENS, "End date": OPENS + timedelta(days=DAYS)}
    about = {"Item name": name, "Channel": "Marketplace", "Popular item": int(popular)}
    return _row(specs.PRODUCT_MIX, **IDENTITY, **when, **about, **sold)


def _campaign(number: str, name: str, day: int, **seen: str) -> dict[str, str]:
    when = {
        "Date": OPENS + timedelta(days=day),
        "Campaign start date": OPENS,
        "Campaign end date": OPENS + timedelta(days=90),
    }
    store = {name: IDENTITY[name] for name in ("Store ID", "Store name")}
    about = {"Campaign ID": number, "Campaign name": name, "Is self serve campaign": "false"}
    return _row(specs.CAMPAIGNS, **store, **about, **when, **seen)


class Scenario:
    """The rows of every export."""

    def __init__(self) -> None:
        booked = sorted(entries(), key=lambda e: (e.at, e.order))
        self.transactions = [_transaction(n, e) for n, e in enumerate(booked, 1)]
        first: dict[str, Entry] = {}
        for entry in booked:
            first.setdefault(entry.order, entry)
        self.feed = [_fed(e) for e in first.values()]
        named = [*IDENTITY, *(c.heading for c in specs.ERROR_CHARGES.columns)]
        self.errors = [{n: t[n] for n in named} for t in self.transactions if t["Transaction type"] != "Order"]
        self.payouts = _payouts(booked)
        self.items = [
            _item("Miso soup", True, **{"Gross sales": "1530.00", "Total sold": "204"},
                  **{"Total item errors": "6", "Total error charges": "42.00"}),
            _item("Rice bowl", False, **{"Gross sales": "880.00", "Total sold": "110"}),
            _item("Tasting plate", False, **{"Total item errors": "1", "Total error charges": "5.00"}),
        ]
        soup = "Spring soup - quay kitchen - DOCK 4 (bus id: 5310)"
        self.campaigns = [_campaign("c-soup", soup, day, Orders="3", Sales="61.50") for day in (0, 1, 2, 9)]
        self.campaigns.append(_campaign("c-rain", "Rainy day", 20, Orders="1", Sales="14.20"))
        self.by_time = [
            {"Start date": str(OPENS + timedelta(days=n)), **IDENTITY, "Gross sales": "23.70"} for n in range(DAYS)
        ]

    def exports(self) -> dict[str, list[dict]]:
        return {
            "sales_by_order": self.feed,
            "sales_by_time": self.by_time,
            "financial_detailed_transactions": self.transactions,
            "financial_simplified_transactions": self.transactions,
            "financial_payout_summary": self.payouts,
            "financial_error_charges_and_adjustments": self.errors,
            "product_mix": self.items,
            "marketing_promotion": self.campaigns,
        }

    def write(self, folder: Path, name=lambda stem: f"{stem}.csv") -> None:
        folder.mkdir(parents=True, exist_ok=True)
        for stem, rows in self.exports().items():
            write_csv(folder / name(stem), rows)


def write_csv(path: Path, rows: list[dict], columns: list[str] | None = None) -> None:
    with path.open("w", newline="", encoding="utf-8-sig") as file:
        writer = csv.DictWriter(file, fieldnames=columns or list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)


def frame(spark, rows: list[dict], export: specs.Export):
    """Rows as a raw table: every column text, with load lineage."""
    names = list(rows[0])
    schema = ", ".join(f"`{n}` string" for n in names)
    raw = spark.createDataFrame([[r.get(n) for n in names] for r in rows], schema)
    return raw.selectExpr(
        "*",
        f"'{export.file_name}' as _source_file",
        "timestamp_ntz'2025-03-01 06:00:00' as _loaded_at",
        "'x' as _row_hash",
    )
