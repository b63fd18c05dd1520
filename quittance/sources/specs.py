"""What each export holds, and how its headings become typed columns.

The headings, file stems and table names are fixed values: they have to equal what the
exporting platform writes. No other module spells them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from quittance.functions import text as t

# Added to every raw row on load.
SOURCE_FILE, LOADED_AT, RUN_ID, ROW_HASH = "_source_file", "_loaded_at", "_run_id", "_row_hash"
LINEAGE = (SOURCE_FILE, LOADED_AT, ROW_HASH)

LOAD_LOG = "_load_log"
LOAD_LOG_SCHEMA = (
    "run_id string, loaded_at timestamp_ntz, source_file string, target_table string, "
    "rows_in_file bigint, rows_inserted bigint, rows_skipped bigint, status string, message string"
)


@dataclass(frozen=True)
class StagedColumn:
    """One staged column: its name, the heading it comes from and the cast it needs."""

    name: str
    heading: str
    cast: str


CASTS = {
    "as is": lambda c: c,
    "text": t.clean_text,
    "amount": t.to_amount,
    "count": t.to_count,
    "day": t.to_date,
    "strict day": t.to_date_strict,
    "moment": t.to_timestamp,
    "clock": t.to_time,
    "true": lambda c: t.to_flag(c, "true"),
    "one": lambda c: t.to_flag(c, "1", fold_case=False),
}


@dataclass(frozen=True)
class Export:
    """One export file: stem, the raw table it lands in and its staged columns."""

    stem: str
    table: str
    staged: str | None = None
    columns: tuple[StagedColumn, ...] = ()
    key: tuple[str, tuple[str, ...]] | None = field(default=None)

    @property
    def file_name(self) -> str:
        return f"{self.stem}.csv"


def quoted(heading: str) -> Column:
    """A column by its literal heading, whatever punctuation it contains."""
    return F.col("`" + heading.replace("`", "``") + "`")


def _columns(text: str) -> tuple[StagedColumn, ...]:
    """Read ``name = heading : cast`` lines."""
    out = []
    for line in text.strip().splitlines():
        name, rest = line.split(" = ", 1)
        heading, cast = rest.rsplit(" : ", 1)
        out.append(StagedColumn(name.strip(), heading.strip(), cast.strip()))
    return tuple(out)


# ---- fixed values -----------------------------------------------------------------

ORDER_FEED = Export(
    stem="sales_by_order",
    table="orders",
    staged="stg_orders",
    key=("order_feed_key", ("Order placed date", "Order placed time", "Subtotal", "Channel")),
    columns=_columns(
        """
        channel = Channel : text
        order_placed_date = Order placed date : strict day
        order_placed_time = Order placed time : clock
        pickup_at = Pickup timestamp : moment
        delivery_date = Delivery date : day
        delivery_time = Delivery time : clock
        is_cancelled = Is cancelled : true
        subtotal = Subtotal : amount
        error_charge = Error charge : amount
        customer_rating = Customer rating : text
        currency = Currency : text
        store_timezone = Timezone : text
        """
    ),
)

TRANSACTIONS = Export(
    stem="financial_detailed_transactions",
    table="transactions_detailed",
    staged="stg_transactions",
    columns=_columns(
        """
        transaction_id = DoorDash transaction ID : as is
        order_id = DoorDash order ID : as is
        delivery_uuid = Delivery UUID : text
        transaction_type = Transaction type : text
        channel = Channel : text
        final_order_status = Final order status : text
        description = Description : text
        event_at = Timestamp local time : moment
        event_date = Timestamp local date : day
        payout_date = Payout date : strict day
        subtotal = Subtotal : amount
        subtotal_tax_passed = Subtotal tax passed to merchant : amount
        staff_tip = Staff tip : amount
        commission = Commission : amount
        payment_processing_fee = Payment processing fee : amount
        marketing_fees = Marketing fees | (including any applicable taxes) : amount
        discounts_merchant_funded = Customer discounts from marketing | (funded by you) : amount
        discounts_platform_funded = Customer discounts from marketing | (funded by DoorDash) : amount
        marketing_credit = DoorDash marketing credit : amount
        thirdparty_contribution = Third-party contribution : amount
        error_charges = Error charges : amount
        adjustments = Adjustments : amount
        """
    ),
)

PAYOUTS = Export(
    stem="financial_payout_summary",
    table="payout_summary",
    staged="stg_payout_summary",
    columns=_columns(
        """
        payout_id = Payout ID : as is
        payout_date = Payout date : strict day
        channel = Channel : text
        payout_status = Payout status : text
        currency = Currency : text
        subtotal = Subtotal : amount
        subtotal_tax_passed = Subtotal tax passed to merchant : amount
        staff_tip = Staff tip : amount
        commission = Commission : amount
        payment_processing_fee = Payment processing fee : amount
        marketing_fees = Marketing fees | (including any applicable taxes) : amount
        discounts_merchant_funded = Customer discounts from marketing | (funded by you) : amount
        discounts_platform_funded = Customer discounts from marketing | (funded by DoorDash) : amount
        discounts_thirdparty_funded = Customer discounts from marketing | (funded by a third-party) : amount
        marketing_credit = DoorDash marketing credit : amount
        thirdparty_contribution = Third-party contribution : amount
        error_charges = Error charges : amount
        adjustments = Adjustments : amount
        net_total = Net total : amount
        """
    ),
)

ERROR_CHARGES = Export(
    stem="financial_error_charges_and_adjustments",
    table="error_charges",
    staged="stg_error_charges",
    columns=_columns(
        """
        transaction_id = DoorDash transaction ID : as is
        order_id = DoorDash order ID : as is
        delivery_uuid = Delivery UUID : text
        transaction_type = Transaction type : text
        channel = Channel : text
        description = Description : text
        event_at = Timestamp local time : moment
        payout_date = Payout date : strict day
        error_charge_amount = Error charges : amount
        adjustment_amount = Adjustments : amount
        """
    ),
)

PRODUCT_MIX = Export(
    stem="product_mix",
    table="product_mix",
    staged="stg_product_mix",
    columns=_columns(
        """
        item_name = Item name : text
        channel = Channel : text
        is_popular_item = Popular item : one
        first_sold_date = Start date : strict day
        last_sold_date = End date : strict day
        gross_sales = Gross sales : amount
        discounts = Discounts : amount
        units_sold = Total sold : count
        item_error_count = Total item errors : count
        item_error_charges = Total error charges : amount
        """
    ),
)

CAMPAIGNS = Export(
    stem="marketing_promotion",
    table="marketing_promotion",
    staged="stg_marketing_campaigns",
    columns=_columns(
        """
        campaign_id = Campaign ID : as is
        campaign_name = Campaign name : text
        promotion_type = Type of promotion : text
        is_self_serve = Is self serve campaign : true
        activity_date = Date : strict day
        campaign_start_date = Campaign start date : strict day
        campaign_end_date = Campaign end date : strict day
        orders = Orders : count
        sales = Sales : amount
        discounts_merchant_funded = Customer discounts from marketing | (Funded by you) : amount
        discounts_platform_funded = Customer discounts from marketing | (Funded by DoorDash) : amount
        marketing_fees = Marketing fees | (including any applicable taxes) : amount
        marketing_credit = DoorDash marketing credit : amount
        average_order_value = Average order value : amount
        platform_reported_roas = ROAS : amount
        new_customers = New customers acquired : count
        existing_customers = Existing customers acquired : count
        total_customers = Total customers acquired : count
        """
    ),
)

# Loaded for cross-checks, read by no model.
SALES_BY_TIME = Export(stem="sales_by_time", table="sales_by_time")
SIMPLIFIED = Export(stem="financial_simplified_transactions", table="transactions_simplified")

EXPORTS = (
    ORDER_FEED,
    SALES_BY_TIME,
    TRANSACTIONS,
    SIMPLIFIED,
    PAYOUTS,
    ERROR_CHARGES,
    PRODUCT_MIX,
    CAMPAIGNS,
)

# Headings that identify a business, lower-cased, and what they identify.
IDENTIFYING = {
    "business id": "business_id",
    "business name": "business_name",
    "store id": "store_id",
    "store name": "store_name",
    "merchant store id": "merchant_store_id",
    "merchant supplied store id": "store_id",
    "store address": "address",
}
REPLACEMENTS = {
    "business_name": "Merchant A",
    "store_name": "Merchant A - Store 01",
    "address": "REDACTED",
    "merchant_store_id": "NULL",
}
SURROGATE_PREFIX = {"business_id": "9", "store_id": "8"}
OTHER_PREFIX = "7"
FREE_TEXT = ("campaign name",)
EMBEDDED_ID = "bus id: "

# Noise around an export's name: upload hash in front, date range and export id behind.
UPLOAD_HASH = r"^[0-9a-f]{8}-"
DATE_RANGE = r"_\d{4}-?\d{2}-?\d{2}_\d{4}-?\d{2}-?\d{2}_.*$"
