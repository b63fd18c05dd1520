"""The staged columns as the oracle takes them: fixed values, kept apart from the library's own list.

Each line is name, heading and kind of a column; a wrong heading or cast in the library then
shows as a difference. The key of the order feed hashes the headings named in ORDER_KEY.
"""

ORDER_KEY = ("Order placed date", "Order placed time", "Subtotal", "Channel")

COLUMNS = {
    "transactions": (
        ("transaction_id", "DoorDash transaction ID", "as is"),
        ("order_id", "DoorDash order ID", "as is"),
        ("delivery_uuid", "Delivery UUID", "text"),
        ("transaction_type", "Transaction type", "text"),
        ("channel", "Channel", "text"),
        ("final_order_status", "Final order status", "text"),
        ("description", "Description", "text"),
        ("event_at", "Timestamp local time", "moment"),
        ("event_date", "Timestamp local date", "day"),
        ("payout_date", "Payout date", "strict day"),
        ("subtotal", "Subtotal", "amount"),
        ("subtotal_tax_passed", "Subtotal tax passed to merchant", "amount"),
        ("staff_tip", "Staff tip", "amount"),
        ("commission", "Commission", "amount"),
        ("payment_processing_fee", "Payment processing fee", "amount"),
        ("marketing_fees", "Marketing fees | (including any applicable taxes)", "amount"),
        ("discounts_merchant_funded", "Customer discounts from marketing | (funded by you)", "amount"),
        ("discounts_platform_funded", "Customer discounts from marketing | (funded by DoorDash)", "amount"),
        ("marketing_credit", "DoorDash marketing credit", "amount"),
        ("thirdparty_contribution", "Third-party contribution", "amount"),
        ("error_charges", "Error charges", "amount"),
        ("adjustments", "Adjustments", "amount"),
    ),
    "payouts": (
        ("payout_id", "Payout ID", "as is"),
        ("payout_date", "Payout date", "strict day"),
        ("channel", "Channel", "text"),
        ("payout_status", "Payout status", "text"),
        ("currency", "Currency", "text"),
        ("subtotal", "Subtotal", "amount"),
        ("subtotal_tax_passed", "Subtotal tax passed to merchant", "amount"),
        ("staff_tip", "Staff tip", "amount"),
        ("commission", "Commission", "amount"),
        ("payment_processing_fee", "Payment processing fee", "amount"),
        ("marketing_fees", "Marketing fees | (including any applicable taxes)", "amount"),
        ("discounts_merchant_funded", "Customer discounts from marketing | (funded by you)", "amount"),
        ("discounts_platform_funded", "Customer discounts from marketing | (funded by DoorDash)", "amount"),
        ("discounts_thirdparty_funded", "Customer discounts from marketing | (funded by a third-party)", "amount"),
        ("marketing_credit", "DoorDash marketing credit", "amount"),
        ("thirdparty_contribution", "Third-party contribution", "amount"),
        ("error_charges", "Error charges", "amount"),
        ("adjustments", "Adjustments", "amount"),
        ("net_total", "Net total", "amount"),
    ),
    "error_charges": (
        ("transaction_id", "DoorDash transaction ID", "as is"),
        ("order_id", "DoorDash order ID", "as is"),
        ("delivery_uuid", "Delivery UUID", "text"),
        ("transaction_type", "Transaction type", "text"),
        ("channel", "Channel", "text"),
        ("description", "Description", "text"),
        ("event_at", "Timestamp local time", "moment"),
        ("payout_date", "Payout date", "strict day"),
        ("error_charge_amount", "Error charges", "amount"),
        ("adjustment_amount", "Adjustments", "amount"),
    ),
    "order_feed": (
        ("channel", "Channel", "text"),
        ("order_placed_date", "Order placed date", "strict day"),
        ("order_placed_time", "Order placed time", "clock"),
        ("pickup_at", "Pickup timestamp", "moment"),
        ("delivery_date", "Delivery date", "day"),
        ("delivery_time", "Delivery time", "clock"),
        ("is_cancelled", "Is cancelled", "true"),
        ("subtotal", "Subtotal", "amount"),
        ("error_charge", "Error charge", "amount"),
        ("customer_rating", "Customer rating", "text"),
        ("currency", "Currency", "text"),
        ("store_timezone", "Timezone", "text"),
    ),
    "product_mix": (
        ("item_name", "Item name", "text"),
        ("channel", "Channel", "text"),
        ("is_popular_item", "Popular item", "one"),
        ("first_sold_date", "Start date", "strict day"),
        ("last_sold_date", "End date", "strict day"),
        ("gross_sales", "Gross sales", "amount"),
        ("discounts", "Discounts", "amount"),
        ("units_sold", "Total sold", "count"),
        ("item_error_count", "Total item errors", "count"),
        ("item_error_charges", "Total error charges", "amount"),
    ),
    "campaigns": (
        ("campaign_id", "Campaign ID", "as is"),
        ("campaign_name", "Campaign name", "text"),
        ("promotion_type", "Type of promotion", "text"),
        ("is_self_serve", "Is self serve campaign", "true"),
        ("activity_date", "Date", "strict day"),
        ("campaign_start_date", "Campaign start date", "strict day"),
        ("campaign_end_date", "Campaign end date", "strict day"),
        ("orders", "Orders", "count"),
        ("sales", "Sales", "amount"),
        ("discounts_merchant_funded", "Customer discounts from marketing | (Funded by you)", "amount"),
        ("discounts_platform_funded", "Customer discounts from marketing | (Funded by DoorDash)", "amount"),
        ("marketing_fees", "Marketing fees | (including any applicable taxes)", "amount"),
        ("marketing_credit", "DoorDash marketing credit", "amount"),
        ("average_order_value", "Average order value", "amount"),
        ("platform_reported_roas", "ROAS", "amount"),
        ("new_customers", "New customers acquired", "count"),
        ("existing_customers", "Existing customers acquired", "count"),
        ("total_customers", "Total customers acquired", "count"),
    ),
}
