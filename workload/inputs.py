"""Raw exports derived from the driver's tables, once as SQL for both engines.

Each template yields the text columns of one export under their real headings, with the
awkward values the cleaning rules exist for. Backquotes become double quotes for the
oracle. Every template reads its whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")

# Payouts fall on the first Thursday on or after the day, plus a week.
_SPARK = {
    "payday": "date_add(cast(l_shipdate as date), (10 - weekday(l_shipdate)) % 7 + 7)",
    "ntz": "timestamp_ntz",
}
_DUCK = {
    "payday": "(cast(l_shipdate as date) + cast((11 - isodow(l_shipdate)) % 7 + 7 as integer))",
    "ntz": "timestamp",
}

_LINEAGE = """
    '{file}' as _source_file,
    cast('2025-03-01 06:00:00' as {{ntz}}) as _loaded_at,
    md5(concat('{file}', '|', {key})) as _row_hash
"""

_LINES = """
  select l.*,
    cast(l_extendedprice as decimal(18,2)) as price,
    {payday} as payday,
    case when l_quantity > 45 then 'Storefront' when l_quantity <= 2 then 'NULL' else 'Marketplace' end as channel,
    case when l_returnflag <> 'N' then cast(0 as decimal(18,2))
         when l_linenumber = 7 then -cast(l_extendedprice as decimal(18,2))
         else cast(l_extendedprice as decimal(18,2)) end as sub,
    cast(case when l_returnflag <> 'N' then cast(0 as decimal(18,2)) else cast(l_extendedprice as decimal(18,2)) end
         * cast(-0.285 as decimal(4,3)) as decimal(18,2)) as com,
    case when l_returnflag <> 'R' then cast(0 as decimal(18,2))
         when l_discount >= 0.095 then cast(l_extendedprice as decimal(18,2))
         else -cast(l_extendedprice as decimal(18,2)) end as err,
    case when l_returnflag = 'A' then cast(l_extendedprice as decimal(18,2)) else cast(0 as decimal(18,2)) end as adj
  from {lineitem} l
"""

TRANSACTIONS = (
    """
select
  md5(concat_ws('|', cast(l_orderkey as string), cast(l_partkey as string), cast(l_suppkey as string),
      cast(l_linenumber as string), cast(price as string))) as `DoorDash transaction ID`,
  cast(l_orderkey as string) as `DoorDash order ID`,
  case when l_linenumber = 3 then ' NULL ' else concat(' d', cast(l_orderkey as string)) end as `Delivery UUID`,
  case l_returnflag when 'N' then 'Order' when 'R' then 'Error Charge' else ' Adjustment ' end as `Transaction type`,
  channel as `Channel`,
  case when l_linestatus = 'F' then 'Delivered' else '' end as `Final order status`,
  case l_linenumber when 1 then '1 Item MISSING' when 2 then 'Food quality' when 3 then 'Incorrect item'
       when 4 then 'Entirely Wrong Order' when 5 then 'NULL' when 6 then 'null' else 'late' end as `Description`,
  case when l_tax >= 0.075 and l_linenumber = 2 then 'not a time'
       else concat(substring(cast(l_shipdate as string), 1, 10), ' 1', cast(l_linenumber as string), ':05:00')
  end as `Timestamp local time`,
  case when l_linenumber = 4 and l_tax >= 0.075 then 'NULL'
       else substring(cast(l_shipdate as string), 1, 10) end as `Timestamp local date`,
  case when l_returnflag = 'N' and l_linenumber = 1 and l_discount >= 0.095 then null
       else cast(payday as string) end as `Payout date`,
  case when l_linenumber = 5 then concat('  ', cast(sub as string), ' ') else cast(sub as string) end as `Subtotal`,
  cast(cast(l_tax as decimal(18,2)) as string) as `Subtotal tax passed to merchant`,
  case when l_linenumber = 2 then '' else cast(cast(l_quantity as decimal(18,2)) as string) end as `Staff tip`,
  cast(com as string) as `Commission`,
  concat('-', cast(l_linenumber as string), '.105') as `Payment processing fee`,
  case when l_linenumber = 6 then 'abc' else '-0.50' end
    as `Marketing fees | (including any applicable taxes)`,
  concat('-', cast(cast(l_discount as decimal(18,2)) as string))
    as `Customer discounts from marketing | (funded by you)`,
  case when l_linenumber = 1 then '1,000.00' when l_linenumber = 2 then '$5' else '+0.25' end
    as `Customer discounts from marketing | (funded by DoorDash)`,
  case when l_linenumber = 3 then '1e3' else 'NULL' end as `DoorDash marketing credit`,
  case when l_linenumber = 4 then ' .5' else cast(null as string) end as `Third-party contribution`,
  cast(err as string) as `Error charges`,
  cast(adj as string) as `Adjustments`,
  """
    + _LINEAGE.format(
        file="financial_detailed_transactions.csv",
        key="cast(l_orderkey as string), '|', cast(l_partkey as string), '|', cast(l_linenumber as string)",
    )
    + "from ("
    + _LINES
    + ") x"
)

# One payout per store, date and channel, a store being twenty suppliers. The statement differs from the ledger at the
# opening edge (settles more), at the closing edge (settles less) and by a commission cent.
PAYOUTS = (
    """
select
  concat('P', cast(store as string), '-', replace(cast(payday as string), '-', '')) as `Payout ID`,
  cast(payday as string) as `Payout date`,
  channel as `Channel`,
  case when store % 100 = 40 then 'PENDING' else ' PAID' end as `Payout status`,
  'USD' as `Currency`,
  cast(sub as string) as `Subtotal`,
  cast(tax as string) as `Subtotal tax passed to merchant`,
  cast(tip as string) as `Staff tip`,
  cast(com as string) as `Commission`,
  '' as `Payment processing fee`,
  'NULL' as `Marketing fees | (including any applicable taxes)`,
  '-1.00' as `Customer discounts from marketing | (funded by you)`,
  '0.25' as `Customer discounts from marketing | (funded by DoorDash)`,
  '0.50' as `Customer discounts from marketing | (funded by a third-party)`,
  cast(null as string) as `DoorDash marketing credit`,
  '0.00' as `Third-party contribution`,
  cast(err as string) as `Error charges`,
  cast(adj as string) as `Adjustments`,
  cast(sub + tax + tip + com + err + adj - cast(0.25 as decimal(18,2))
       + case when store % 100 = 60 then cast(0.01 as decimal(18,2)) else cast(0 as decimal(18,2)) end
       as string) as `Net total`,
  """
    + _LINEAGE.format(
        file="financial_payout_summary.csv",
        key="cast(store as string), '|', cast(payday as string), '|', channel",
    )
    + """
from (
  select l_suppkey - l_suppkey % 20 as store, payday, channel,
    sum(case when payday <= date '1995-01-19' and l_returnflag = 'N' then sub + cast(10.00 as decimal(18,2))
             when payday >= date '2001-11-08' and l_linenumber = 1 then cast(0 as decimal(18,2))
             else sub end) as sub,
    sum(cast(l_tax as decimal(18,2))) as tax,
    sum(cast(l_quantity as decimal(18,2))) as tip,
    sum(com - case when l_tax >= 0.075 and l_quantity = 20 then cast(0.01 as decimal(18,2))
                   else cast(0 as decimal(18,2)) end) as com,
    sum(err) as err,
    sum(adj) as adj
  from ("""
    + _LINES
    + """) x
  group by l_suppkey - l_suppkey % 20, payday, channel
) y"""
)

# Errors are charges, purchases are credits, a user is a delivery.
ERROR_CHARGES = (
    """
select
  concat('ev', cast(event_id as string)) as `DoorDash transaction ID`,
  cast(user_id as string) as `DoorDash order ID`,
  case when event_id % 53 = 0 then 'NULL' else concat('u', cast(user_id as string)) end as `Delivery UUID`,
  case event_type when 'error' then 'Error Charge' when 'purchase' then 'Adjustment' else event_type end
    as `Transaction type`,
  case when event_id % 7 = 0 then 'Storefront' when event_id % 31 = 0 then '' else 'Marketplace' end as `Channel`,
  case event_id % 5 when 0 then '2 Items Missing' when 1 then 'Poor food QUALITY' when 2 then 'incorrect item'
       when 3 then 'Entirely Wrong Order' else 'NULL' end as `Description`,
  case when event_id % 97 = 0 then 'NULL' else substring(cast(ts as string), 1, 19) end as `Timestamp local time`,
  substring(cast(ts as string), 1, 10) as `Payout date`,
  case when event_type = 'error' then concat('-', cast(cast(floor(value / 5) * 5 as decimal(18,2)) as string))
       else '0.00' end as `Error charges`,
  case when event_type = 'purchase' then cast(cast(floor(value / 5) * 5 as decimal(18,2)) as string)
       else 'NULL' end as `Adjustments`,
  """
    + _LINEAGE.format(file="financial_error_charges_and_adjustments.csv", key="cast(event_id as string)")
    + "from {events}"
)

ORDER_FEED = (
    """
select
  cast(o_custkey as string) as `Business ID`,
  concat('Store of ', cast(o_custkey as string)) as `Store name`,
  substring(cast(o_orderdate as string), 1, 10) as `Order placed date`,
  case o_orderstatus when 'P' then '9:05' when 'F' then concat('1', cast(o_custkey % 10 as string), ':30:00.250')
       else 'NULL' end as `Order placed time`,
  case o_orderpriority when '1-URGENT' then substring(cast(o_orderdate as string), 1, 10)
       when '5-LOW' then '2025' else substring(cast(o_orderdate as string), 1, 19) end as `Pickup timestamp`,
  case o_orderpriority when '1-URGENT' then replace(substring(cast(o_orderdate as string), 1, 10), '-', '/')
       when '2-HIGH' then 'NULL' when '3-MEDIUM' then '2025-01'
       else substring(cast(o_orderdate as string), 1, 19) end as `Delivery date`,
  case o_orderpriority when '1-URGENT' then '25:00:00' when '2-HIGH' then '23:59:59' else '12' end as `Delivery time`,
  case o_orderpriority when '4-NOT SPECIFIED' then null when '1-URGENT' then 'Storefront'
       else ' Marketplace' end as `Channel`,
  case o_orderstatus when 'P' then 'TRUE' when 'F' then 'false' else null end as `Is cancelled`,
  cast(cast(o_totalprice as decimal(18,2)) as string) as `Subtotal`,
  case when o_orderstatus = 'P' then '' else '0.00' end as `Error charge`,
  case when o_orderstatus = 'P' then 'NULL' else '5' end as `Customer rating`,
  'USD' as `Currency`,
  'US/Eastern ' as `Timezone`,
  """
    + _LINEAGE.format(file="sales_by_order.csv", key="cast(o_orderkey as string)")
    + "from {orders}"
)

PRODUCT_MIX = (
    """
select
  concat(' ', p_name, ' ', cast(p_partkey as string)) as `Item name`,
  channel as `Channel`,
  case p_size % 3 when 0 then '1' when 1 then '0' else null end as `Popular item`,
  first_day as `Start date`,
  last_day as `End date`,
  cast(gross as string) as `Gross sales`,
  'NULL' as `Discounts`,
  case when p_size % 10 = 0 then '0' when p_size % 10 = 1 then 'NULL' else cast(units as string) end as `Total sold`,
  cast(errors as string) as `Total item errors`,
  cast(charges as string) as `Total error charges`,
  """
    + _LINEAGE.format(file="product_mix.csv", key="cast(p_partkey as string), '|', channel")
    + """
from (
  select l_partkey, channel,
    min(substring(cast(l_shipdate as string), 1, 10)) as first_day,
    max(substring(cast(l_shipdate as string), 1, 10)) as last_day,
    sum(sub) as gross,
    sum(cast(l_quantity as decimal(18,1))) as units,
    sum(case when l_returnflag = 'R' then 1 else 0 end) as errors,
    sum(err) as charges
  from ("""
    + _LINES
    + """) x
  group by l_partkey, channel
) y join {part} on p_partkey = l_partkey"""
)

CAMPAIGNS = (
    """
select
  concat('cmp-', cast(user_id as string)) as `Campaign ID`,
  concat('Loyalty Promo (bus id: ', cast(user_id as string), ')') as `Campaign name`,
  case when user_id % 3 = 0 then 'NULL' else 'BOGO' end as `Type of promotion`,
  case when user_id % 4 = 0 and day > '2024-01-15' then 'True' when user_id % 4 = 1 then 'false' else null end
    as `Is self serve campaign`,
  day as `Date`,
  '2024-01-01' as `Campaign start date`,
  case when user_id % 5 = 0 then '2024-02-29' else '2024-12-31' end as `Campaign end date`,
  cast(n as string) as `Orders`,
  cast(sales as string) as `Sales`,
  '19.00' as `Customer discounts from marketing | (Funded by you)`,
  '0.0' as `Customer discounts from marketing | (Funded by DoorDash)`,
  'NULL' as `Marketing fees | (including any applicable taxes)`,
  '' as `DoorDash marketing credit`,
  '29.205' as `Average order value`,
  '1.94' as `ROAS`,
  '0' as `New customers acquired`,
  concat(cast(n as string), '.0') as `Existing customers acquired`,
  concat(cast(n as string), '.5') as `Total customers acquired`,
  """
    + _LINEAGE.format(file="marketing_promotion.csv", key="cast(user_id as string), '|', day")
    + """
from (
  select user_id, substring(cast(ts as string), 1, 10) as day, count(*) as n,
    sum(cast(floor(value) as decimal(18,2))) as sales
  from {events} group by user_id, substring(cast(ts as string), 1, 10)
) x"""
)

# Campaign names that embed business names, store names and business ids.
SCRUB_SOURCE = """
select cast(s_suppkey as string) as `Business ID`, s_name as `Business name`,
  cast(s_nationkey as string) as `Store ID`, concat(s_name, ' - Store ', cast(s_nationkey as string)) as `Store name`,
  case when s_nationkey = 3 then '' else 'NULL' end as `Merchant store ID`,
  concat(cast(s_suppkey as string), ' Main St') as `Store address`,
  case s_nationkey % 4
    when 0 then concat('Promo - ', s_name, ' (bus id: ', cast(s_suppkey as string), ')')
    when 1 then concat('Gift for ', upper(s_name), ' - STORE ', cast(s_nationkey as string), '  now')
    when 2 then concat('Two of ', s_name, ' and bus id:', cast(s_suppkey as string), ' or bus id:  77', ' -')
    else 'null' end as `Campaign name`
from {supplier}
union all
select cast(c_custkey as string), c_name, cast(c_nationkey as string), 'NULL', null, null,
  case when c_mktsegment = 'BUILDING' then concat('Loyal to ', c_name) else 'Plain  weekly   offer' end
from {customer}
"""

RAW = {
    "transactions": TRANSACTIONS,
    "payouts": PAYOUTS,
    "error_charges": ERROR_CHARGES,
    "order_feed": ORDER_FEED,
    "product_mix": PRODUCT_MIX,
    "campaigns": CAMPAIGNS,
    "scrub_source": SCRUB_SOURCE,
}


def duck(template: str) -> str:
    names = {t: t for t in TABLES}
    return template.format(**names, **_DUCK).replace("`", '"')


_SCHEMAS: dict[str, StructType] = {}  # by path, so that each file is opened for it once


class Tables:
    """The driver's tables of one scale factor, and the raw exports derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A table as it is stored, whatever its size: no plan depends on it."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def sql(self, template: str) -> DataFrame:
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in template}
        # only the table names stay as placeholders; Spark binds the frames itself
        text = template
        for key, value in _SPARK.items():
            text = text.replace("{" + key + "}", value)
        return self.spark.sql(text, **used)

    def raw(self, name: str) -> DataFrame:
        return self.sql(RAW[name])
