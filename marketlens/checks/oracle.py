"""Independent DuckDB SQL for every registered query (the correctness oracle).

The binding views of FIXTURES.md part 3 are inlined as CTEs, so each entry
is one self-contained statement over the driver's pre-registered tables.
Conventions: money sums rounded to 2 decimals; NULL-propagating concat is
``||``; safe division is ``x / nullif(y, 0)``; integer sums cast to BIGINT.
"""

from __future__ import annotations

import re

# ---- binding views (FIXTURES.md part 3), DuckDB dialect ----------------------------
VIEWS: dict[str, str] = {
    "b_company": """select s_suppkey company_id, s_name description, s_suppkey % 2 = 0 gst_registered,
  s_suppkey % 10 = 9 soft_deleted from supplier""",
    "b_product": """select p_partkey product_id, p_name product_name, p_brand brand,
  case when p_partkey % 13 <> 0 then cast(regexp_extract(p_brand, '([0-9]+)$', 1) as bigint) end brand_id, p_type level1,
  p_partkey % 10 company_id, 'P-' || p_partkey sku, p_retailprice sell_price, p_retailprice * 1.2 rrp,
  p_size stock, date '1995-01-01' + cast(p_partkey % 365 as int) created from part""",
    "b_item": "select p_partkey product_id, p_partkey + 500000 item_id from part",
    "b_variant": """select p_partkey + 500000 item_id, p_partkey % 4 variant_id,
  case when p_size % 3 = 0 then null else 'V-' || p_partkey end sku,
  case when p_size % 5 = 0 then null else p_retailprice * 0.95 end sell_price,
  case when p_size % 4 <> 0 then p_retailprice * 1.1 end rrp, case when p_size % 6 <> 0 then p_size + 7 end stock,
  case when p_size % 2 <> 0 then date '1995-10-01' + cast(p_partkey % 400 as int) end created
  from part where p_partkey % 4 <> 0""",
    "b_brand": """select distinct cast(regexp_extract(p_brand, '([0-9]+)$', 1) as bigint) brand_id, p_brand brand_name from part""",
    "b_category": """select p_partkey product_id, p_partkey % 50 + 1 tag_id, p_type level1, p_type || '/' || p_size % 4 level2,
  case when p_size % 2 = 0 then p_brand end level3, case when p_size % 5 = 0 then 'S' || p_size end level4
  from part where p_partkey % 9 <> 0""",
    "b_line": """select l.l_orderkey line_id, o.o_custkey customer_id, l.l_partkey product_id,
  case when l.l_partkey % 4 = 0 then null else l.l_partkey % 4 end variant_id, l.l_partkey % 10 company_id,
  case o.o_orderstatus when 'F' then 3 when 'O' then 4 else 1 end status,
  case when l.l_linenumber <= 3 then 0 when l.l_linenumber = 4 then 9 when l.l_linenumber = 5 then 10
       when l.l_linenumber = 6 then 11 else 6 end order_type,
  case when l.l_linenumber <= 3 and l.l_returnflag = 'R' then 4 else 0 end refund_type,
  case when l.l_returnflag = 'R' then -l.l_extendedprice else l.l_extendedprice end total_amount,
  l.l_quantity qty, l.l_extendedprice / l.l_quantity customer_price,
  l.l_extendedprice / l.l_quantity * (1 - l.l_discount) company_pay_price,
  cast(o.o_orderdate as date) accepted_date,
  l.l_linenumber = 2 and l.l_linestatus = 'O' is_freight, l.l_linenumber = 3 and l.l_linestatus = 'O' is_protection,
  case when l.l_partkey % 5 = 0 then null else 'P-' || l.l_partkey end sku,
  case o.o_custkey % 10 when 0 then 'QLD' when 1 then 'New South Wales' when 2 then 'vic' when 3 then 'Western Australia'
    when 4 then 'Tasmania' when 5 then 'south australia' when 6 then 'ACT' when 7 then 'Northern Territory'
    when 8 then 'Other' else null end postal_state
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "b_bridge": "select o_orderkey line_id, o_orderkey receipt_id from orders where o_orderkey % 97 <> 0",
    "b_receipt": """select o_orderkey receipt_id, o_custkey customer_id, cast(o_orderdate as date) transaction_date,
  case when o_orderkey % 50 = 0 then 0.0 else o_totalprice end amount, o_orderstatus <> 'P' approved,
  case when o_orderkey % 10 < 9 then o_orderkey % 3 else 3 end receipt_type,
  cast(substr(o_orderpriority, 1, 1) as int) - 1 client_type,
  case o_orderpriority when '4-NOT SPECIFIED' then 'partner_a' when '5-LOW' then 'partner_b' end channel from orders""",
    "b_subscription": """select p_partkey product_id, case p_size % 3 when 1 then 'partner_a' else 'partner_b' end channel,
  p_size < 25 subscribed, case when p_size >= 25 then 'reason ' || p_size % 3 end unsubscribed_reason,
  case when p_size % 4 = 0 then 'note ' || p_size % 5 end banner_note,
  date '1996-01-01' + cast(p_partkey % 190 as int) last_updated from part where p_size % 3 <> 0""",
    "b_secondary": """select p_partkey + 1 product_id,
  case when (p_partkey + 1) % 4 = 0 then null else (p_partkey + 1) % 4 end variant_id,
  p_partkey secondary_id from part where p_partkey % 10 = 3""",
    "b_snapshot": """select d.d last_updated_date, p_partkey product_id,
  case when p_partkey % 4 = 0 then null else p_partkey % 4 end variant_id, p_retailprice + d.k price,
  p_partkey + 900000 listing_id, date '1995-03-01' + cast(p_partkey % 300 as int) created_date, 'Listing ' || p_name "name",
  'https://listing.example/' || p_partkey link, 'L-' || p_partkey sku, p_size * 2 stock, p_type level1, p_brand level2,
  'S' || p_size % 5 level3, case when p_size % 2 = 1 then 'T' || p_size % 3 end level4,
  case when p_size % 2 = 0 then 'Active' else 'Inactive' end active_status, p_retailprice * 1.3 rrp,
  'Seller ' || p_partkey % 10 seller_name, case when p_partkey % 10 <= 2 then '1P' else '3P' end seller_type
  from part, (values (date '1996-07-13', 0), (date '1996-07-14', 1)) d(d, k) where p_partkey % 7 <> 0""",
    "b_daily_price": """select date '1996-06-18' + cast(k as int) run_date, row_no, cast(p_partkey as varchar) product_id,
  case when p_partkey % 4 = 0 then null else cast(p_partkey % 4 as varchar) end variant_id,
  p_retailprice - k % 5 * 30 + row_no price, case when p_partkey % 8 = 0 then 'partner_b' else 'Own' end marketplace
  from part, range(31) days(k), range(2) again(row_no)
  where k % (p_size % 3 + 1) = 0 and (row_no = 0 or p_size % 4 = 0)""",
    "b_promo": """select p_partkey product_id, case when p_partkey % 4 = 0 then null else p_partkey % 4 end variant_id,
  p_partkey % 10 company_id, p_retailprice * 0.9 promo_price, p_size commission,
  date '1996-07-01' + p_size start_date, date '1996-07-15' + p_size - 5 end_date,
  p_size % 7 = 0 is_deleted, p_size % 11 = 0 is_archived from part where p_size <= 20""",
    "b_lookup": """select cast(p_partkey as varchar) product_id,
  case when p_partkey % 4 = 0 then null else cast(p_partkey % 4 as varchar) end variant_id,
  p_partkey + 100000 internal_product_id, cast(p_partkey % 10 as varchar) seller_id,
  date '1995-06-01' + cast(p_partkey % 200 as int) published_date,
  case when p_size % 2 = 0 then 'Active' else 'Inactive' end active_status,
  'Seller ' || cast(p_partkey % 10 as varchar) seller_name,
  case when p_size % 3 = 1 then 'partner_a' else 'partner_b' end marketplace from part where p_partkey % 5 <> 0""",
    "b_price_history": """select ts, event_id, user_id product_id,
  case when user_id % 4 = 0 then null else user_id % 4 end variant_id, value price from events where event_type = 'view'""",
    "b_stock_out": """select cast(ts as date) oos_date, event_id, user_id product_id,
  case when user_id % 4 = 0 then null else user_id % 4 end variant_id from events where event_type = 'error'""",
    "b_promo_check": """select event_id, user_id product_id, case when user_id % 4 = 0 then null else user_id % 4 end variant_id,
  cast(ts as date) start_date, value promo_price from events where event_type = 'purchase'""",
    "b_created": "select user_id product_id, max(cast(ts as date)) created from events where event_type = 'signup' group by 1",
    "b_channel2": """select l_orderkey order_id, l_linenumber order_line_id, o_custkey customer_id,
  cast(o_orderdate as date) order_date, l_partkey product_id, cast(l_partkey as varchar) external_product_id,
  l_extendedprice gmv, l_shipdate, l_suppkey from lineitem join orders on l_orderkey = o_orderkey""",
    "b_channel3": """select l_orderkey order_id, l_partkey article_id, o_custkey customer_id, cast(o_orderdate as date) order_date,
  case when l_partkey % 10 = 7 then null else cast(l_partkey % 10 as varchar) end seller_id, l_extendedprice line_total,
  l_shipdate, l_linenumber, l_suppkey from lineitem join orders on l_orderkey = o_orderkey""",
    "b_performance": """select p_type level1, cast(o_orderdate as date) sale_date, l_extendedprice * (1 - l_discount) revenue,
  l_extendedprice * (1 - l_discount) * l_tax margin from lineitem join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey""",
}

# Own-site completed-sales base with the receipt channel (J1 + F5 inputs).
LINE_RECEIPT = """select bd.*, p.channel, p.receipt_type, ri.receipt_id from b_line bd
  left join b_bridge ri on bd.line_id = ri.line_id
  left join (select receipt_id, channel, receipt_type from b_receipt group by 1, 2, 3) p on ri.receipt_id = p.receipt_id"""


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the binding CTEs it (transitively) mentions."""
    defs = dict(VIEWS)
    defs.update(extra or {})
    order = list(VIEWS) + [k for k in (extra or {}) if k not in VIEWS]
    needed: set[str] = set()

    def visit(text: str):
        for name in order:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(defs[name])

    visit(body)
    ctes = [f"{n} as ({defs[n]})" for n in order if n in needed]
    return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body


# ---- dates of the fixture run (see marketlens.params) -----------------------------
LAST_MONTH = "accepted_date >= date '1996-06-01' and accepted_date < date '1996-07-01'"
TRAIL_12 = "accepted_date >= date '1995-07-01' and accepted_date < date '1996-07-01'"
TRAIL_13_1 = "accepted_date >= date '1995-06-01' and accepted_date < date '1996-06-01'"
ROLL_52 = "accepted_date between date '1995-07-02' and date '1996-06-30'"
OWN = {"lr": LINE_RECEIPT}
