"""Oracle SQL for the stand-alone operator queries."""

from marketlens.checks import sql_merch as SM
from marketlens.checks.oracle import LINE_RECEIPT, with_views
from marketlens.checks.sql_finance import TYPE_TEXT

LATEST = "select * from b_snapshot where last_updated_date = (select max(last_updated_date) from b_snapshot)"

TRAIL_12 = "accepted_date >= date '1995-07-01' and accepted_date < date '1996-07-01'"
TRAIL_13_1 = "accepted_date >= date '1995-06-01' and accepted_date < date '1996-06-01'"

SQL = {
    "k02_publish_roundtrip": SM.R18,
    "k04_latest_snapshot": with_views(LATEST),
    "j03_null_safe_join": with_views(f"""select p.product_id, p.variant_id, p.promo_price, s.price
from b_promo p left join ({LATEST}) s on p.product_id = s.product_id and p.variant_id is not distinct from s.variant_id"""),
    "j08_semi_any": with_views(f"""select line_id, li.product_id, li.variant_id, company_id, total_amount, accepted_date
from b_line li join listed on listed.product_id = li.product_id and listed.variant_id is not distinct from li.variant_id
where {SM.KEPT_LINES}""", SM.A_TABLES),
    "w01_dedupe_latest": with_views("""select * from b_channel2 qualify row_number() over (
  partition by order_id, order_line_id order by order_date desc, l_shipdate desc, product_id, l_suppkey, gmv) = 1"""),
    "w04_previous_price": with_views("""select event_id, product_id, variant_id, date, price, pre_sell_price, pre_sell_price_date,
  pre_sell_price is not null and abs(price - pre_sell_price) > 0 is_change from (
  select *, lag(price, 1) over w pre_sell_price, lag(date, 1) over w pre_sell_price_date from (
    select event_id, ts, product_id, variant_id, price, cast(ts as date) date from b_price_history) h
  window w as (partition by product_id, variant_id order by date, ts, event_id)) x"""),
    "w05_first_by": with_views("""select event_id, cast(ts as date) run_date, product_id, variant_id, price,
  first_value(price) over (partition by cast(ts as date), product_id, variant_id order by ts, event_id) first_price
from b_price_history"""),
    "p04_order_type_mix": with_views("""select type_text, count(*) lines, cast(round(sum(cast(s as decimal(38, 6))), 2) as double) total_ex_tax,
  cast(round(sum(cast(n as decimal(38, 6))), 2) as double) net_ex_tax
from (select total_amount / 1.1 s,
  case when c.gst_registered = true or order_type in (9, 10, 11) then company_pay_price * qty / 1.1
       else company_pay_price * qty end n,
  case
    when order_type = 6 and refund_type = 0 and total_amount < 0 then 'CouponApplied'
    when order_type = 6 and refund_type = 0 and total_amount > 0 then 'CoupoonReversed'
    when order_type = 3 and refund_type = 0 and total_amount < 0 then 'CreditApplied'
    when order_type = 3 and refund_type = 0 and total_amount > 0 then 'CreditIssued'
    when order_type = 0 and refund_type = 0 and is_protection = true then 'FreightProtection'
    when order_type = 0 and refund_type = 4 then 'RefundMoney'
    when order_type = 0 and refund_type = 3 then 'RefundCredit'
    when order_type = 1 and refund_type = 0 then 'AddOn'
    when order_type = 2 and refund_type = 0 then 'Special / FreightQuote'
    when order_type = 12 and refund_type = 0 and total_amount < 0 then 'MyMoneyApplied'
    when order_type = 12 and refund_type = 0 and total_amount > 0 then 'MyMoneyReinstated'
    when order_type = 5 and refund_type = 0 then 'SupplierDeduction'
    when order_type = 4 and refund_type = 0 then 'SupplierPayment'
    when order_type = 9 and refund_type = 0 then 'TransactionFee'
    when order_type = 10 and refund_type = 0 then 'SubscriptionFee'
    when order_type = 11 and refund_type = 0 then 'RefundFee'
    when order_type = 0 and refund_type in (0, 1, 2) then 'Normal'
    else 'Missing' end type_text
  from b_line bd left join b_company c on bd.company_id = c.company_id) x group by 1"""),
    "p05_state_buckets": with_views("""select postal_state,
  case when regexp_matches(lower(postal_state), 'qld|queensland') then 'Queensland'
       when regexp_matches(lower(postal_state), 'nsw|newsouthwales|new.south.wales') then 'New South Wales'
       when regexp_matches(lower(postal_state), 'vic|victoria') then 'Victoria'
       when regexp_matches(lower(postal_state), 'wa|westernaustralia|western.australia') then 'Western Australia'
       when regexp_matches(lower(postal_state), 'tas|tasmania') then 'Tasmania'
       when regexp_matches(lower(postal_state), 'sa|southaustralia|south.australia') then 'South Australia'
       when regexp_matches(lower(postal_state), 'act|australiancapitalterritory|australian.capital.territory') then 'Australian Capital Territory'
       when regexp_matches(lower(postal_state), 'nt|northernterritory|northern.territory') then 'Northern Territory'
       else 'Unknown' end state,
  count(*) lines from b_line group by 1, 2"""),
    "a14_windowed_sales": with_views("select product_id, variant_id, company_id, " + ", ".join(
        f"round({m}, 3) {m}" for m in SM.A_NAMES) + " from total", SM.A_TABLES),
    "o04_live_promotions": with_views("select * exclude (direct, company_id), company_id seller_id from offer", SM.A_TABLES),
    "f03_local_windows": with_views(f"""select accepted_date, round(sum(total_amount), 2) amount,
  {SM.WINDOWS["tw"]} in_this_week, {SM.WINDOWS["l4w"]} in_last_4w, {SM.WINDOWS["ytd"]} in_ytd,
  {SM.WINDOWS["l12m"]} in_last_12m, {SM.PREFILTER} in_prefilter
from b_line where status in (3, 4) and total_amount > 0
  and accepted_date between date '1995-07-15' and {SM.DAY}
group by accepted_date"""),
    "j01_with_receipt": with_views("""select bd.line_id, ri.receipt_id, bd.product_id, bd.total_amount, p.channel
from b_line bd left join b_bridge ri on bd.line_id = ri.line_id
left join (select receipt_id, channel from b_receipt group by 1, 2) p on ri.receipt_id = p.receipt_id"""),
    "j06_churned_ids": with_views(f"""select distinct bd.customer_id from b_line bd
left join (select distinct customer_id cid from b_line where {TRAIL_12} and status in (3, 4) and total_amount > 0) c
  on bd.customer_id = c.cid
where {TRAIL_13_1} and status in (3, 4) and total_amount > 0 and c.cid is null and bd.customer_id is not null"""),
    "a07_first_receipts": with_views("""select customer_id, min(receipt_id) first_receipt, min(transaction_date) first_date
from b_receipt where receipt_type in (0, 1, 2) and approved = true and amount > 0 and channel is null group by 1"""),
    "a08_customer_span": with_views("""select customer_id, min(accepted_date) first_transaction_date,
  max(accepted_date) latest_transaction_date from lr
where status in (3, 4) and channel is null and total_amount > 0 and is_freight = false and is_protection = false
group by all""", {"lr": LINE_RECEIPT}),
    "a13_order_products": with_views("""select customer_id, receipt_id, accepted_date transaction_date, product_id,
  company_id seller_key, round(sum(total_amount), 2) product_revenue from lr
where status in (3, 4) and channel is null and total_amount > 0 and is_freight = false and is_protection = false
group by all""", {"lr": LINE_RECEIPT}),
    "p03_catalogue": with_views("select * from item", SM.A_TABLES),
    "p08_line_economics": with_views("""select line_id, product_id, order_type, type_text,
  cast(round(cast(total_amount / 1.1 as decimal(38, 6)), 4) as double) total_ex_tax,
  cast(round(cast(n as decimal(38, 6)), 4) as double) net_ex_tax,
  cast(round(cast(commission_fee as decimal(38, 6)), 4) as double) commission_fee
from (select bd.*, case when c.gst_registered = true or order_type in (9, 10, 11) then company_pay_price * qty / 1.1
       else company_pay_price * qty end n, (customer_price - company_pay_price) * qty commission_fee,
  """ + TYPE_TEXT + """ type_text
  from b_line bd left join b_company c on bd.company_id = c.company_id) x"""),
}
