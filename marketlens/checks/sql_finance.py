"""Oracle SQL for the finance reports."""

from marketlens.checks.oracle import LAST_MONTH, LINE_RECEIPT, ROLL_52, TRAIL_12, TRAIL_13_1, with_views

OWN_DONE = "status in (3, 4) and total_amount > 0 and channel is null"
LR = {"lr": LINE_RECEIPT}

TYPE_TEXT = """case
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
  else 'Missing' end"""

ECON = """total_amount / 1.1 s,
  case when c.gst_registered = true or order_type in (9, 10, 11) then company_pay_price * qty / 1.1
       else company_pay_price * qty end n,
  (customer_price - company_pay_price) * qty commission_fee"""


def _month_table() -> str:
    from marketlens.params import lead_gen_months
    rows = ", ".join(f"('{m}', {v})" for m, v in lead_gen_months())
    return f"select month_year, cast(revenue as double) revenue from (values {rows}) v(month_year, revenue)"


_STATES = ["Victoria", "Western_Australia", "Australian_Capital_Territory", "Queensland",
           "South_Australia", "New_South_Wales", "Tasmania", "Northern_Territory"]
_PIVOT_RENAME = ", ".join(f"{st}_{m} as {m}_{st}" for st in _STATES
                          for m in ("gmv_exgst", "gtv_exgst", "units_sold"))

SQL = {
    "r01_seller_transactions": with_views(
        f"select count(distinct receipt_id) transactions from lr where {OWN_DONE} and {LAST_MONTH} and company_id = 1", LR),
    "r02_active_customers": with_views(
        f"select count(distinct customer_id) active_customers from lr where {OWN_DONE} and {TRAIL_12}", LR),
    "r03_active_this_vs_last": with_views(
        f"""select 'This Month' as "Period", count(distinct customer_id) active_users from lr where {OWN_DONE} and {TRAIL_12}
union all
select 'Last Month', count(distinct customer_id) from lr where {OWN_DONE} and {TRAIL_13_1}""", LR),
    "r04_churned_customers": with_views(
        f"""select count(distinct bd.customer_id) churned_customers from b_line bd
left join (select distinct customer_id cid from b_line where {TRAIL_12} and status in (3, 4) and total_amount > 0) c
  on bd.customer_id = c.cid
where {TRAIL_13_1} and status in (3, 4) and total_amount > 0 and c.cid is null"""),
    "r05_first_time_customers": with_views(
        """select count(distinct customer_id) new_customers_transcations from (
  select customer_id, min(receipt_id) first_receipt, min(transaction_date) first_date from b_receipt
  where receipt_type in (0, 1, 2) and approved = true and amount > 0 and channel is null group by 1)
where first_date >= date '1996-06-01' and first_date < date '1996-07-01'"""),
    "r06_new_customers": with_views(
        """select count(distinct customer_id) new_customers from (
  select customer_id, min(receipt_id) first_receipt, min(transaction_date) first_date from b_receipt
  where approved = true and receipt_type in (0, 1, 2) and channel is null group by customer_id) a
where first_date >= date '1996-06-01' and first_date < date '1996-07-01'"""),
    "r07_category_month": with_views(
        """select level1 "Level1", strftime(sale_date, '%b %Y') "SalesMonth",
  cast(round(sum(cast(revenue as decimal(38, 6))), 2) as double) revenue,
  cast(round(sum(cast(margin as decimal(38, 6))), 2) as double) margin from b_performance
where sale_date >= date '1996-06-01' and sale_date < date '1996-07-01' group by all order by 3 desc"""),
    "r08_seller_ledger": with_views(
        f"""select strftime(date_trunc('month', accepted_date), '%b %Y') "SalesMonth", c_id "CompanyId", company_name "CompanyName",
  cast(round(sum(cast(case when s > 0 then s else 0 end as decimal(38, 6))), 2) as double) "GTV",
  cast(round(sum(cast(case when s > 0 then (case when order_type in (9, 10, 11, 5, 4) or type_text = 'FreightProtection' then 0 else s end) else 0 end as decimal(38, 6))), 2) as double) "ProductGTV",
  cast(round(sum(cast(case when s <> 0 then s else 0 end as decimal(38, 6))), 2) as double) "NTV",
  cast(round(sum(cast(case when s <> 0 then (case when order_type in (9, 10, 11, 5, 4) or type_text = 'FreightProtection' then 0 else s end) else 0 end as decimal(38, 6))), 2) as double) "ProductNTV",
  cast(round(sum(cast(case when s < 0 or order_type in (9, 10, 11) then 0 else n end as decimal(38, 6))), 2) as double) "NetAmountExGSTGTV",
  cast(round(sum(cast(case when order_type in (9, 10, 11, 5, 4) or type_text = 'FreightProtection' or s < 0 or order_type in (9, 10, 11) then 0 else n end as decimal(38, 6))), 2) as double) "ProductNetAmountExGSTGTV",
  cast(round(sum(cast(case when order_type in (9, 10, 11) then 0 else n end as decimal(38, 6))), 2) as double) "NetAmountExGSTNTV",
  cast(round(sum(cast(case when order_type in (9, 10, 11, 5, 4) or type_text = 'FreightProtection' then 0 else n end as decimal(38, 6))), 2) as double) "ProductNetAmountExGSTNTV",
  cast(round(sum(cast(case when order_type = 9 then commission_fee / 1.1 else 0 end as decimal(38, 6))), 2) as double) "TransactionFeeBasedCommissionExGST",
  cast(round(sum(cast(case when order_type = 10 then commission_fee / 1.1 else 0 end as decimal(38, 6))), 2) as double) "SubscriptionFeeBasedCommissionExGST",
  cast(round(sum(cast(case when order_type = 11 then commission_fee / 1.1 else 0 end as decimal(38, 6))), 2) as double) "RefundFeeBasedCommissionExGST"
from (select bd.*, c.company_id c_id, c.description company_name, {ECON}, {TYPE_TEXT} type_text
      from b_line bd left join b_company c on bd.company_id = c.company_id
      where {LAST_MONTH} and status in (3, 4)) x
group by 1, 2, 3 order by 2"""),
    "r09_units_shipped": with_views(
        f"""select sum(qty) units_shipped from lr where {OWN_DONE} and {TRAIL_12}
  and is_freight = false and is_protection = false""", LR),
    "r10_total_customers": with_views(
        f"select count(distinct customer_id) total_customers from lr where {OWN_DONE} and {LAST_MONTH} and order_type <> 6", LR),
    "r11_total_transactions": with_views(
        """select count(distinct receipt_id) total_transactions from b_receipt
where amount > 0 and receipt_type in (0, 1, 2) and approved = true and channel is null
  and transaction_date >= date '1996-06-01' and transaction_date < date '1996-07-01'"""),
    "r12_unique_companies": with_views(
        f"select count(distinct company_id) unique_companies from lr where {OWN_DONE} and {LAST_MONTH}", LR),
    "r13_unique_products": with_views(
        f"""select count(distinct cast(product_id as varchar) || sku) unique_products from lr
where {OWN_DONE} and {LAST_MONTH} and is_protection = false""", LR),
    "r14_web_app_aov": with_views(
        """select case when client_type = 0 then 'web' when client_type in (1, 2, 3) then 'app' end platform,
  count(distinct receipt_id) total_transactions, round(sum(amount), 2) gross_sales,
  cast(round(cast(sum(amount) / nullif(count(distinct receipt_id), 0) as decimal(38, 6)), 2) as double) aov
from b_receipt where amount > 0 and receipt_type in (0, 1, 2) and approved = true and channel is null
  and transaction_date >= date '1996-06-01' and transaction_date < date '1996-07-01'
group by 1 order by 2 desc"""),
    "r15_profit_margin": with_views(
        f"""select *, (ttv_commission + other_incomes) - other_deductions gross_profit,
  ((ttv_commission + other_incomes) - other_deductions) / nullif(gtv_exgst + other_incomes, 0) profit_margin
from (
 select sale_month, sale_month_counter, ttv_commission, gtv_exgst,
   round(ttv_commission / nullif(gtv_exgst, 0), 3) * 100 margin,
   round(revenue + freightprotection_exgst + transaction_fee_based_commission_exgst
         + subscription_fee_based_commission_exgst + refund_fee_based_commission_exgst, 2) other_incomes,
   round(abs(refund_exgst) + abs(coupon_sales_exgst), 2) other_deductions,
   transaction_fee_based_commission_exgst, subscription_fee_based_commission_exgst,
   refund_fee_based_commission_exgst, refund_exgst, freightprotection_exgst, coupon_sales_exgst, gmv_exgst,
   revenue lead_gen_revenue
 from (
  select strftime(accepted_date, '%B-%Y') sale_month, month(accepted_date) sale_month_counter,
    cast(round(sum(cast(case when s > 0 then s else 0 end as decimal(38, 6))) - sum(cast(case when s < 0 or order_type in (9, 10, 11) then 0 else n end as decimal(38, 6))), 2) as double) ttv_commission,
    cast(round(sum(cast(case when order_type = 9 then commission_fee / 1.1 else 0 end as decimal(38, 6))), 2) as double) transaction_fee_based_commission_exgst,
    cast(round(sum(cast(case when order_type = 10 then commission_fee / 1.1 else 0 end as decimal(38, 6))), 2) as double) subscription_fee_based_commission_exgst,
    cast(round(sum(cast(case when order_type = 11 then commission_fee / 1.1 else 0 end as decimal(38, 6))), 2) as double) refund_fee_based_commission_exgst,
    cast(round(sum(cast(case when type_text = 'RefundMoney' then commission_fee / 1.1 else 0 end as decimal(38, 6))), 2) as double) refund_exgst,
    cast(round(sum(cast(case when type_text = 'FreightProtection' then commission_fee / 1.1 else 0 end as decimal(38, 6))), 2) as double) freightprotection_exgst,
    cast(round(sum(cast(case when type_text = 'CouponApplied' then s else 0 end as decimal(38, 6))), 2) as double) coupon_sales_exgst,
    cast(round(sum(cast(case when s > 0 and type_text <> 'FreightProtection' then s else 0 end as decimal(38, 6))), 2) as double) gmv_exgst,
    cast(round(sum(cast(case when s > 0 then s else 0 end as decimal(38, 6))), 2) as double) gtv_exgst
  from (select x.*, {ECON}, {TYPE_TEXT} type_text from lr x left join b_company c on x.company_id = c.company_id
        where {ROLL_52} and status in (3, 4) and channel is null) ab
  group by all) base
 left join lgr on base.sale_month = lgr.month_year) m
order by right(sale_month, 4), sale_month_counter""", {**LR, "lgr": _month_table()}),
    "r16_sales_by_state": with_views(
        f"""select month_year, {_PIVOT_RENAME} from (
  select strftime(accepted_date, '%B-%Y') month_year,
    case when regexp_matches(lower(postal_state), 'qld|queensland') then 'Queensland'
         when regexp_matches(lower(postal_state), 'nsw|newsouthwales|new.south.wales') then 'New South Wales'
         when regexp_matches(lower(postal_state), 'vic|victoria') then 'Victoria'
         when regexp_matches(lower(postal_state), 'wa|westernaustralia|western.australia') then 'Western Australia'
         when regexp_matches(lower(postal_state), 'tas|tasmania') then 'Tasmania'
         when regexp_matches(lower(postal_state), 'sa|southaustralia|south.australia') then 'South Australia'
         when regexp_matches(lower(postal_state), 'act|australiancapitalterritory|australian.capital.territory') then 'Australian Capital Territory'
         when regexp_matches(lower(postal_state), 'nt|northernterritory|northern.territory') then 'Northern Territory'
         else 'Unknown' end state,
    round(sum(case when is_protection = false then total_amount end) / 1.1, 2) gmv_exgst,
    round(sum(total_amount) / 1.1, 2) gtv_exgst,
    sum(case when is_protection = false and is_freight = false then qty end) units_sold
  from lr where {ROLL_52} and {OWN_DONE} and receipt_type in (0, 1, 2)
  group by all)
pivot (sum(gmv_exgst) as gmv_exgst, sum(gtv_exgst) as gtv_exgst, sum(units_sold) as units_sold
  for state in ('Victoria' as Victoria, 'Western Australia' as Western_Australia,
                'Australian Capital Territory' as Australian_Capital_Territory, 'Queensland' as Queensland,
                'South Australia' as South_Australia, 'New South Wales' as New_South_Wales,
                'Tasmania' as Tasmania, 'Northern Territory' as Northern_Territory))""", LR),
}
