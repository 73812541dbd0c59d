"""Key events found in tables derived from orders and order lines."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.fixed_values import (
    COUNTER_EVENTS,
    FIRST_CONSULT,
    FIRST_SALES_INVOICE,
    LEGISLATION_TEMPLATE,
    SUMMED_EVENTS,
)
from tidemark.functions.expressions import ntz
from tidemark.operators.erasure import listed_rows
from tidemark.operators.skew import salted_join
from tidemark.plans.key_events import (
    Bounds,
    EventSources,
    accountant_linked_events,
    consult_events,
    consult_request_events,
    contract_accounts,
    counter_events,
    first_times,
    key_events,
    legislation_events,
    merge_events,
    mobile_use_events,
    sales_invoice_events,
    within,
)
from tidemark.queries.views import oracle, table, view

TODAY = date(2021, 9, 30)
UNTIL = datetime(2016, 6, 30)
AFTER = {
    "First Account Card": date(2015, 3, 1),
    "First Bank Account": date(2015, 2, 1),
    "First Project": date(2015, 1, 15),
    FIRST_CONSULT: date(2015, 2, 1),
    FIRST_SALES_INVOICE: date(2015, 4, 1),
    LEGISLATION_TEMPLATE: date(2015, 1, 10),
}
BOUNDS = Bounds(UNTIL, AFTER)


def _contracts(spark, sf_dir):
    summary, accounts = view(spark, sf_dir, "d_contract_summary"), view(spark, sf_dir, "d_accounts")
    return contract_accounts(summary, accounts)


def counters(spark, sf_dir):
    daily, divisions = view(spark, sf_dir, "d_daily"), view(spark, sf_dir, "d_divisions")
    return counter_events(daily, divisions, _contracts(spark, sf_dir), BOUNDS, TODAY)


def sales_invoices(spark, sf_dir):
    summary, divisions = view(spark, sf_dir, "d_summary"), view(spark, sf_dir, "d_divisions")
    return sales_invoice_events(summary, divisions, _contracts(spark, sf_dir), BOUNDS, TODAY)


def consults(spark, sf_dir):
    entries, items = view(spark, sf_dir, "d_time_entries"), view(spark, sf_dir, "d_items")
    accounts = view(spark, sf_dir, "d_accounts")
    return consult_events(entries, items, accounts, _contracts(spark, sf_dir), BOUNDS, TODAY)


def consult_requests(spark, sf_dir):
    requests = view(spark, sf_dir, "d_consult_requests")
    return consult_request_events(requests, _contracts(spark, sf_dir), TODAY)


def mobile_use(spark, sf_dir):
    return mobile_use_events(view(spark, sf_dir, "d_activity"), _contracts(spark, sf_dir), TODAY)


def accountants_linked(spark, sf_dir):
    return accountant_linked_events(view(spark, sf_dir, "d_links"), _contracts(spark, sf_dir), TODAY)


def newest_from_template(spark, sf_dir):
    divisions, summary = view(spark, sf_dir, "d_divisions"), view(spark, sf_dir, "d_summary")
    return legislation_events(divisions, summary, BOUNDS, TODAY)


EVENT_VIEWS = (
    "d_daily d_summary d_divisions d_accounts d_contract_summary d_time_entries d_items"
    " d_consult_requests d_activity d_links"
).split()


def all_events(spark, sf_dir):
    sources = EventSources(*[view(spark, sf_dir, name) for name in EVENT_VIEWS])
    return key_events(sources, BOUNDS, TODAY)


def _first_of_type(spark, sf_dir, until_day: bool):
    events = table(spark, sf_dir, "events")
    early = F.to_date("ts") <= F.lit(date(2024, 1, 14))
    return (
        events.where(F.col("event_type").isin("purchase", "signup"))
        .where(early if until_day else ~early)
        .groupBy("user_id", "event_type")
        .agg(F.min("ts").alias("key_event_timestamp"))
        .select(
            F.concat(F.lit("A"), "user_id").alias("accountid"),
            F.lit(None).cast("string").alias("environment"),
            F.lit(None).cast("string").alias("divisioncode"),
            F.lit(None).cast("string").alias("userid"),
            F.col("event_type").alias("key_event"),
            "key_event_timestamp",
            F.to_date("key_event_timestamp").alias("inserteddatetime"),
        )
    )


def merged_events(spark, sf_dir):
    store, new = _first_of_type(spark, sf_dir, True), _first_of_type(spark, sf_dir, False)
    purchases = new.where(F.col("key_event") == "purchase")
    return merge_events(store, purchases, ["purchase"])


def merged_keeping_first(spark, sf_dir):
    store, new = _first_of_type(spark, sf_dir, True), _first_of_type(spark, sf_dir, False)
    return merge_events(store, new, ["purchase", "signup"], keep="first")


STATUS_FIRSTS = {"finished": "F", "open": "O", "planned": "P"}
FIRSTS_BOUNDS = Bounds(datetime(1995, 6, 1), {"finished": date(1995, 2, 1), "open": date(1995, 3, 1)})


def bounded_firsts(spark, sf_dir):
    conditions = {name: F.col("o_orderstatus") == code for name, code in STATUS_FIRSTS.items()}
    firsts = first_times(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", conditions)
    return within(firsts, FIRSTS_BOUNDS, list(conditions))


def unbounded_firsts(spark, sf_dir):
    conditions = {name: F.col("event_type") == name for name in ("purchase", "signup", "error")}
    return first_times(table(spark, sf_dir, "events"), ["user_id"], "ts", conditions)


def customers_without_recent_plan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    recent = orders.where((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") >= ntz("2000-01-01")))
    return listed_rows(table(spark, sf_dir, "customer"), "c_custkey", recent.select("o_custkey"), "left_anti")


def orders_with_customer(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    owners = customer.withColumnRenamed("c_custkey", "o_custkey")
    return salted_join(
        orders.select("o_custkey", "o_orderkey", "o_totalprice"),
        owners.select("o_custkey", "c_mktsegment"),
        ["o_custkey"],
    )


QUERIES = {
    "first_event_bounded": bounded_firsts,
    "first_event_unbounded": unbounded_firsts,
    "holding_removed": customers_without_recent_plan,
    "first_event_counters": counters,
    "first_event_sales_invoice": sales_invoices,
    "first_event_like": consults,
    "first_event_requested": consult_requests,
    "first_event_mobile": mobile_use,
    "first_event_linked": accountants_linked,
    "newest_then_match": newest_from_template,
    "key_events_all": all_events,
    "key_event_merge": merged_events,
    "key_event_merge_first": merged_keeping_first,
    "salted_join": orders_with_customer,
}


def _bounded(event: str, moment: str) -> str:
    after = f"and {moment} > timestamp '{AFTER[event]}'" if event in AFTER else ""
    return f"{moment} <= timestamp '{UNTIL}' {after}"


def _row(account: str, environment: str, division: str, event: str, moment: str) -> str:
    return f"""select distinct {account} as accountid, {environment} as environment,
        {division} as divisioncode, cast(null as varchar) as userid, '{event}' as key_event,
        {moment} as key_event_timestamp, date '{TODAY}' as inserteddatetime"""


_CTE_A = """, a as (select s.* from d_contract_summary s
                    where accountid in (select accountid from d_accounts))"""


def _division_event(event: str, source: str, moment: str, condition: str) -> str:
    row = _row("a.accountid", "a.environment", "cast(f.divisioncode as varchar)", event, "f.m")
    return f"""{row}
        from (select s.environment, s.divisioncode, min({moment}) as m
              from {source} s join d_divisions d on s.environment = d.environment and s.divisioncode = d.divisioncode
              join d_accounts x on d.accountid = x.accountid
              where {condition} group by s.environment, s.divisioncode) f
        join d_divisions d on f.environment = d.environment and f.divisioncode = d.divisioncode
        join a on a.accountid = d.accountid
        where {_bounded(event, 'f.m')}"""


def _counter_sql(event: str) -> str:
    names = COUNTER_EVENTS[event]
    if event in SUMMED_EVENTS:
        condition = " + ".join(f"coalesce({n}, 0)" for n in names) + " > 0"
    else:
        condition = "(" + " or ".join(f"{n} > 0" for n in names) + ")"
    return _division_event(event, "d_daily", "date", condition)


_COUNTERS = " union all ".join(_counter_sql(event) for event in COUNTER_EVENTS)
_INVOICES = _division_event(
    FIRST_SALES_INVOICE, "d_summary", "salesinvoicefirstdate", "salesinvoicefirstdate is not null"
)
_CONSULTS = f"""{_row('a.accountid', 'a.environment', 'cast(null as varchar)', FIRST_CONSULT, 'f.m')}
    from (select x.environment, t.accountid, min(t.date) as m
          from d_time_entries t join d_items i on t.itemid = i.itemid
          join d_accounts x on t.accountid = x.accountid
          where i.itemcode like '%EOLCONSULT%' group by 1, 2) f
    join a on a.accountid = f.accountid and a.environment = f.environment
    where {_bounded(FIRST_CONSULT, 'f.m')}"""
_REQUESTS = f"""{_row('a.accountid', 'a.environment', 'cast(null as varchar)', 'First Consult Requested', 'f.m')}
    from (select environment, accountid, min(created) as m from d_consult_requests
          where status <> 'S' group by 1, 2) f
    join a on a.accountid = f.accountid and a.environment = f.environment"""
_NULLS = ("cast(null as varchar)", "cast(null as varchar)")
_MOBILE = f"""{_row('t.accountid', *_NULLS, 'First Time Mobile App Used', 'min(t.date)')}
    from d_activity t join a on a.accountid = t.accountid where t.activityid = '8' group by t.accountid"""
_LINKED = f"""{_row('a.accountid', *_NULLS, 'First Time Accountant Linked', 'min(l.date)')}
    from d_links l join a on a.accountcode = l.accountcode and a.environment = l.environment
    where l.linkstatus = 'Accountant Linked' group by a.accountid"""


def _newest_sql(ties: str) -> str:
    row = _row("accountid", "environment", "cast(divisioncode as varchar)", LEGISLATION_TEMPLATE, "syscreated")
    return f"""{row}
    from (select d.*, s.startuptype, row_number() over (partition by d.accountid
                 order by d.syscreated desc{ties}) as rn
          from d_divisions d join d_summary s on s.environment = d.environment and s.divisioncode = d.divisioncode) n
    where rn = 1 and startuptype = 'X' and {_bounded(LEGISLATION_TEMPLATE, 'syscreated')}"""


_A_VIEWS = ("d_accounts", "d_contract_summary")

_MERGE_INPUT = """
    with firsts as (
        select 'A' || user_id as accountid, cast(null as varchar) as environment,
               cast(null as varchar) as divisioncode, cast(null as varchar) as userid, event_type as key_event,
               min(ts) as key_event_timestamp, cast(min(ts) as date) as inserteddatetime,
               cast(ts as date) <= date '2024-01-14' as stored
        from events where event_type in ('purchase', 'signup') group by user_id, event_type, stored)"""
_STORE = "accountid, environment, divisioncode, userid, key_event, key_event_timestamp, inserteddatetime"

ORACLES = {
    "first_event_bounded": """
        with f as (select o_custkey, min(o_orderdate) as first_time,
                          case o_orderstatus when 'F' then 'finished' when 'O' then 'open' else 'planned' end as key_event
                   from orders group by o_custkey, o_orderstatus)
        select o_custkey, key_event, first_time from f
        where first_time <= timestamp '1995-06-01'
          and (key_event = 'planned' or (key_event = 'finished' and first_time > timestamp '1995-02-01')
               or (key_event = 'open' and first_time > timestamp '1995-03-01'))""",
    "first_event_unbounded": """
        select user_id, event_type as key_event, min(ts) as first_time from events
        where event_type in ('purchase', 'signup', 'error') group by user_id, event_type""",
    "holding_removed": """
        select * from customer where c_custkey not in (
            select o_custkey from orders where o_orderstatus = 'P' and o_orderdate >= timestamp '2000-01-01')""",
    "first_event_counters": oracle(("d_daily", "d_divisions", *_A_VIEWS), f"{_CTE_A} {_COUNTERS}"),
    "first_event_sales_invoice": oracle(
        ("d_summary", "d_divisions", *_A_VIEWS), f"{_CTE_A} {_INVOICES}"
    ),
    "first_event_like": oracle(("d_time_entries", "d_items", *_A_VIEWS), f"{_CTE_A} {_CONSULTS}"),
    "first_event_requested": oracle(("d_consult_requests", *_A_VIEWS), f"{_CTE_A} {_REQUESTS}"),
    "first_event_mobile": oracle(("d_activity", *_A_VIEWS), f"{_CTE_A} {_MOBILE}"),
    "first_event_linked": oracle(("d_links", *_A_VIEWS), f"{_CTE_A} {_LINKED}"),
    "newest_then_match": oracle(("d_divisions", "d_summary"), " " + _newest_sql(", d.divisioncode desc")),
    "key_event_merge": f"""{_MERGE_INPUT}
        select {_STORE} from firsts where stored and key_event = 'signup'
        union all
        select {_STORE} from (
            select *, row_number() over (partition by accountid order by key_event_timestamp desc) as rn
            from firsts where key_event = 'purchase') r where rn = 1""",
    "key_event_merge_first": f"""{_MERGE_INPUT}
        select {_STORE} from (
            select *, row_number() over (partition by accountid, key_event order by key_event_timestamp) as rn
            from firsts) r where rn = 1""",
    "salted_join": """select o_custkey, o_orderkey, o_totalprice, c_mktsegment
        from orders join customer on o_custkey = c_custkey""",
}
_EVERY = [
    *(_counter_sql(event) for event in COUNTER_EVENTS),
    _INVOICES,
    _CONSULTS,
    _REQUESTS,
    _MOBILE,
    _LINKED,
    _newest_sql(", d.divisioncode desc"),
]
EVERY_EVENT = oracle(
    tuple(EVENT_VIEWS), _CTE_A + " " + " union all ".join(f"select * from ({part})" for part in _EVERY)
)
ORACLES["key_events_all"] = EVERY_EVENT
