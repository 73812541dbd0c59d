"""Domain tables derived from the test tables.

Each view is one SQL statement that Spark and other engines read alike. Views
may use earlier ones. All of them cover the whole test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def env(key: str) -> str:
    return f"case {key} % 3 when 0 then 'NL' when 1 then 'US' else 'BE' end"


ORDER_DIVISION = "cast(o_custkey * 10 + o_orderkey % 3 as int)"
# Orders are moved to the years the jobs were made for.
ORDER_TIME = "(o_orderdate + interval 20 year)"
SHIP_TIME = "(l_shipdate + interval 20 year)"

VIEWS: dict[str, str] = {
    "d_accounts": f"""
        select 'A' || cast(c_custkey as string) as accountid, {env('c_custkey')} as environment,
               'C' || cast(c_custkey as string) as accountcode,
               case c_mktsegment when 'BUILDING' then 'AC7' when 'AUTOMOBILE' then 'EOL'
                    when 'MACHINERY' then 'ACC' else 'ZZZ' end as accountclassificationcode
        from {{customer}}""",
    "d_contract_summary": f"""
        select {env('c_custkey')} as environment, 'C' || cast(c_custkey as string) as accountcode,
               'A' || cast(c_custkey as string) as accountid,
               cast(c_custkey % 2 as int) as hadtrial,
               case when c_custkey % 4 = 0 then 1 else 0 end as churned,
               'P' || cast(c_nationkey as string) as latestcommpackage,
               first_order + interval 20 year as firsttrialstartdate,
               last_order + interval 16 year as firstcommstartdate
        from {{customer}}
        left join (select o_custkey, min(o_orderdate) as first_order, max(o_orderdate) as last_order
                   from {{orders}} group by o_custkey) o on o_custkey = c_custkey
        where c_acctbal > 0""",
    "d_divisions": f"""
        select {env('o_custkey')} as environment, {ORDER_DIVISION} as divisioncode,
               'A' || cast(o_custkey as string) as accountid,
               min({ORDER_TIME}) as syscreated,
               case when o_custkey % 6 = 0 and o_orderkey % 3 = 0 then {ORDER_DIVISION} + 1
                    when o_custkey % 6 = 3 and o_orderkey % 3 = 2 then {ORDER_DIVISION} - 1
               end as linkeddivision
        from {{orders}} group by o_custkey, o_orderkey % 3""",
    "d_daily": f"""
        select {env('o_custkey')} as environment, {ORDER_DIVISION} as divisioncode,
               cast({ORDER_TIME} as date) as date,
               count(case when o_orderstatus = 'F' then 1 end) as accountcount,
               nullif(count(case when o_orderpriority = '1-URGENT' then 1 end), 0) as ingbankaccounts,
               nullif(count(case when o_orderpriority = '2-HIGH' then 1 end), 0) as rabobankaccounts,
               count(case when o_totalprice > 450000 then 1 end) as abnamrobankaccounts,
               count(case when o_totalprice < 50000 then 1 end) as bankentrycountmanual,
               count(case when o_totalprice between 100000 and 150000 then 1 end) as automaticbanklink,
               nullif(count(case when o_orderstatus = 'P' then 1 end), 0) as banktransactionsimport,
               count(case when o_orderpriority = '5-LOW' then 1 end) as opportunitycount,
               nullif(count(case when o_orderkey % 11 = 0 then 1 end), 0) as projecttypefixedprice,
               cast(null as bigint) as projecttypetimeandmaterial,
               count(case when o_orderkey % 13 = 0 then 1 end) as projecttypenonbillable,
               nullif(count(case when o_orderkey % 17 = 0 then 1 end), 0) as projecttypeprepaidhtb,
               count(case when o_orderkey % 19 = 0 then 1 end) as projecttypeprepaidretainer,
               count(case when o_orderkey % 5 = 0 then 1 end) as projectsalesinvoices,
               count(case when o_orderkey % 7 = 0 then 1 end) as purchaseentrycount,
               count(case when o_orderkey % 23 = 0 then 1 end) as projecttotaltimeentries
        from {{orders}} group by o_custkey, o_orderkey % 3, o_orderdate""",
    "d_summary": f"""
        select {env('o_custkey')} as environment, {ORDER_DIVISION} as divisioncode,
               substring('EXYADRCU', cast((o_custkey + o_orderkey % 3) % 8 + 1 as int), 1) as startuptype,
               cast(o_custkey % 9 as string) as templatedivision,
               min(case when o_orderstatus = 'P' then {ORDER_TIME} end) as salesinvoicefirstdate
        from {{orders}} group by o_custkey, o_orderkey % 3""",
    "d_activity": f"""
        select {env('o_custkey')} as environment, 'A' || cast(o_custkey as string) as accountid,
               'C' || cast(o_custkey as string) as accountcode, {ORDER_DIVISION} as divisioncode,
               case l_linenumber when 1 then '1' when 2 then '8' when 3 then '511006'
                    when 4 then '511006'
                    when 5 then case when l_quantity > 40 then '5304202' else '9' end
                    when 6 then case when l_quantity > 35 then '5304' else '9' end
                    else '9' end as activityid,
               {SHIP_TIME} as date,
               case when l_quantity > 30 then 1 else 0 end as quantity
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "d_time_entries": f"""
        select l_partkey as itemid, 'A' || cast(o_custkey as string) as accountid, {SHIP_TIME} as date
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "d_items": """
        select p_partkey as itemid,
               case when p_name like '%widget%' then 'X' || 'EOLCONSULT' || p_brand else p_name end as itemcode
        from {part}""",
    "d_consult_requests": f"""
        select {env('o_custkey')} as environment, 'A' || cast(o_custkey as string) as accountid,
               case o_orderstatus when 'F' then 'S' else o_orderstatus end as status,
               {ORDER_TIME} as created
        from {{orders}}""",
    "d_links": f"""
        select {env('o_custkey')} as environment, 'C' || cast(o_custkey as string) as accountcode,
               case o_orderstatus when 'P' then 'Accountant Linked' else 'Not Linked' end as linkstatus,
               cast({ORDER_TIME} as date) as date
        from {{orders}}""",
    "d_raw_divisions": f"""
        select cast({ORDER_DIVISION} as string) as code,
               case o_orderkey % 2 when 0 then lower({env('o_custkey')}) else {env('o_custkey')} || ' ' end as environment,
               'A' || cast(o_custkey as string) as customer,
               case o_orderstatus when 'F' then '101' when 'O' then '0' else '100' end as blockingstatus,
               case o_orderpriority when '1-URGENT' then '1' when '2-HIGH' then '0' when '3-MEDIUM' then '0'
                    when '4-NOT SPECIFIED' then '1' end as status,
               case when o_totalprice > 350000 then cast({ORDER_TIME} + interval 3 day as string) end as deleted,
               case when o_totalprice < 150000 then cast({ORDER_TIME} + interval 400 day as string) end as enddate,
               cast({ORDER_TIME} - interval 30 day as string) as syscreated,
               cast({ORDER_TIME} - interval 1 day as string) as sysmodified,
               cast({ORDER_TIME} as string) as cigcopytime,
               o_orderkey as copyno
        from {{orders}}""",
    "d_setup": f"""
        select environment, divisioncode, 'C' || substring(accountid, 2) as accountcode,
               substring('EXYADRCU', cast((divisioncode + 3) % 8 + 1 as int), 1) as divisionstartuptypecode,
               syscreated as divisioncreated, cast(null as int) as templatedivisioncode,
               cast(null as string) as notes,
               case when divisioncode % 5 = 0 then 'A1' else accountid end as accountid,
               case when divisioncode % 7 = 0 then syscreated + interval 1 day end as divisionfirstaccessed,
               case when divisioncode % 11 = 0 then syscreated end as eventstarttime,
               case when divisioncode % 11 = 0 then syscreated end as eventlatesttime,
               case divisioncode % 12 when 0 then 'Conversion' when 1 then 'DivisionTransfer'
                    when 2 then 'XML/CSV_Import' when 3 then 'ExactTemplate' when 4 then 'Empty' end as masterdatasetuptype,
               case divisioncode % 24 when 0 then 'InProgress' when 1 then 'Rejected' when 2 then 'Started'
                    when 14 then 'Success' when 12 then 'Success' end as masterdatasetupstatus
        from d_divisions where divisioncode % 3 <> 0""",
    "d_conversion": f"""
        select {env('o_custkey')} as environment, {ORDER_DIVISION} as divisioncode,
               min({ORDER_TIME}) as syscreated, max({ORDER_TIME}) as sysmodified,
               case o_custkey % 4 when 0 then 'csHandedOver' when 1 then 'csHandoverFailed'
                    when 2 then 'csReady' end as conversionstatusdescription
        from {{orders}}
        where (o_custkey % 6 = 0 and o_orderkey % 3 = 0) or (o_custkey % 6 = 3 and o_orderkey % 3 = 2)
        group by o_custkey, o_orderkey % 3""",
    "d_transfer_requests": f"""
        select 'R' || cast(o_orderkey as string) as requestid, {env('o_custkey')} as environment,
               cast(o_orderkey % 7 as int) as status, {ORDER_TIME} as created,
               case when o_orderkey % 2 = 0 then {ORDER_TIME} + interval 2 day end as realized
        from {{orders}} where o_orderpriority = '1-URGENT'""",
    "d_transfer_executions": f"""
        select 'R' || cast(o_orderkey as string) as relatedrequest,
               case when o_totalprice > 300000 then 'division ' || cast({ORDER_DIVISION} as string) || ' : moved'
                    else 'no number' end as requestcomments,
               case o_orderkey % 5 when 0 then 'Request To Transfer' when 1 then 'Error on Transfer'
                    when 2 then 'Other' end as description,
               {ORDER_TIME} + interval 1 day as created,
               case when o_orderkey % 3 = 0 then {ORDER_TIME} + interval 4 day end as realized
        from {{orders}} where o_orderpriority = '1-URGENT'""",
    "d_statistics": """
        select case user_id % 3 when 0 then ' nl' when 1 then 'US' else 'be ' end as environment,
               user_id as division, cast(max(ts) as string) as cigcopytime,
               extract(year from cast(ts as date)) as ingestionyear,
               extract(month from cast(ts as date)) as ingestionmonth,
               extract(day from cast(ts as date)) as ingestionday,
               cast(count(case when event_type = 'signup' then 1 end) as string) as banklinkscount,
               nullif(count(case when event_type = 'error' then 1 end), 0) as rabobanklinks,
               cast(null as bigint) as abnamrobanklinks,
               count(case when event_type = 'click' and value > 100 then 1 end) as ingbanklinks,
               count(case when event_type = 'purchase' then 1 end) as gltransactionscount,
               nullif(count(case when event_type = 'view' then 1 end), 0) as vattransactions,
               case when user_id % 2 = 0 then 0 end as accountcount,
               cast(user_id % 10 as string) as cashentryavglines,
               'x' as freetextfield_01,
               cast(cast(max(ts) as date) as string) as lastcollected
        from {events} group by user_id, cast(ts as date)""",
}

_USES = {"d_setup": ("d_divisions",)}


def with_views(*names: str) -> str:
    """A WITH clause for the named views and those they use."""
    ordered: list[str] = []
    for name in names:
        for needed in (*_USES.get(name, ()), name):
            if needed not in ordered:
                ordered.append(needed)
    return "with " + ",\n".join(f"{name} as ({VIEWS[name]})" for name in ordered)


def sql_text(text: str) -> str:
    """The statement with plain table names."""
    return text.format(**{name: name for name in BASE_TABLES})


def oracle(views: tuple[str, ...], rest: str) -> str:
    """A full statement: the views, then further WITH parts and the query."""
    return sql_text(with_views(*views)) + rest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame."""
    text = with_views(name)
    used = {t: table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(f"{text} select * from {name}", **used)
