"""Latest records, cleaning, expressions, ingestion and small derived tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    add_missing_columns,
    cast_columns,
    clean_columns,
    drop_columns,
    rename_columns,
    suffix_columns,
    upper_trim,
)
from tidemark.functions.expressions import any_flag, dotted_code, lookup, number_before_colon, year_month
from tidemark.fixed_values import CONVERSION_STATUS
from tidemark.operators.latest import latest_record
from tidemark.operators.ordered import with_neighbours
from tidemark.plans.loaders import (
    CONTRACT_VIEW_COLUMNS,
    Loader,
    contact_free_view,
    contract_view,
    current_state,
    typed_log,
)
from tidemark.plans.lookups import (
    active_modules,
    conversion_source,
    latest_negative_answer,
    publish_log,
    startup_types,
)
from tidemark.plans.requests import RequestTable, latest_requests, request_table
from tidemark.queries.views import oracle, table, view
from tidemark.sources.ingest import snapshot
from tidemark.sources.tables import days_between

NEWEST = ["ts desc", "event_id desc"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def latest_per_user(spark, sf_dir):
    return latest_record(events(spark, sf_dir), ["user_id"], NEWEST, aggregate=True)


def latest_per_user_and_type(spark, sf_dir):
    return latest_record(events(spark, sf_dir), ["user_id", "event_type"], NEWEST, aggregate=True)


PURCHASES = Loader(
    keys=("user_id",),
    order=("ts desc",),
    clean="none",
    rename={"value": "amount"},
    drop=("props",),
    before="event_type = 'purchase'",
)


def latest_purchase(spark, sf_dir):
    return current_state(events(spark, sf_dir), PURCHASES, ["event_id desc"])


LAST_ORDER = Loader(
    keys=("o_custkey",),
    order=("o_orderdate desc",),
    clean="none",
    after="o_orderdate >= timestamp_ntz '2001-06-01'",
)


def last_order_since(spark, sf_dir):
    return current_state(table(spark, sf_dir, "orders"), LAST_ORDER, ["o_orderkey desc"])


def survey_answers(spark, sf_dir):
    answers = events(spark, sf_dir).select(
        F.concat(F.lit(" u"), "user_id").alias("accountid"),
        F.col("event_id").cast("string").alias("surveyresultid"),
        F.when(F.col("event_type") == "purchase", "0").otherwise("1").alias("questioncode"),
        (F.col("event_id") % 7).cast("string").alias("objectiveanswer"),
        (F.col("user_id") % 4).cast("string").alias("divisioncode"),
        F.col("ts").alias("createddate"),
        F.lit("NL").alias("environment"),
    )
    return latest_negative_answer(answers, ["surveyresultid desc"])


def clean_and_cast(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("  "), F.col("lang")).alias("lang"),
        F.concat(F.col("source"), F.lit(" ")).alias("source"),
        "n_chars",
        F.concat(F.col("n_chars").cast("string"), F.lit(".75")).alias("chars_text"),
        "text",
        F.length("text").alias("raw_length"),
    )
    cleaned = clean_columns(documents, ["lang"])
    typed = cast_columns(
        cleaned,
        {"long": ["doc_id", "n_*"], "integer": ["chars_text", "source"], "double": ["raw_length"]},
    )
    return rename_columns(typed, {"chars_text": "chars", "absent": "nothing"})


def schema_drift(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    widened = add_missing_columns(part, ["p_size", "p_weight", "p_height"], "bigint")
    raised = upper_trim(widened, ["p_name", "p_brand"])
    return suffix_columns(drop_columns(raised, ["p_retail*", "absent"]), "_older")


def contacts_removed(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_name": "email", "c_acctbal": "phone", "c_mktsegment": "segment"}
    )
    return contact_free_view(customer)


CONTRACT_SOURCES = {
    "id": "l_orderkey",
    "number": "l_linenumber",
    "account": "l_partkey",
    "startdate": "l_shipdate",
    "type": "l_returnflag",
    "contractevent": "l_linestatus",
}


def contract_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    filled = {n: F.col(CONTRACT_SOURCES.get(n, "l_quantity")) for n in CONTRACT_VIEW_COLUMNS}
    return contract_view(lines.withColumns(filled))


def activity_log_types(spark, sf_dir):
    log = events(spark, sf_dir).select(
        "event_id",
        F.col("ts").cast("string").alias("logdatetime"),
        F.col("props").alias("activitytype"),
        F.col("user_id").cast("string").alias("messagetype"),
    )
    return typed_log(log, "mail_intake")


def upload_log_types(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("string").alias("logdatetime"),
        (F.col("event_id") % 9).cast("string").alias("activitytype"),
        F.concat(F.col("user_id").cast("string"), F.lit(".75")).alias("fordivision"),
    )
    return typed_log(log, "scan_upload")


def scanning_log_types(spark, sf_dir):
    log = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("string").alias("logdatetime"),
        F.col("o_orderstatus").alias("messagestatusinternal"),
        F.col("o_custkey").cast("string").alias("pickedupduration"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey").cast("string")).alias("returnedduration"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".5")).alias("totalduration"),
        F.col("o_orderpriority").alias("remark"),
    )
    return typed_log(log, "scanning")


def code_parts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", dotted_code(F.col("o_orderkey").cast("string")).alias("requestcode"))


def status_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", lookup(F.col("p_size"), CONVERSION_STATUS).alias("status")
    )


def codes_in_text(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(
        F.concat(F.col("c_name"), F.lit(": x")).alias("comment")
    )
    urls = table(spark, sf_dir, "pages").select(F.col("url").alias("comment"))
    both = names.unionByName(urls)
    return both.select("comment", number_before_colon(F.col("comment")).alias("divisioncode"))


def startup_names(spark, sf_dir):
    summary = view(spark, sf_dir, "d_summary")
    return (
        summary.join(startup_types(spark), "startuptype")
        .groupBy("startuptype", "startuptypedescription")
        .agg(F.count(F.lit(1)).alias("divisions"))
    )


def daily_flags(spark, sf_dir):
    per_day = events(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.when(F.col("event_type") == "signup", 1)).alias("signups"),
        F.sum(F.when(F.col("event_type") == "error", 1)).alias("errors"),
        F.count(F.when(F.col("event_type") == "purchase", 1)).alias("purchases"),
    )
    return per_day.select(
        "user_id",
        "day",
        any_flag("signups", "errors", "purchases").alias("active"),
        year_month(F.col("day")).alias("yearmonth"),
    )


COPIED_AT = datetime(2024, 2, 1, 6, 0)
LANGUAGES = {"NL": "en", "FR": "fr", "DE": "de", "ES": "es"}


def ingested_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").withColumn("timestamp", F.lit(0))
    by_language = {env: documents.where(F.col("lang") == lang) for env, lang in LANGUAGES.items()}
    return snapshot(by_language, COPIED_AT)


def catch_up_days(spark, sf_dir):
    parts = ("y", "m", "d")
    dated = events(spark, sf_dir).withColumns(
        {"y": F.year("ts"), "m": F.month("ts"), "d": F.dayofmonth("ts")}
    )
    pending = days_between(dated, date(2024, 1, 20), date(2024, 1, 30), parts)
    return pending.groupBy(*parts).agg(F.count(F.lit(1)).alias("events"))


REQUEST_TABLES = [
    RequestTable(
        name=kind,
        condition=f"typeid = '{status}'",
        rename={"account": "accountid", "id": "requestid"},
        drop=["cigprocessed"],
        types={"timestamp": ["created"], "double": ["price"], "integer": ["hour"]},
        select=["requestid", "accountid", "requesthid", "requestcode", "created", "price", "hour"],
    )
    for kind, status in (("finished", "F"), ("planned", "P"))
]


def request_kinds(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), "o_custkey").alias("id"),
        F.concat(F.lit(" a"), F.col("o_custkey") % 50).alias("account"),
        F.col("o_orderstatus").alias("typeid"),
        F.col("o_orderkey").alias("requesthid"),
        F.col("o_orderdate").cast("string").alias("created"),
        F.col("o_totalprice").alias("price"),
        F.substring("o_orderpriority", 1, 1).alias("hour"),
        F.col("o_orderdate").cast("string").alias("cigcopytime"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("tie"),
        F.lit("False").alias("cigprocessed"),
    )
    latest = latest_requests(raw, REQUEST_TABLES, ["tie desc"])
    first, second = REQUEST_TABLES
    return (
        request_table(latest, first)
        .withColumn("kind", F.lit(first.name))
        .unionByName(request_table(latest, second).withColumn("kind", F.lit(second.name)))
    )


def published_clients(spark, sf_dir):
    clients = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.trunc("o_orderdate", "month")).alias("publishdate"),
        F.col("o_orderdate").alias("sysmodified"),
    )
    return publish_log(clients)


def described_conversions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    status = orders.select(
        F.when(F.col("o_custkey") % 2 == 0, " nl").otherwise("BE").alias("environment"),
        F.col("o_custkey").alias("division"),
        F.col("o_orderkey").alias("idkey"),
        (F.col("o_orderkey") % 41).alias("status"),
        F.lit("u").alias("userid"),
        F.col("o_orderpriority").alias("document"),
        (F.col("o_custkey") % 25).alias("conversionsource"),
        F.lit("/").alias("dirpath"),
        F.col("o_orderdate").alias("syscreated"),
        F.col("o_orderdate").alias("sysmodified"),
        F.col("o_orderdate").alias("cigcopytime"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("tie"),
    )
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    sources = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("n_nationkey").alias("id"),
        F.when(F.col("n_nationkey") % 5 < 4, "NL").otherwise("BE").alias("environment"),
        F.concat("n_name", F.lit("/"), "s_name").alias("descriptionsuffix"),
        F.lit("2020-01-01").alias("cigcopytime"),
        F.col("s_name").alias("tie"),
    )
    return conversion_source(status, sources, ["tie desc"], ["tie desc"])


def module_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    contracts = lines.select(
        F.lit("NL").alias("environment"),
        F.col("l_suppkey").alias("accountcode"),
        F.col("l_partkey").alias("itemcode"),
        F.col("l_shipdate").alias("eventdate"),
        F.when(F.col("l_returnflag") == "N", "Inflow").otherwise("Outflow").alias("inflowoutflow"),
        F.when(F.col("l_linestatus") == "O", "Module").otherwise("Package").alias("itemtype"),
        F.year("l_shipdate").alias("eventyear"),
        F.month("l_shipdate").alias("eventmonth"),
        year_month(F.col("l_shipdate")).alias("eventyearmonth"),
        F.col("l_linestatus").alias("eventtype"),
        F.col("l_returnflag").alias("eventdescription"),
        F.lit("item").alias("itemdescription"),
        F.col("l_extendedprice").alias("valuepermonth"),
        F.col("l_orderkey").alias("tie1"),
        F.col("l_linenumber").alias("tie2"),
    )
    supplier = table(spark, sf_dir, "supplier")
    summary = supplier.select(
        F.lit("NL").alias("environment"),
        F.col("s_suppkey").alias("accountcode"),
        F.col("s_nationkey").alias("latestcommpackage"),
        F.when(F.col("s_acctbal") < 0, 1).otherwise(0).alias("churned"),
    )
    accounts = supplier.select(
        F.lit("NL").alias("environment"),
        F.col("s_suppkey").alias("accountcode"),
        F.concat(F.lit("S"), "s_suppkey").alias("accountid"),
        F.when(F.col("s_suppkey") % 3 == 0, "EOL").otherwise("ZZZ").alias("accountclassificationcode"),
    )
    packages = table(spark, sf_dir, "nation").where(F.col("n_regionkey") < 3).select(
        F.lit("NL").alias("environment"), F.col("n_nationkey").alias("packagecode")
    )
    return active_modules(contracts, summary, accounts, packages, ["tie1 desc", "tie2 desc", "valuepermonth desc"])


def event_neighbours(spark, sf_dir):
    return with_neighbours(
        events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type"),
        ["user_id"],
        ["ts", "event_id"],
        position="position",
        previous={"before": ("event_type", F.lit("none"))},
        following={"after": ("event_type", F.lit("none"))},
    )


QUERIES = {
    "latest_record": latest_per_user,
    "latest_record_composite": latest_per_user_and_type,
    "latest_record_prefilter": latest_purchase,
    "latest_record_postfilter": survey_answers,
    "latest_record_cutoff": last_order_since,
    "clean_and_cast": clean_and_cast,
    "schema_drift": schema_drift,
    "contact_free_view": contacts_removed,
    "contract_view": contract_columns,
    "typed_log": activity_log_types,
    "typed_upload_log": upload_log_types,
    "typed_scanning_log": scanning_log_types,
    "dotted_code": code_parts,
    "status_names": status_names,
    "code_from_text": codes_in_text,
    "startup_names": startup_names,
    "any_flag": daily_flags,
    "ingest_union": ingested_documents,
    "watermark_catchup": catch_up_days,
    "typed_requests": request_kinds,
    "publish_log": published_clients,
    "conversion_source": described_conversions,
    "active_modules": module_lines,
    "neighbours": event_neighbours,
}

_LATEST = """
    select {columns} from (
        select *, row_number() over (partition by {keys} order by {order}) as rn from {source}
    ) r where rn = 1 {after}"""

_EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"

_CONVERSION_CASE = "case {c} " + " ".join(
    f"when {code} then '{name}'" for code, name in CONVERSION_STATUS.items()
) + " end"

ORACLES = {
    "latest_record": _LATEST.format(
        columns=_EVENT_COLUMNS, keys="user_id", order="ts desc, event_id desc", source="events", after=""
    ),
    "latest_record_composite": _LATEST.format(
        columns=_EVENT_COLUMNS,
        keys="user_id, event_type",
        order="ts desc, event_id desc",
        source="events",
        after="",
    ),
    "latest_record_prefilter": _LATEST.format(
        columns="event_id, ts, user_id, event_type, value as amount",
        keys="user_id",
        order="ts desc, event_id desc",
        source="events where event_type = 'purchase'",
        after="",
    ),
    "latest_record_cutoff": _LATEST.format(
        columns="o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
        keys="o_custkey",
        order="o_orderdate desc, o_orderkey desc",
        source="orders",
        after="and o_orderdate >= timestamp '2001-06-01'",
    ),
    "latest_record_postfilter": """
        select 'U' || user_id as accountid, cast(user_id % 4 as integer) as divisioncode,
               cast(event_id % 7 as integer) as objectiveanswer, ts as submitteddate,
               case event_id % 7 when 0 then 'My accountant does not work with EOL'
                    when 1 then 'Have not chosen accountant' when 2 then 'No need external accountant'
                    when 3 then 'Disallow accountant direct access' when 4 then 'Other reasons'
                    when 5 then 'Intend to link accountant but skip the step later (* This answer is not visible to the user)'
               end as objectiveanswerdescription
        from (select *, row_number() over (partition by user_id order by ts desc) as rn from events) r
        where rn = 1 and event_type = 'purchase'""",
    "clean_and_cast": """
        select doc_id, upper(lang) as lang, cast(null as integer) as source, n_chars,
               cast(n_chars as integer) as chars, trim(text, ' ') as text, cast(length(text) as double) as raw_length
        from documents""",
    "schema_drift": """
        select p_partkey as p_partkey_older, upper(trim(p_name)) as p_name_older,
               upper(trim(p_brand)) as p_brand_older, p_type as p_type_older, p_size as p_size_older,
               cast(null as bigint) as p_weight_older, cast(null as bigint) as p_height_older
        from part""",
    "contact_free_view": "select c_custkey, c_nationkey, c_mktsegment as segment from customer",
    "contract_view": "select "
    + ", ".join(f"{CONTRACT_SOURCES.get(n, 'l_quantity')} as {n}" for n in CONTRACT_VIEW_COLUMNS)
    + " from lineitem",
    "typed_log": """
        select event_id, ts as logdatetime, cast(null as integer) as activitytype,
               cast(user_id as integer) as messagetype from events""",
    "typed_upload_log": """
        select event_id, ts as logdatetime, cast(event_id % 9 as integer) as activitytype,
               cast(user_id as integer) as fordivision from events""",
    "typed_scanning_log": """
        select o_orderkey, cast(o_orderdate as timestamp) as logdatetime,
               try_cast(o_orderstatus as integer) as messagestatusinternal,
               cast(o_custkey as integer) as pickedupduration,
               cast(case when o_orderkey % 3 <> 0 then o_orderkey end as integer) as returnedduration,
               cast(o_custkey as integer) as totalduration, o_orderpriority as remark
        from orders""",
    "dotted_code": """
        select o_orderkey, substring(p, 1, 2) || '.' || substring(p, 3, 3) || '.' || substring(p, 6, 8) as requestcode
        from (select o_orderkey, lpad(cast(o_orderkey as varchar), 8, '0') as p from orders) t""",
    "status_names": f"select p_partkey, {_CONVERSION_CASE.format(c='p_size')} as status from part",
    "code_from_text": """
        select comment, try_cast(trim(regexp_extract(comment, '([0-9][^:]*):', 1)) as integer) as divisioncode
        from (select c_name || ': x' as comment from customer union all select url from pages) t""",
    "startup_names": oracle(
        ("d_summary",),
        """ select startuptype, case startuptype when 'E' then 'Empty' when 'X' then 'LegislationTemplate'
                when 'Y' then 'LegislationDemo' when 'A' then 'DivisionTemplate' when 'D' then 'DivisionCopy'
                when 'R' then 'DivisionReturn' when 'C' then 'Conversion' when 'U' then 'Unknown' end
                as startuptypedescription, count(*) as divisions
            from d_summary group by startuptype""",
    ),
    "any_flag": """
        select user_id, cast(ts as date) as day,
               max(case when event_type in ('signup', 'error', 'purchase') then 1 else 0 end) as active,
               max(cast(strftime(ts, '%Y%m') as integer)) as yearmonth
        from events group by user_id, cast(ts as date)""",
    "ingest_union": """
        select doc_id, text, lang, source, n_chars,
               case lang when 'en' then 'NL' when 'fr' then 'FR' when 'de' then 'DE' else 'ES' end as environment,
               '2024-02-01 06:00:00' as cigcopytime, 'False' as cigprocessed
        from documents where lang in ('en', 'fr', 'de', 'es')""",
    "watermark_catchup": """
        select year(ts) as y, month(ts) as m, day(ts) as d, count(*) as events from events
        where cast(ts as date) > date '2024-01-20' and cast(ts as date) <= date '2024-01-30'
        group by 1, 2, 3""",
    "typed_requests": """
        select 'C' || o_custkey as requestid, 'A' || (o_custkey % 50) as accountid,
               p as requesthid,
               substring(p, 1, 2) || '.' || substring(p, 3, 3) || '.' || substring(p, 6, 8) as requestcode,
               o_orderdate as created, o_totalprice as price,
               cast(substring(o_orderpriority, 1, 1) as integer) as hour,
               case o_orderstatus when 'F' then 'finished' else 'planned' end as kind
        from (select *, lpad(cast(o_orderkey as varchar), 8, '0') as p,
                     row_number() over (partition by o_orderstatus, o_custkey
                                        order by o_orderdate desc, o_orderkey desc) as rn
              from orders where o_orderstatus in ('F', 'P')) r
        where rn = 1""",
    "publish_log": """
        select coalesce(published, cast(changed as date)) as publishdate, o_custkey as oauthclientid,
               case when published is null then 'Unpublished' else 'Published' end as event
        from (select o_custkey,
                     case when o_orderstatus <> 'P' then cast(date_trunc('month', o_orderdate) as date) end as published,
                     min(o_orderdate) as changed
              from orders group by 1, 2) g""",
    "conversion_source": f"""
        with s as (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
                   from orders),
        t as (select n_nationkey, n_name || '/' || max(s_name) as label
              from supplier join nation on s_nationkey = n_nationkey
              where n_nationkey % 5 < 4 group by n_nationkey, n_name)
        select case when o_custkey % 2 = 0 then 'NL' else 'BE' end as environment,
               cast(o_custkey as integer) as divisioncode, cast(o_orderkey as varchar) as idkey,
               cast(o_orderkey % 41 as integer) as conversionstatuscode,
               {_CONVERSION_CASE.format(c='o_orderkey % 41')} as conversionstatusdescription,
               'u' as userid, o_orderpriority as documentid, cast(n_nationkey as integer) as conversionsource,
               label as conversionsourcedescription, '/' as dirpath, o_orderdate as syscreated,
               o_orderdate as sysmodified
        from s join t on n_nationkey = o_custkey % 25 where rn = 1""",
    "active_modules": """
        with newest as (
            select *, row_number() over (partition by l_suppkey, l_partkey
                order by l_shipdate desc, case when l_returnflag = 'N' then 'Inflow' else 'Outflow' end,
                         l_orderkey desc, l_linenumber desc, l_extendedprice desc) as rn
            from lineitem)
        select 'S' || s_suppkey as accountid, 'NL' as environment, s_suppkey as accountcode,
               cast(strftime(l_shipdate, '%Y%m') as integer) as eventyearmonth, year(l_shipdate) as eventyear,
               month(l_shipdate) as eventmonth, l_shipdate as eventdate, l_linestatus as eventtype,
               l_returnflag as eventdescription, 'Inflow' as inflowoutflow, l_partkey as itemcode,
               'item' as itemdescription, l_extendedprice as valuepermonth
        from newest join supplier on l_suppkey = s_suppkey
        where rn = 1 and l_returnflag = 'N' and l_linestatus = 'O' and s_acctbal >= 0 and s_suppkey % 3 = 0""",
    "neighbours": """
        select user_id, event_id, ts, event_type, row_number() over w as position,
               lag(event_type, 1, 'none') over w as before, lead(event_type, 1, 'none') over w as after
        from events window w as (partition by user_id order by ts, event_id)""",
}
