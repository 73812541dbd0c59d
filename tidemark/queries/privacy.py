"""Deletion logs, erasure of history and masking on the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.fixed_values import CRM_ACCOUNT_COLUMN, MASKED_COLUMNS
from tidemark.operators.erasure import erase_history, mask_columns
from tidemark.plans.privacy import (
    deletion_log,
    erase_accounts,
    erase_crm_accounts,
    erase_crm_contacts,
    erase_crm_users,
    erase_persons,
    erase_users,
    mask_divisions,
    pending_ids,
    stale_history_files,
)
from tidemark.queries.views import oracle, table, view

AFTER, UNTIL = date(2024, 1, 5), date(2024, 1, 20)


def _toxic(spark, sf_dir):
    return table(spark, sf_dir, "labels").where(F.col("toxic") == 1)


def _toxic_users(spark, sf_dir, name="id"):
    return _toxic(spark, sf_dir).select((F.col("doc_id") % 150).alias(name))


def anonymised_labels(spark, sf_dir):
    raw = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.col("toxic").alias("isanonymized"),
        F.lit("2024").alias("ingestionyear"),
        F.lit("1").alias("ingestionmonth"),
        (F.col("doc_id") % 28 + 1).cast("string").alias("ingestionday"),
    )
    return deletion_log(raw, "accountid", AFTER, UNTIL)


def anonymised_persons(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        (F.col("c_acctbal") < 0).alias("isanonymized"),
        F.lit("2024").alias("ingestionyear"),
        F.lit("01").alias("ingestionmonth"),
        F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0").alias("ingestionday"),
    )
    return deletion_log(raw, "personid", AFTER, UNTIL)


def ids_to_erase(spark, sf_dir):
    return pending_ids(anonymised_labels(spark, sf_dir), date(2024, 1, 10), UNTIL)


def erased_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return erase_history(events, "user_id", _toxic_users(spark, sf_dir), ["ts desc", "event_id desc"])


def _event_history(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        (F.col("event_id") % 40).alias("person"),
        F.concat(F.lit("U"), (F.col("event_id") % 60).cast("string")).alias("userid__c"),
        F.col("ts").cast("string").alias("cigcopytime"),
        "event_id",
        "value",
    )


def erased_accounts(spark, sf_dir):
    return erase_accounts(_event_history(spark, sf_dir), _toxic_users(spark, sf_dir))


def erased_persons(spark, sf_dir):
    return erase_persons(_event_history(spark, sf_dir), _toxic_users(spark, sf_dir, "personid"))


def erased_users(spark, sf_dir):
    ids = _toxic(spark, sf_dir).select((F.col("doc_id") % 40).alias("personid"))
    return erase_users(_event_history(spark, sf_dir), ids)


def erased_crm_users(spark, sf_dir):
    persons = _toxic(spark, sf_dir).select((F.col("doc_id") % 200).alias("personid"))
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("personid"),
        F.concat(F.lit("U"), (F.col("c_custkey") % 60).cast("string")).alias("userid"),
    )
    return erase_crm_users(_event_history(spark, sf_dir), persons, users)


def erased_crm_contacts(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("U"), (F.col("o_orderkey") % 60).cast("string")).alias("userid__c"),
        F.col("o_orderdate").cast("string").alias("cigcopytime"),
        "o_orderkey",
    )
    persons = _toxic(spark, sf_dir).select((F.col("doc_id") % 20).alias("personid"))
    users = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("personid"),
        F.concat(F.lit("U"), (F.col("s_suppkey") % 60).cast("string")).alias("userid"),
    )
    return erase_crm_contacts(raw, persons, users, ties=["o_orderkey desc"])


def erased_crm_accounts(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        (F.col("o_orderkey") % 70).alias(CRM_ACCOUNT_COLUMN),
        F.col("o_orderdate").cast("string").alias("etlinserttime"),
        F.col("o_orderdate").cast("string").alias("lastmodifieddate"),
        "o_orderkey",
    )
    ids = _toxic(spark, sf_dir).select((F.col("doc_id") % 70).alias("accountid"))
    return erase_crm_accounts(raw, ids, ties=["o_orderkey desc"])


def redacted_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return mask_columns(documents, "doc_id", _toxic(spark, sf_dir).select("doc_id"), ["text", "source"])


def masked_divisions(spark, sf_dir):
    raw = view(spark, sf_dir, "d_raw_divisions").withColumns(
        {name: F.concat(F.lit(f"{name} "), "code") for name in MASKED_COLUMNS}
    )
    ids = _toxic(spark, sf_dir).select(F.concat(F.lit("A"), F.col("doc_id").cast("string")).alias("accountid"))
    return mask_divisions(raw, ids)


def files_to_rewrite(spark, sf_dir):
    history = table(spark, sf_dir, "events").withColumnsRenamed({"user_id": "id", "ts": "cigcopytime"})
    files = stale_history_files(history, _toxic_users(spark, sf_dir), ties=["event_id desc"])
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"))


QUERIES = {
    "deletion_log": anonymised_labels,
    "deletion_log_persons": anonymised_persons,
    "pending_ids": ids_to_erase,
    "erase_history": erased_events,
    "erase_accounts": erased_accounts,
    "erase_persons": erased_persons,
    "erase_users": erased_users,
    "erase_crm_users": erased_crm_users,
    "erase_crm_contacts": erased_crm_contacts,
    "erase_crm_accounts": erased_crm_accounts,
    "redact": redacted_documents,
    "mask_divisions": masked_divisions,
    "stale_files": files_to_rewrite,
}

_LOG = """select doc_id as accountid, 2024 as year, 1 as month, cast(doc_id % 28 + 1 as integer) as day
    from labels where toxic = 1 and doc_id % 28 + 1 > 5 and doc_id % 28 + 1 <= 20"""
_HISTORY = """(select user_id as id, event_id % 40 as person, 'U' || (event_id % 60) as userid__c, ts as cigcopytime,
    event_id, value, row_number() over (partition by user_id order by ts desc) as rn from events) h"""
_TOXIC = "(select doc_id % {n} from labels where toxic = 1)"


def _erased(listed: str, copytime: str = "cast(cigcopytime as varchar)") -> str:
    return f"""select id, person, userid__c, {copytime} as cigcopytime, event_id, value from {_HISTORY}
        where rn = 1 or not ({listed})"""


ORACLES = {
    "deletion_log": _LOG,
    "deletion_log_persons": """
        select c_custkey as personid, 2024 as year, 1 as month, cast(c_custkey % 28 + 1 as integer) as day
        from customer where c_acctbal < 0 and c_custkey % 28 + 1 > 5 and c_custkey % 28 + 1 <= 20""",
    "pending_ids": f"select distinct accountid from ({_LOG}) l where day > 10",
    "erase_history": f"""
        select event_id, ts, user_id, event_type, value, props from (
            select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) r
        where rn = 1 or user_id not in {_TOXIC.format(n=150)}""",
    "erase_accounts": _erased(f"id in {_TOXIC.format(n=150)}"),
    "erase_persons": _erased(f"id in {_TOXIC.format(n=150)}"),
    "erase_users": _erased(f"person in {_TOXIC.format(n=40)}"),
    "erase_crm_users": _erased(
        f"""userid__c in (select 'U' || (c_custkey % 60) from customer
            where c_custkey in {_TOXIC.format(n=200)})"""
    ),
    "erase_crm_contacts": f"""
        select id, userid__c, cast(d as varchar) as cigcopytime, o_orderkey from (
            select o_custkey as id, 'U' || (o_orderkey % 60) as userid__c, o_orderdate as d, o_orderkey,
                   row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
            from orders) r
        where rn = 1 or userid__c not in (
            select 'U' || (s_suppkey % 60) from supplier where s_suppkey in {_TOXIC.format(n=20)})""",
    "erase_crm_accounts": f"""
        select id, {CRM_ACCOUNT_COLUMN}, cast(d as varchar) as etlinserttime, cast(d as varchar) as lastmodifieddate, o_orderkey from (
            select o_custkey as id, o_orderkey % 70 as {CRM_ACCOUNT_COLUMN}, o_orderdate as d, o_orderkey,
                   row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
            from orders) r
        where rn = 1 or {CRM_ACCOUNT_COLUMN} not in {_TOXIC.format(n=70)}""",
    "redact": """
        select doc_id, case when t then '####' else text end as text, lang,
               case when t then '####' else source end as source, n_chars
        from (select d.*, doc_id in (select doc_id from labels where toxic = 1) as t from documents d) x""",
    "mask_divisions": oracle(
        ("d_raw_divisions",),
        " select code, environment, customer, blockingstatus, status, deleted, enddate, syscreated, sysmodified,"
        " cigcopytime, copyno, "
        + ", ".join(
            f"case when customer in (select 'A' || doc_id from labels where toxic = 1) then '####'"
            f" else '{name} ' || code end as {name}"
            for name in MASKED_COLUMNS
        )
        + " from d_raw_divisions",
    ),
    "stale_files": f"""
        select distinct 'events.parquet' as file from (
            select user_id, row_number() over (partition by user_id order by ts desc) as rn from events) r
        where rn > 1 and user_id in {_TOXIC.format(n=150)}""",
}
