"""Every current-state loader on a raw table derived from the orders.

The raw table of a loader is built by rule from the column names of its sheet: identifiers
in mixed case with spaces, text that is not always readable as its type, and
about ten copies per identifier. The SQL is made from the sheet as well, not from the loader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.loaders import INGESTION_COLUMNS, LOADERS, Loader, current_state
from tidemark.queries.loader_sheets import SHEETS
from tidemark.queries.views import sql_text, table

TIE = "copyno"
SOMETIMES_TYPED = ("syscreated", "sysmodified", "startdate", "enddate", "division", "descriptiontermid", "isnew")

RAW_VALUES = {
    "identifier": "case when o_orderkey % 2 = 0 then ' ab' || cast(o_custkey as string)"
    " else 'AB' || cast(o_custkey as string) || ' ' end",
    "environment": "case o_orderkey % 3 when 0 then ' nl' when 1 then 'US' else 'NL ' end",
    "copytime": "cast(o_orderdate + interval 20 year as string)",
    "timestamp": "case when o_orderkey % 17 = 0 then 'n/a'"
    " else ' ' || cast(o_orderdate + interval 21 year as string) end",
    "date": "case when o_orderkey % 17 = 1 then 'n/a'"
    " else cast(cast(o_orderdate + interval 21 year as date) as string) end",
    "integer": "case when o_orderkey % 11 = 0 then 'abc' when o_orderkey % 13 = 0 then '12.7'"
    " else cast(o_orderkey % 1000 as string) end",
    "boolean": "case o_orderkey % 6 when 0 then 'True' when 1 then 'false' when 2 then '1'"
    " when 3 then '0' when 4 then '' else 'x' end",
    "double": "case when o_orderkey % 11 = 1 then '-' else cast(o_orderkey as string) || '.5' end",
    "small": "cast(o_custkey % 500 as string)",
    "text": "' v' || cast(o_orderkey % 100 as string)",
}
RAW_VALUES["long"] = RAW_VALUES["integer"]


def raw_columns(name: str, loader: Loader) -> dict[str, str]:
    """Column name to the kind of raw value it gets."""
    kinds = {n: group for group, names in loader.types.items() for n in names}
    # Typed in some tables only; where a loader does not name them, their text has to come through.
    kinds.update({n: "timestamp" for n in SOMETIMES_TYPED if n not in kinds})
    for column in (*loader.rename, *(loader.select or ()), *loader.drop, *loader.trim):
        known = {new: old for old, new in loader.rename.items()}
        kinds.setdefault(known.get(column, column), "text")
    for key in loader.keys:
        kinds[key] = "small" if kinds.get(key, "text") in ("integer", "long") else "identifier"
    kinds.update({"cigcopytime": "copytime", "environment": "environment", TIE: TIE})
    if name == "blockingstatus":
        kinds["id"] = "small"
    kinds.update({part: part for part in INGESTION_COLUMNS})
    return kinds


def raw_sql(name: str, loader: Loader) -> str:
    special = {
        TIE: "cast(o_orderkey + 1000000000 as string)",
        "ingestionday": "1",
        "ingestionmonth": "2",
        "ingestionyear": "2020",
    }
    parts = []
    for column, kind in raw_columns(name, loader).items():
        value = special.get(kind) or RAW_VALUES[kind]
        if name == "saleshandoverdocument" and column == "type":
            value = "case when o_orderkey % 2 = 0 then '193' else '7' end"
        parts.append(f'{value} as {column}')
    return f"select {', '.join(parts)} from {{orders}}"


SQL_CASTS = {
    "timestamp": "try_cast({c} as timestamp)",
    "date": "try_cast({c} as date)",
    "integer": r"case when regexp_full_match(trim({c}), '[+-]?\d+(\.\d*)?')"
    " then try_cast(split_part(trim({c}), '.', 1) as integer) end",
    "long": r"case when regexp_full_match(trim({c}), '[+-]?\d+(\.\d*)?')"
    " then try_cast(split_part(trim({c}), '.', 1) as bigint) end",
    "boolean": "case when lower(trim({c})) in ('t', 'true', 'y', 'yes', '1') then true"
    " when lower(trim({c})) in ('f', 'false', 'n', 'no', '0') then false end",
    "double": "try_cast({c} as double)",
}


def oracle_statement(name: str, loader: Loader) -> str:
    kinds = raw_columns(name, loader)
    types = {n: group for group, names in loader.types.items() for n in names}
    typed = []
    for column in kinds:
        value = column
        if loader.clean == "all":
            value = f"trim(cast({column} as string))"
        if loader.clean != "none" and column in loader.upper:
            value = f"upper(trim(cast({column} as string)))"
        if column in loader.trim:
            value = f"trim({column})"
        if column in types:
            value = SQL_CASTS[types[column]].format(c=value)
        typed.append(f"{value} as {column}")
    before = f"where {loader.before}" if loader.before else ""
    order = ", ".join(f"{t} nulls last" if t.endswith("desc") else t for t in (*loader.order, f"{TIE} desc"))
    dropped = {*loader.drop, *INGESTION_COLUMNS}
    final = {old: new for old, new in loader.rename.items()}
    out = []
    for column in kinds:
        new = final.get(column, column)
        if new in dropped or (loader.select and new not in loader.select):
            continue
        value = column
        if new in loader.final_types.get("integer", ()):
            value = SQL_CASTS["integer"].format(c=column)
        out.append(f"{value} as {new}")
    after = f"and {loader.after}".replace("timestamp_ntz", "timestamp") if loader.after else ""
    return sql_text(f"""
        with raw as ({raw_sql(name, loader)}),
        typed as (select {', '.join(typed)} from raw),
        ranked as (select *, row_number() over (partition by {', '.join(loader.keys)} order by {order}) as rn
                   from typed {before})
        select {', '.join(out)} from ranked where rn = 1 {after}""")


def _query(name: str, loader: Loader):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = spark.sql(raw_sql(name, SHEETS[name]), orders=table(spark, sf_dir, "orders"))
        return current_state(raw, loader, [f"{TIE} desc"])

    return run


QUERIES = {f"load_{name}": _query(name, loader) for name, loader in LOADERS.items()}
ORACLES = {f"load_{name}": oracle_statement(name, SHEETS[name]) for name in LOADERS}
