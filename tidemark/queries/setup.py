"""The master-data setup: every rule alone, and the whole cascade."""

from __future__ import annotations

from tidemark.functions.columns import upper_trim
from tidemark.plans import setup as rules
from tidemark.plans.setup import SETUP_COLUMNS, SetupSources, master_data_setup, save_moments
from tidemark.queries.views import oracle, view

TIES = ["copyno desc"]


def _setup(spark, sf_dir):
    return view(spark, sf_dir, "d_setup")


def added(spark, sf_dir):
    return rules.add_divisions(
        _setup(spark, sf_dir),
        view(spark, sf_dir, "d_divisions"),
        view(spark, sf_dir, "d_summary"),
        view(spark, sf_dir, "d_contract_summary"),
    )


def owners(spark, sf_dir):
    return rules.refresh_owner(_setup(spark, sf_dir), view(spark, sf_dir, "d_divisions"))


def accessed(spark, sf_dir):
    facts = rules.with_activity_facts(_setup(spark, sf_dir), view(spark, sf_dir, "d_activity"))
    return rules.first_accessed(facts).select(*SETUP_COLUMNS)


def temporary(spark, sf_dir):
    raw = upper_trim(view(spark, sf_dir, "d_raw_divisions"), ["environment"])
    return rules.temporary_divisions(_setup(spark, sf_dir), raw, TIES).select(*SETUP_COLUMNS)


def startup_types(spark, sf_dir):
    setup = _setup(spark, sf_dir)
    for code, name in STARTUP_RULES.items():
        setup = rules.by_startup_type(setup, code, name)
    return setup


def converted(spark, sf_dir):
    conversion, divisions = view(spark, sf_dir, "d_conversion"), view(spark, sf_dir, "d_divisions")
    return rules.conversions(_setup(spark, sf_dir), conversion, divisions)


def transferred(spark, sf_dir):
    requests = view(spark, sf_dir, "d_transfer_requests")
    executions = view(spark, sf_dir, "d_transfer_executions")
    return rules.transfers(_setup(spark, sf_dir), requests, executions)


def imported(spark, sf_dir):
    facts = rules.with_activity_facts(_setup(spark, sf_dir), view(spark, sf_dir, "d_activity"))
    return rules.imports(facts).select(*SETUP_COLUMNS)


def moments(spark, sf_dir):
    return save_moments(view(spark, sf_dir, "d_activity"))


def templates(spark, sf_dir):
    setup = rules.with_save_moments(_setup(spark, sf_dir), moments(spark, sf_dir))
    return rules.template_divisions(setup).select(*SETUP_COLUMNS)


def empty(spark, sf_dir):
    setup = rules.with_save_moments(_setup(spark, sf_dir), moments(spark, sf_dir))
    return rules.empty_divisions(setup).select(*SETUP_COLUMNS)


SOURCE_VIEWS = (
    "d_raw_divisions",
    "d_divisions",
    "d_summary",
    "d_contract_summary",
    "d_activity",
    "d_conversion",
    "d_transfer_requests",
    "d_transfer_executions",
)


def setup_sources(spark, sf_dir):
    """The setup table and the tables that its rules look at."""
    return _setup(spark, sf_dir), SetupSources(*[view(spark, sf_dir, name) for name in SOURCE_VIEWS])


def cascade(spark, sf_dir):
    setup, sources = setup_sources(spark, sf_dir)
    return master_data_setup(setup, sources, TIES)


STARTUP_RULES = {"Y": "Demo", "A": "AccountantTemplate", "D": "DivisionCopy"}

QUERIES = {
    "add_missing_keys": added,
    "owner_refresh": owners,
    "first_accessed": accessed,
    "temporary_divisions": temporary,
    "startup_rules": startup_types,
    "conversion_rule": converted,
    "transfer_rule": transferred,
    "import_rule": imported,
    "save_moments": moments,
    "template_rule": templates,
    "empty_rule": empty,
    "setup_cascade": cascade,
}

_COLUMNS = ", ".join(SETUP_COLUMNS)
_ON = "using (environment, divisioncode)"
_KIND, _STATE = "masterdatasetuptype", "masterdatasetupstatus"


def _assign(source: str, guard: str, **values: str) -> str:
    """Columns of the setup table with some overwritten where the guard holds."""
    columns = [
        f"case when {guard} then {values[c]} else p.{c} end as {c}" if c in values else f"p.{c}"
        for c in SETUP_COLUMNS
    ]
    return f"select {', '.join(columns)} from {source}"


def _add(p: str) -> str:
    return f"""select {_COLUMNS} from {p} union all
        select d.environment, d.divisioncode, c.accountcode, s.startuptype, d.syscreated,
               cast(s.templatedivision as integer), null, d.accountid, null, null, null, null, null
        from d_divisions d join d_contract_summary c on c.accountid = d.accountid
        join d_summary s on s.environment = d.environment and s.divisioncode = d.divisioncode
        where not exists (select 1 from {p} p where p.environment = d.environment and p.divisioncode = d.divisioncode)
          and (d.syscreated >= timestamp '2017-01-01'
               or case when c.hadtrial = 1 then c.firsttrialstartdate else c.firstcommstartdate end >= timestamp '2017-01-01')"""


def _owner(p: str) -> str:
    guard = "p.accountid <> d.accountid"
    return _assign(f"{p} p join d_divisions d {_ON}", guard, accountid="d.accountid")


def _facts(p: str, activities: str, value: str) -> str:
    return f"""(select p.environment, p.divisioncode, p.accountid, {value} from {p} p
        join d_activity a on a.accountid = p.accountid and a.divisioncode = p.divisioncode
                         and a.date >= p.divisioncreated
        where a.activityid in ({activities}) group by 1, 2, 3)"""


def _access(p: str) -> str:
    facts = _facts(p, "'1'", "min(a.date) as m")
    source = f"{p} p left join {facts} f using (environment, divisioncode, accountid)"
    return _assign(source, "p.divisionfirstaccessed is null", divisionfirstaccessed="f.m")


def _temporary(p: str) -> str:
    latest = """(select * from (
        select upper(trim(environment)) as environment, cast(code as integer) as divisioncode,
               cast(blockingstatus as integer) as b, row_number() over (
               partition by code order by cast(cigcopytime as timestamp) desc, copyno desc) as rn
        from d_raw_divisions) r where rn = 1)"""
    guard = f"p.{_KIND} is null and l.b >= 100"
    return _assign(f"{p} p left join {latest} l {_ON}", guard, masterdatasetuptype="'TemporaryDivision'")


def _startup(p: str, code: str, name: str) -> str:
    guard = f"p.{_KIND} is null and p.divisionstartuptypecode = '{code}'"
    return _assign(f"{p} p", guard, masterdatasetuptype=f"'{name}'")


def _conversion(p: str) -> str:
    targets = """(select * from (
        select c.environment, d.linkeddivision as divisioncode, c.syscreated, c.conversionstatusdescription as outcome,
               row_number() over (partition by c.environment, d.linkeddivision
                                  order by c.sysmodified desc, c.syscreated desc, c.conversionstatusdescription) as rn
        from d_conversion c join d_divisions d using (environment, divisioncode)
        where d.linkeddivision is not null) t where rn = 1)"""
    guard = f"""t.syscreated is not null and (p.{_KIND} is null or (p.{_KIND} = 'Conversion'
        and coalesce(p.{_STATE}, '-') not in ('Success', 'Failure')))"""
    status = """case t.outcome when 'csHandedOver' then 'Success' when 'csHandoverFailed' then 'Failure'
        else 'InProgress' end"""
    source = f"""{p} p left join {targets} t {_ON}
        where not exists (select 1 from d_conversion h where h.environment = p.environment
                          and h.divisioncode = p.divisioncode)"""
    return _assign(source, guard, masterdatasetuptype="'Conversion'", masterdatasetupstatus=status)


def _transfer(p: str) -> str:
    first = r"""(select * from (
        select *, row_number() over (partition by environment, divisioncode order by tr_created nulls first,
               tr_realized nulls first, etr_created nulls first, etr_realized nulls first, status desc,
               description nulls first) as rn
        from (select tr.environment,
                     try_cast(trim(regexp_extract(e.requestcomments, '([0-9][^:]*):', 1)) as integer) as divisioncode,
                     tr.created as tr_created, tr.realized as tr_realized, tr.status, e.description,
                     e.created as etr_created, e.realized as etr_realized
              from d_transfer_requests tr left join d_transfer_executions e on tr.requestid = e.relatedrequest) x) y
        where rn = 1)"""
    guard = f"""t.tr_created is not null and (p.{_KIND} is null or (p.{_KIND} = 'DivisionTransfer'
        and coalesce(p.{_STATE}, '-') not in ('Success', 'Failure', 'Rejected')))"""
    status = """case when t.description = 'Request To Transfer' then 'Success'
        when t.description = 'Error on Transfer' then 'Failure' when t.status = 5 then 'Rejected'
        when t.description is null then 'In Progress' end"""
    latest = """case when t.etr_realized is not null then t.etr_realized
        when t.status = 5 then t.tr_created end"""
    return _assign(
        f"{p} p left join {first} t {_ON}",
        guard,
        masterdatasetuptype="'DivisionTransfer'",
        masterdatasetupstatus=status,
        eventstarttime="t.etr_created",
        eventlatesttime=latest,
    )


def _import(p: str) -> str:
    facts = _facts(
        p,
        "'5304', '5335', '5304202', '5334202'",
        "min(a.date) as s, max(case when a.activityid in ('5304202', '5334202') then a.date end) as l",
    )
    guard = f"""(f.s is not null or f.l is not null) and (p.{_KIND} is null
        or (p.{_KIND} = 'XML/CSV_Import' and p.{_STATE} is distinct from 'Success')
        or p.{_KIND} in ('ExactTemplate', 'Empty'))"""
    return _assign(
        f"{p} p left join {facts} f using (environment, divisioncode, accountid)",
        guard,
        masterdatasetuptype="'XML/CSV_Import'",
        masterdatasetupstatus="case when f.l is not null then 'Success' else 'Started' end",
        eventstarttime="f.s",
        eventlatesttime="f.l",
    )


_SAVES = """select environment, accountcode, divisioncode, min(date) as firstsave,
        min(case when reached > 5 then date end) as fifthsave
    from (select *, sum(quantity) over (partition by accountcode, divisioncode order by date) as reached
          from d_activity) t
    where activityid = '511006' group by 1, 2, 3"""


def _saved(p: str, guard: str, name: str, many: str, some: str, none: str) -> str:
    status = f"""case when s.fifthsave is not null then '{many}' when s.firstsave is not null then '{some}'
        else '{none}' end"""
    return _assign(
        f"{p} p left join ({_SAVES}) s using (environment, accountcode, divisioncode)",
        guard,
        masterdatasetuptype=f"'{name}'",
        masterdatasetupstatus=status,
    )


def _template(p: str) -> str:
    guard = f"""(p.{_KIND} is null or (p.{_KIND} = 'XML/CSV_Import' and p.{_STATE} is distinct from 'Success'))
        and p.divisionstartuptypecode = 'X'"""
    return _saved(p, guard, "ExactTemplate", "GLChangesMade", "GLChangesStarted", "StandardTemplate")


def _empty(p: str) -> str:
    guard = f"p.{_KIND} is null and p.divisionstartuptypecode = 'E'"
    return _saved(p, guard, "Empty", "GLAccountsAdded", "GLAccountsStarted", "NoChanges")


def _steps(views: tuple[str, ...], *steps) -> str:
    text, previous = "", "d_setup"
    for number, step in enumerate(steps):
        text += f",\n s{number} as ({step(previous)})"
        previous = f"s{number}"
    return oracle((*views, "d_setup"), f"{text} select {_COLUMNS} from {previous}")


def _startup_step(code: str):
    return lambda p: _startup(p, code, STARTUP_RULES[code])


ORACLES = {
    "add_missing_keys": _steps(("d_divisions", "d_contract_summary", "d_summary"), _add),
    "owner_refresh": _steps((), _owner),
    "first_accessed": _steps(("d_activity",), _access),
    "temporary_divisions": _steps(("d_raw_divisions",), _temporary),
    "startup_rules": _steps((), *[_startup_step(code) for code in STARTUP_RULES]),
    "conversion_rule": _steps(("d_divisions", "d_conversion"), _conversion),
    "transfer_rule": _steps(("d_transfer_requests", "d_transfer_executions"), _transfer),
    "import_rule": _steps(("d_activity",), _import),
    "save_moments": oracle(("d_activity",), " " + _SAVES),
    "template_rule": _steps(("d_activity",), _template),
    "empty_rule": _steps(("d_activity",), _empty),
    "setup_cascade": _steps(
        SOURCE_VIEWS,
        _add,
        _owner,
        _access,
        _temporary,
        _startup_step("Y"),
        _conversion,
        _transfer,
        _import,
        _template,
        _startup_step("A"),
        _startup_step("D"),
        _empty,
    ),
}
