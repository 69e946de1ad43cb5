"""Domain tables derived from star-schema test tables (orders, line items, events, ...).

Each table is one select over one test table, written in SQL that Spark and DuckDB read alike, so
the checks can state the same inputs in their own SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from covdrift.params import DrugRule, Messages, Params
from covdrift.schemas import SCHEMAS, conform, make_schema

AS_OF = date(2024, 1, 16)
AS_OF_TS = datetime(2024, 1, 16, 12, 0, 0)

# Rules that pick out a share of the test parts.
TEST_RULES = (
    DrugRule("XOLAIR", ("11", "12", "13"), "WIDGET", 21, 14, dispense_word="M"),
    DrugRule("FASENRA", ("21", "22"), "RING", 53, 81, dispense_word="M"),
    DrugRule("TEZSPIRE", ("31",), "BOLT", 55, 123, dispense_word="M"),
)

TEST_PARAMS = Params(
    as_of=AS_OF,
    as_of_ts=AS_OF_TS,
    rules=TEST_RULES,
    messages=Messages(staff_team="Lead; Backup | Desk"),
)


@dataclass(frozen=True)
class View:
    source: str
    columns: dict[str, str]
    where: str | None = None

    def sql(self) -> str:
        columns = ", ".join(f"{expr} AS {name}" for name, expr in self.columns.items())
        where = f" WHERE {self.where}" if self.where else ""
        return f"SELECT {columns} FROM {self.source}{where}"


# When a coverage row of the view below was last edited.
_EDITED = (
    "(case when o_orderkey % 3 = 0 then o_orderdate + interval 8400 day "
    "+ interval 1 day * (o_orderkey % 400) "
    "else o_orderdate + interval 8400 day + interval 1 hour * (o_orderkey % 24) end)"
)

VIEWS: dict[str, View] = {
    "billing_header": View("orders", {"tran_id": "o_orderkey", "patient_id": "o_custkey"}),
    "billing_detail": View(
        "lineitem",
        {
            "tran_id": "l_orderkey",
            "sr_id": "l_linenumber",
            "billing_id": "l_partkey",
            "service_date": "cast(l_shipdate as date) + 8600",
        },
    ),
    "billing_master": View(
        "part", {"billing_id": "p_partkey", "descr": "p_name || ' ' || p_type"}
    ),
    "patient_insurance": View(
        "orders",
        {
            "patient_id": "o_custkey",
            "sr_id": "o_orderkey",
            "insurance_id": "o_custkey % 100 + (case when o_orderkey % 4 = 0 then 1 else 0 end)",
            "insurance_no": "case when o_orderkey % 5 = 0 then 'I1' else 'I0' end",
            "membership_id": "case when o_orderkey % 6 = 0 then null "
            "else 'M' || cast(o_custkey % 50 as varchar(10)) end",
            "group_no": "case when o_orderkey % 7 = 0 then 'G1' else 'G0' end",
            "group_name": "o_orderpriority",
            "start_date": "case when o_orderkey % 11 = 0 then null "
            "else cast(o_orderdate as date) + 8400 end",
            "end_date": "case when o_orderkey % 3 = 0 then null "
            "else cast(o_orderdate as date) + 8700 end",
            "priority": "case when o_orderpriority in ('4-NOT SPECIFIED','5-LOW') "
            "then 'S' else 'P' end",
            "active": "case o_orderstatus when 'F' then 'N' when 'O' then 'Y' end",
            "created_date": "o_orderdate + interval 8400 day "
            "+ interval 1 hour * (o_orderkey % 24)",
            "changed_date": "case when o_orderkey % 3 = 0 then o_orderdate "
            "+ interval 8400 day + interval 1 day * (o_orderkey % 400) end",
        },
    ),
    "schedule_detail": View(
        "events",
        {
            "tran_id": "event_id",
            "forwhom_id": "user_id",
            "forwhom_name": "'Patient ' || cast(user_id as varchar(20))",
            "procedure_id": "case event_type when 'click' then 21 when 'view' then 53 "
            "when 'purchase' then 55 else 51 end",
            "schedule_date": "cast(ts as date)",
            "schedule_time": "substring(cast(ts as varchar(30)), 12, 8)",
            "office_id": "user_id % 25",
            "status": "event_type",
            "schedule_note": "props",
            "canceled_date": "case when event_id % 10 = 0 then ts end",
        },
    ),
    "patient_master": View(
        "customer",
        {
            "id": "c_custkey",
            "patient_no": "'P' || cast(c_custkey as varchar(20))",
            "lastname": "c_name",
            "firstname": "case when c_custkey % 9 = 0 then null else c_mktsegment end",
        },
    ),
    "office_master": View("nation", {"srno": "n_nationkey", "office_code": "n_name"}),
    "insurance_plan_master": View(
        "supplier", {"srno": "s_suppkey", "name": "s_name", "carrier_id": "s_nationkey"}
    ),
    "insurance_carrier_master": View("nation", {"srno": "n_nationkey", "name": "n_name"}),
    "todo": View(
        "orders",
        {
            "tran_id": "o_orderkey",
            "status": "case when o_orderkey % 7 = 2 then 'C' else 'G' end",
            "forwhom": "'P'",
            "forwhom_id": "o_custkey",
            "source": "case when o_orderkey % 7 = 1 then null else 'BIO_INS_CHANGE_PA' end",
            "todo_date": "cast(o_orderdate as date) + 8400",
            "todo_at": "'T'",
            "iteration": "1",
            "created_date": "o_orderdate + interval 8400 day",
            "createdby_id": "o_custkey % 7",
            "changedby_id": "o_custkey % 5",
        },
        "o_orderstatus = 'P' and o_orderkey % 7 in (0, 1, 2)",
    ),
    "tobe_done_detail": View(
        "orders",
        {"tran_id": "o_orderkey + 1000000", "todo_id": "o_orderkey"},
        "o_orderstatus = 'P' and o_orderkey % 14 in (0, 2)",
    ),
    "insurance_change": View(
        "events",
        {
            "patient_id": "user_id",
            "insurance_sr_id": "event_id",
            "membership_id": "cast(event_id % 100 as varchar(10)) || '}'",
            "insurance_no": "case when event_id % 2 = 0 then '' end",
            "insurance_change_ts": "ts",
        },
        "event_type = 'purchase'",
    ),
    "edit_log_header": View(
        "events",
        {
            "PK_1": "cast(user_id as varchar(20))",
            "PK_2": "cast(null as varchar(20))",
            "pk_3": "cast(event_id as varchar(20))",
            "old_values": "props",
            "new_values": "cast(null as varchar(20))",
            "column_detail": "cast(null as varchar(20))",
            "modified_by": "case when event_id % 6 = 0 then 'system' "
            "when event_id % 6 = 1 then '' "
            "when user_id % 20 < 15 then 'user' || cast(user_id % 20 as varchar(10)) "
            "else 'supplier n' || cast(user_id % 20 as varchar(10)) end",
            "modified_date": "ts",
        },
        "event_type in ('click','view')",
    ),
    "audit_trail": View(
        "events",
        {
            "user_name": "'user' || cast(user_id % 20 as varchar(10))",
            "tran_date": "ts",
            "sql_syntax": "case when event_id % 50 = 0 then 'update patient_insurance' "
            "else props end",
        },
        "event_type = 'error'",
    ),
    # Log entries near the coverage edits themselves: minutes before or after, some of them too far.
    "coverage_edit_log": View(
        "orders",
        {
            "PK_1": "case when o_orderkey % 4 = 0 then cast(o_custkey as varchar(20)) end",
            "PK_2": "cast(null as varchar(20))",
            "pk_3": "case when o_orderkey % 4 = 1 then cast(o_orderkey as varchar(20)) end",
            "old_values": "case when o_orderkey % 4 = 2 then 'member M' "
            "|| cast(o_custkey % 50 as varchar(10)) || ' before' end",
            "new_values": "case when o_orderkey % 4 = 3 then 'subscriber I' "
            "|| cast(o_orderkey % 3 as varchar(10)) || ' now' end",
            "column_detail": "'coverage'",
            "modified_by": "case when o_orderkey % 9 = 0 then 'system' "
            "when o_custkey % 20 < 15 then 'user' || cast(o_custkey % 20 as varchar(10)) "
            "else 'supplier n' || cast(o_custkey % 20 as varchar(10)) end",
            "modified_date": f"{_EDITED} + interval 1 minute * (o_orderkey % 25 - 12)",
        },
    ),
    "coverage_audit_trail": View(
        "orders",
        {
            "user_name": "'user' || cast(o_orderkey % 20 as varchar(10))",
            "tran_date": f"{_EDITED} + interval 1 second * (o_orderkey % 1500 - 750)",
            "sql_syntax": "case when o_orderkey % 30 = 0 then 'update patient_insurance set active' "
            "when o_orderkey % 3 = 1 then 'update x where patient = ' || cast(o_custkey as varchar(20)) "
            "else 'M' || cast(o_custkey % 50 as varchar(10)) end",
        },
        "o_orderkey % 2 = 0",
    ),
    "approval": View(
        "orders",
        {
            "patient_id": "o_custkey",
            "biologic_drug": "case o_custkey % 3 when 0 then 'XOLAIR' when 1 then 'FASENRA' "
            "else 'TEZSPIRE' end",
            "source_tran_id": "o_orderkey - o_orderkey % 64",
            "source_date": "cast(o_orderdate as date) + 8550",
            "event_ts": "o_orderdate + interval 8551 day + interval 1 hour * (o_orderkey % 64)",
            "pa_status": "case o_orderkey % 3 when 0 then 'REQUESTED' when 1 then 'APPROVED' "
            "else 'DENIED' end",
            "pa_expiration_date": "case when o_orderkey % 3 = 1 "
            "then cast(o_orderdate as date) + 8915 end",
        },
        "o_orderstatus = 'O'",
    ),
    "resolution": View(
        "orders",
        {
            "patient_id": "o_custkey",
            "biologic_drug": "case o_custkey % 3 when 0 then 'XOLAIR' when 1 then 'FASENRA' "
            "else 'TEZSPIRE' end",
            "source_event": "'APPROVAL'",
            "source_tran_id": "o_orderkey - o_orderkey % 64",
            "resolved_status": "case when o_orderkey % 2 = 0 then 'DONE' else 'NOT NEEDED' end",
            "resolved_by": "'user' || cast(o_orderkey % 20 as varchar(10))",
            "resolved_at": "o_orderdate + interval 8560 day",
        },
        "o_orderkey % 5 = 0",
    ),
    "emp_master": View(
        "supplier",
        {
            "empid": "s_suppkey",
            "user_name": "case when s_suppkey < 15 "
            "then 'USER' || cast(s_suppkey as varchar(10)) end",
            "firstname": "'Supplier'",
            "lastname": "'N' || cast(s_suppkey as varchar(10))",
        },
    ),
}


# Columns of the test tables that the views use.
SOURCES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}


def read_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    view = VIEWS[name]
    reader = spark.read.schema(make_schema(SOURCES[view.source]))
    rows = reader.parquet(f"{folder.rstrip('/')}/{view.source}.parquet")
    if view.where:
        rows = rows.where(view.where)
    rows = rows.selectExpr(*[f"{expr} AS {column}" for column, expr in view.columns.items()])
    return conform(rows, SCHEMAS[name]) if name in SCHEMAS else rows


class TestTables(dict):
    """Domain tables by name, each read on first use."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str) -> None:
        super().__init__()
        self._spark, self.folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        self[name] = read_view(self._spark, self.folder, name)
        return self[name]
