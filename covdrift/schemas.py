"""Declared schemas of the domain tables. Nothing is inferred when tables are read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "string": StringType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
}


def make_schema(columns: str) -> StructType:
    """Schema of ``name type, ...``; parsed here so that importing needs no Spark session."""
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split()
        schema = schema.add(name, _TYPES[kind])
    return schema


SCHEMAS: dict[str, StructType] = {
    "billing_detail": make_schema("tran_id bigint, sr_id bigint, billing_id string, service_date date"),
    "billing_header": make_schema("tran_id bigint, patient_id bigint"),
    "billing_master": make_schema("billing_id string, descr string"),
    "patient_insurance": make_schema(
        "patient_id bigint, sr_id bigint, insurance_id bigint, insurance_no string, "
        "membership_id string, group_no string, group_name string, start_date date, "
        "end_date date, priority string, active string, created_date timestamp_ntz, "
        "changed_date timestamp_ntz"
    ),
    "schedule_detail": make_schema(
        "tran_id bigint, forwhom_id bigint, forwhom_name string, procedure_id int, "
        "schedule_date date, schedule_time string, office_id bigint, status string, "
        "schedule_note string, canceled_date timestamp_ntz"
    ),
    "patient_master": make_schema("id bigint, patient_no string, lastname string, firstname string"),
    "office_master": make_schema("srno bigint, office_code string"),
    "insurance_plan_master": make_schema("srno bigint, name string, carrier_id bigint"),
    "insurance_carrier_master": make_schema("srno bigint, name string"),
    "todo": make_schema(
        "tran_id bigint, tran_date date, status string, forwhom string, forwhom_name string, "
        "category_id int, todo string, todo_at string, todo_date date, todo_time string, "
        "tobe_doneby string, generated_by string, priority string, todo_by_multi_group string, "
        "assignto_flag string, forwhom_id bigint, ref_tran_id bigint, ref_sr_id bigint, "
        "note string, source string, is_auto string, created_date timestamp_ntz, "
        "changed_date timestamp_ntz, createdby_id bigint, changedby_id bigint, iteration int"
    ),
    "tobe_done_detail": make_schema(
        "tran_id bigint, todo_id bigint, todo_date date, todo_at string, iteration int, "
        "task_status string, show_date date, created_date timestamp_ntz, "
        "changed_date timestamp_ntz, createdby_id bigint, changedby_id bigint"
    ),
    "edit_log_header": make_schema(
        "PK_1 string, PK_2 string, pk_3 string, old_values string, new_values string, "
        "column_detail string, modified_by string, modified_date timestamp_ntz"
    ),
    "audit_trail": make_schema("user_name string, tran_date timestamp_ntz, sql_syntax string"),
    "emp_master": make_schema("empid bigint, user_name string, firstname string, lastname string"),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select exactly the columns of ``schema``, cast; a column the frame lacks becomes NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
