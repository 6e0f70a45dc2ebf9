"""Schemas of catalog tables, MDL documents, stored documents and their payloads."""

from pyspark.sql import Column
from pyspark.sql import functions as F

CATALOG = {
    "cat_tables": "project_id string, table_schema string, table_name string, table_type string, comment string",
    "cat_columns": (
        "project_id string, table_schema string, table_name string, column_name string, "
        "ordinal_position int, data_type string, is_nullable string, comment string"
    ),
    "cat_constraints": (
        "project_id string, table_schema string, table_name string, constraint_name string, constraint_type string"
    ),
    "cat_key_usage": (
        "project_id string, table_schema string, table_name string, constraint_name string, "
        "column_name string, ordinal_position int"
    ),
    "cat_constraint_columns": (
        "project_id string, table_schema string, table_name string, constraint_name string, column_name string"
    ),
    "cat_views": "project_id string, table_schema string, table_name string, view_definition string",
}

COLUMN_VALUES = "project_id string, table_name string, column_name string, value string"

# `properties` and `relationship` stay raw JSON text: their keys are open-ended and their order matters.
MDL_COLUMN = (
    "struct<name:string,type:string,isCalculated:boolean,notNull:boolean,isHidden:boolean,"
    "expression:string,relationship:string,properties:string>"
)
MDL_MODEL = (
    "struct<name:string,tableReference:struct<schema:string,table:string>,"
    f"columns:array<{MDL_COLUMN}>,primaryKey:string,properties:string>"
)
MDL_RELATIONSHIP = "struct<name:string,models:array<string>,joinType:string,condition:string>"
MDL_VIEW = "struct<name:string,statement:string,properties:string>"
MDL_METRIC = (
    "struct<name:string,baseObject:string,dimension:array<struct<name:string,type:string>>,"
    "measure:array<struct<name:string,type:string,expression:string>>,properties:string>"
)
# Values of a column beyond those of its properties; `place` counts them within their model.
MDL_VALUES = "struct<model:string,column:string,part:int,place:int,values:string>"
MDL = (
    f"struct<models:array<{MDL_MODEL}>,relationships:array<{MDL_RELATIONSHIP}>,"
    f"views:array<{MDL_VIEW}>,metrics:array<{MDL_METRIC}>,columnValues:array<{MDL_VALUES}>>"
)

# One union of all payload kinds; absent fields are null and leave no trace in the JSON.
COMMAND = (
    "struct<type:string,comment:string,name:string,data_type:string,is_primary_key:boolean,"
    "constraint:string,tables:array<string>>"
)
CONTENT = f"struct<type:string,comment:string,name:string,columns:array<{COMMAND}>,statement:string>"

# Position of a document within its project: models, views, metrics; then model order; then
# column chunks before the table header; then chunk number.
ORD = "struct<section:int,pos:bigint,kind:int,chunk_no:int>"

DOCUMENT = (
    f"id string, project_id string, type string, name string, ord {ORD}, content string, "
    "meta map<string,string>, embedding array<float>"
)

QUERIES = "query_id string, project_id string, query string, tables array<string>, enable_column_pruning boolean"
HISTORIES = "query_id string, turn int, question string"
REPLIES = "query_id string, reply string"
REPLY = (
    "struct<results:array<struct<table_name:string,table_selection_reason:string,"
    "table_contents:struct<chain_of_thought_reasoning:array<string>,columns:array<string>>>>>"
)


def empty_list(element: str) -> Column:
    """An empty array of the element type."""
    return F.from_json(F.lit("[]"), f"array<{element}>")
