"""DuckDB SQL for the registered queries, written from the row templates, not from the operators."""

from __future__ import annotations

from workload import bindings as b
from workload.queries import BUDGET, DIM, THRESHOLD

PLAIN = {name: name for name in b.TABLES}
NL = "chr(10)"


def template(text: str) -> str:
    return text.format(**PLAIN)


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def js(text: str) -> str:
    """A JSON string."""
    return f"to_json({text})::VARCHAR"


def clean(name: str) -> str:
    """A display name as identifier. Characters that never occur in the tables are left out."""

    def under(text: str, forbidden: str) -> str:
        return f"translate({text}, {literal(forbidden)}, '{'_' * len(forbidden)}')"

    symbols, digits = "-&%=+'\"<>#|!()*,/;[\\]^{}~.", "0123456789"
    middle, last = "-&%=+'\"<>#|!()/?[\\]^`{}~.*@$", "-&%=+:'\"<>#|!(),./@[\\]^{}~"
    first = f"substr({name}, 1, 1)"
    return f"""CASE WHEN length({name}) = 0 THEN {name} ELSE regexp_replace(
        CASE WHEN length({name}) = 1 THEN {under(under(name, symbols + digits), last)}
        ELSE (CASE WHEN {first} BETWEEN '0' AND '9' THEN '_' || {first} ELSE {under(first, symbols)} END)
             || {under(f"substr({name}, 2, greatest(length({name}) - 2, 0))", middle)}
             || {under(f"substr({name}, length({name}), 1)", last)} END, '_+', '_', 'g') END"""


ORACLE: dict[str, str] = {}

# Catalog

CATALOG = f"""
WITH line AS ({template(b.LINES)}), ord AS ({template(b.ORDERS)}), cust AS ({template(b.CUSTOMERS)}),
vw AS ({template(b.VIEWS)}),
tab AS (
    SELECT project_id, model AS table_name, table_type, note AS comment FROM ord
    UNION ALL SELECT project_id, model, 'BASE TABLE', c_name FROM cust),
col AS (
    SELECT project_id, model AS table_name, name AS column_name, ordinal AS ordinal_position, type AS data_type,
           NOT nullable AS not_null, note AS comment FROM line
    UNION ALL SELECT project_id, model, 'c_custkey', 1, 'int64', true, NULL FROM cust
    UNION ALL SELECT project_id, model, 'c_name', 2, 'varchar', false, NULL FROM cust
    UNION ALL SELECT project_id, model, 'c_mktsegment', 3, 'text', false, NULL FROM cust),
pk AS (
    SELECT project_id, model AS table_name, min((ordinal, name))[2] AS column_name FROM line GROUP BY ALL
    UNION ALL SELECT project_id, model, 'c_custkey' FROM cust),
rel AS (
    SELECT project_id, 'fk_' || okey AS name, model || ',' || customer AS models, 'MANY_TO_ONE' AS joinType,
           '"' || model || '".custkey = "' || customer || '".c_custkey' AS condition FROM ord)
"""

ORACLE["c1_tables"] = CATALOG + "SELECT project_id, table_name FROM tab WHERE table_type = 'BASE TABLE'"
ORACLE["c2_columns"] = (
    CATALOG + "SELECT project_id, table_name, column_name, ordinal_position, data_type, not_null FROM col"
)
ORACLE["c3_primary_keys"] = CATALOG + "SELECT * FROM pk"
ORACLE["c4_table_descriptions"] = (
    CATALOG
    + "SELECT project_id, table_name, coalesce(comment, '') AS table_description FROM tab WHERE table_type = 'BASE TABLE'"
)
ORACLE["c5_column_descriptions"] = (
    CATALOG
    + """SELECT project_id, table_name, column_name, coalesce(c.comment, '') AS column_description
         FROM col c JOIN tab t USING (project_id, table_name) WHERE table_type = 'BASE TABLE'"""
)
ORACLE["c6_relationships"] = CATALOG + "SELECT * FROM rel"
VIEW_PROPERTIES = "'{\"description\":\"View for ' || name || '\"}'"
ORACLE["c7_views"] = CATALOG + f"SELECT project_id, name, statement, {VIEW_PROPERTIES} AS properties FROM vw"

TEXT_COLUMNS = {
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"],
    "pages": ["url", "html"],
    "benchmark": ["text"],
    "conversations": ["role", "text"],
}
VALUES = " UNION ALL ".join(
    f"SELECT DISTINCT 'tables' AS project_id, '{t}' AS table_name, '{c}' AS column_name, {c} AS value "
    f"FROM {t} WHERE {c} IS NOT NULL"
    for t, columns in TEXT_COLUMNS.items()
    for c in columns
)
ORACLE["c8_unique_values"] = VALUES
ORACLE["c8_value_sizes"] = f"""
SELECT project_id, table_name, column_name, count(*) AS n_values, sum(strlen(value))::BIGINT AS n_bytes
FROM ({VALUES}) GROUP BY ALL"""

ORACLE["c9_build_mdl"] = (
    CATALOG
    + f""", val AS (
    SELECT project_id, model AS table_name, name AS column_name, '["' || value_1 || '","' || value_2 || '"]' AS list
    FROM line WHERE value_1 IS NOT NULL),
shown AS (
    SELECT c.project_id, table_name, ordinal_position, column_name,
           '{{"name":' || {js("column_name")} || ',"type":' || {js("data_type")} || ',"isCalculated":false,"notNull":'
           || not_null::VARCHAR
           || CASE WHEN comment IS NULL AND list IS NULL THEN '' ELSE ',"properties":{{' || concat_ws(',',
                  '"description":' || {js("comment")}, '"uniqueValues":' || list) || '}}' END || '}}' AS item
    FROM col c LEFT JOIN val USING (project_id, table_name, column_name)),
listed AS (
    SELECT project_id, table_name, string_agg(item, ',' ORDER BY ordinal_position, column_name) AS items
    FROM shown GROUP BY ALL)
SELECT project_id, 'model' AS kind, table_name AS name,
       '{{"name":' || {js("table_name")} || ',"tableReference":{{"schema":"public","table":' || {js("table_name")}
       || '}},"columns":[' || coalesce(items, '') || ']'
       || coalesce(',"primaryKey":' || {js("column_name")}, '')
       || CASE WHEN comment IS NULL THEN '' ELSE ',"properties":{{"description":' || {js("comment")} || '}}' END
       || '}}' AS shown
FROM tab LEFT JOIN listed USING (project_id, table_name) LEFT JOIN pk USING (project_id, table_name)
WHERE table_type = 'BASE TABLE'
UNION ALL
SELECT project_id, 'relationship', name,
       '{{"name":' || {js("name")} || ',"models":["' || replace(models, ',', '","') || '"],"joinType":"' || joinType
       || '","condition":' || {js("condition")} || '}}' FROM rel
UNION ALL
SELECT project_id, 'view', name, statement FROM vw"""
)
ORACLE["c10_write_and_read_mdl"] = (
    CATALOG
    + """SELECT project_id, table_name AS name, count(column_name)::INT AS n_columns
         FROM tab t LEFT JOIN col USING (project_id, table_name) WHERE table_type = 'BASE TABLE' GROUP BY ALL"""
)

ORACLE["c10_build_if_absent"] = (
    CATALOG
    + """SELECT t.project_id, t.table_name AS name, count(c.column_name)::INT AS n_columns,
                any_value(t.comment) || CASE t.project_id WHEN '1-URGENT' THEN '!' ELSE '' END AS description,
                CASE t.project_id WHEN '1-URGENT' THEN 2 ELSE 1 END AS n_builds
         FROM tab t LEFT JOIN col c ON c.project_id = t.project_id AND c.table_name = t.table_name
         WHERE table_type = 'BASE TABLE' GROUP BY t.project_id, t.table_name"""
)
ORACLE["c9_values_in_documents"] = VALUES

# MDL to documents

LINE_PIECES = f"""concat_ws(',',
    '"alias":' || {js(clean("display"))},
    '"description":' || {js("description")},
    '"uniqueValues":["' || value_1 || '","' || value_2 || '"]',
    '"nested_columns":{{"nested_part":"' || nested_part || '"}}',
    CASE WHEN json_type = 'JSON' THEN
        '"json_type":"JSON","json_fields":{{"json_type":"JSON","a_json_note":"' || a_json_note || '"}}' END)"""
CALCULATED = f"""CASE WHEN calculated THEN '-- This column is a Calculated Field' || {NL} || '  -- column expression: '
    || expression || {NL} || '  ' ELSE '' END"""

MODELS = f"""
WITH line AS ({template(b.LINES)}), ord AS ({template(b.ORDERS)}), cust AS ({template(b.CUSTOMERS)}),
vw AS (
    SELECT *, part_no::BIGINT * 4294967296 + row_number() OVER (PARTITION BY project_id, part_no ORDER BY vkey) - 1 AS pos
    FROM ({template(b.VIEWS)})),
met AS (
    SELECT *, part_no::BIGINT * 4294967296 + row_number() OVER (PARTITION BY project_id, part_no ORDER BY pkey) - 1 AS pos
    FROM ({template(b.METRICS)})),
model AS (
    SELECT *, part_no::BIGINT * 4294967296
              + row_number() OVER (PARTITION BY project_id, part_no ORDER BY kind, key) - 1 AS pos
    FROM (
        SELECT project_id, part_no, 0 AS kind, okey AS key, model AS name, coalesce(primary_key, '') AS pk,
               {clean("display")} AS alias, description FROM ord
        UNION ALL SELECT project_id, part_no, 1, ckey, model, 'c_custkey', '', '' FROM cust)),
allcol AS (
    SELECT project_id, model, 0 AS ordinal, 'custkey' AS name, 'int64' AS type, false AS hidden, false AS calculated,
           NULL AS expression, NULL AS relation, '' AS pieces FROM ord
    UNION ALL SELECT project_id, model, ordinal, name, type, hidden, calculated, expression, relation, {LINE_PIECES}
    FROM line
    UNION ALL SELECT project_id, model, 1, 'c_custkey', 'int64', false, false, NULL, NULL, '' FROM cust
    UNION ALL SELECT project_id, model, 2, 'c_name', 'text', false, false, NULL, NULL,
           '"description":' || {js("c_mktsegment")} || ',"uniqueValues":[' || {js("c_name")} || ']' FROM cust
    UNION ALL SELECT project_id, model, 3, 'c_acctbal', 'float64', false, false, NULL, NULL, '' FROM cust),
commented AS (
    SELECT *, CASE WHEN pieces = '' THEN '' ELSE '-- {{' || pieces || '}}' || {NL} || '  ' END AS properties_comment,
           {CALCULATED} AS calculated_comment FROM allcol),
own AS (
    SELECT c.project_id, c.model, c.name, c.type AS data_type, c.name = m.pk AS is_primary_key,
           properties_comment || calculated_comment AS comment,
           row_number() OVER (PARTITION BY c.project_id, c.model ORDER BY ordinal, c.name) - 1 AS rn
    FROM commented c JOIN model m ON c.project_id = m.project_id AND c.model = m.name
    WHERE NOT hidden AND relation IS NULL),
sizes AS (SELECT project_id, model, count(*) AS n_columns FROM own GROUP BY ALL),
link AS (
    SELECT *, part_no::BIGINT * 4294967296 + row_number() OVER (PARTITION BY project_id, part_no ORDER BY okey) - 1 AS rel_pos
    FROM ord),
fk AS (
    SELECT project_id, model, rel_pos, 'FOREIGN KEY (custkey) REFERENCES ' || customer || '(c_custkey)' AS fk_constraint,
           relation, join_type, model || ',' || customer AS tables, true AS source
    FROM link WHERE join_type <> 'MANY_TO_MANY'
    UNION ALL
    SELECT project_id, customer, rel_pos, 'FOREIGN KEY (c_custkey) REFERENCES ' || model || '('
           || coalesce(primary_key, '') || ')', relation, join_type, model || ',' || customer, false
    FROM link WHERE join_type <> 'MANY_TO_MANY'),
fkc AS (
    SELECT fk.*, n_columns, '-- {{"condition": ' || relation || ', "joinType": ' || join_type || '}}' || {NL} || '  ' AS comment,
           n_columns + row_number() OVER (PARTITION BY project_id, model ORDER BY rel_pos) - 1 AS rn
    FROM fk JOIN sizes USING (project_id, model)),
command AS (
    SELECT project_id, model, rn, '{{"type":"COLUMN","comment":' || {js("comment")} || ',"name":' || {js("name")}
           || ',"data_type":' || {js("data_type")} || ',"is_primary_key":' || is_primary_key::VARCHAR || '}}' AS item
    FROM own
    UNION ALL
    SELECT project_id, model, rn, '{{"type":"FOREIGN_KEY","comment":' || {js("comment")} || ',"constraint":'
           || {js("fk_constraint")} || ',"tables":["' || replace(tables, ',', '","') || '"]}}' FROM fkc),
chunk AS (
    SELECT project_id, model AS name, (rn // 5)::INT AS chunk_no,
           '{{"type":"TABLE_COLUMNS","columns":[' || string_agg(item, ',' ORDER BY rn) || ']}}' AS content
    FROM command GROUP BY ALL),
quoted AS (
    SELECT *, CASE WHEN contains(description, '''') THEN '"' || description || '"' ELSE '''' || description || '''' END AS shown
    FROM model),
header AS (
    SELECT project_id, name, pos, {NL} || '/* {{''alias'': ''' || alias || ''', ''description'': ' || shown || '}} */' || {NL} AS comment
    FROM quoted),
vdoc AS (
    SELECT project_id, name, pos, '/* {{''description'': "' || description || '"}} */' || {NL} AS comment, statement FROM vw),
mdoc AS (
    SELECT project_id, name, pos, measure_type, dimension,
           {NL} || '/* This table is a metric */' || {NL} || '/* Metric Base Object: ' || base_object || ' */' || {NL} AS comment,
           '-- This column is a dimension' || {NL} || '  ' AS dimension_comment,
           '-- This column is a measure' || {NL} || '  -- expression: ' || expression || {NL} || '  ' AS measure_comment
    FROM met),
doc AS (
    SELECT project_id, name, 0 AS section, m.pos, 0 AS kind, chunk_no, 'TABLE_COLUMNS' AS payload, content
    FROM chunk JOIN model m USING (project_id, name)
    UNION ALL
    SELECT project_id, name, 0, pos, 1, 0, 'TABLE', '{{"type":"TABLE","comment":' || {js("comment")} || ',"name":' || {js("name")} || '}}'
    FROM header
    UNION ALL
    SELECT project_id, name, 1, pos, 0, 0, 'VIEW', '{{"type":"VIEW","comment":' || {js("comment")} || ',"name":' || {js("name")}
           || ',"statement":' || {js("statement")} || '}}' FROM vdoc
    UNION ALL
    SELECT project_id, name, 2, pos, 0, 0, 'METRIC', '{{"type":"METRIC","comment":' || {js("comment")} || ',"name":' || {js("name")}
           || ',"columns":[{{"type":"COLUMN","comment":' || {js("dimension_comment")} || ',"name":' || {js("dimension")}
           || ',"data_type":"text"}},{{"type":"COLUMN","comment":' || {js("measure_comment")}
           || ',"name":"price","data_type":"' || measure_type || '"}}]}}' FROM mdoc),
description AS (
    SELECT project_id, name, section, pos, payload,
           sha256(concat_ws('|', project_id, 'TABLE_DESCRIPTION', payload, pos, 0, name)) AS id,
           '{{"name":' || {js("name")} || ',"description":' || {js("description")} || ',"columns":' || {js("listed")} || '}}' AS content
    FROM (
        SELECT m.project_id, m.name, 0 AS section, pos, 'models' AS payload, description,
               string_agg(c.name, ', ' ORDER BY ordinal, c.name) AS listed
        FROM model m JOIN allcol c ON c.project_id = m.project_id AND c.model = m.name GROUP BY ALL
        UNION ALL SELECT project_id, name, 1, pos, 'metrics', '', '' FROM met
        UNION ALL SELECT project_id, name, 2, pos, 'views', description, '' FROM vw))
"""

ORACLE["m1_malformed_lists"] = """
SELECT 'list_' || event_id AS project_id,
  CASE WHEN props IS NULL THEN 'no JSON object' WHEN json_type(props::JSON) IN ('ARRAY', 'NULL') THEN 'accepted' ELSE 'models is no list' END AS reason,
  0 AS n_views FROM events
UNION ALL
SELECT 'view_' || event_id, CASE WHEN props IS NULL OR event_type IS NULL THEN 'no JSON object' ELSE 'accepted' END,
  CASE WHEN props IS NULL OR event_type IS NULL THEN 0 ELSE 1 END FROM events
UNION ALL
SELECT 'text_' || doc_id, CASE WHEN text IS NULL THEN 'accepted' WHEN text LIKE '[%' THEN 'accepted' ELSE 'metrics is no list' END, 0 FROM documents
"""

ORACLE["m1_validate_mdl"] = (
    MODELS
    + """
SELECT project_id, part_no, true AS accepted, count(*) FILTER (list = 'm')::INT AS n_models,
       count(*) FILTER (list = 'r')::INT AS n_relationships, count(*) FILTER (list = 'v')::INT AS n_views,
       count(*) FILTER (list = 'x')::INT AS n_metrics
FROM (SELECT project_id, part_no, 'm' AS list FROM model UNION ALL SELECT project_id, part_no, 'r' FROM ord
      UNION ALL SELECT project_id, part_no, 'v' FROM vw UNION ALL SELECT project_id, part_no, 'x' FROM met) GROUP BY ALL
UNION ALL SELECT 'event_' || event_id, 0, true, 0, 0, 0, 0 FROM events
UNION ALL SELECT 'doc_' || doc_id, 0, CASE WHEN json_valid(text) THEN json_type(text) = 'OBJECT' ELSE false END, 0, 0, 0, 0
FROM documents"""
)
ORACLE["m2_visible_columns"] = (
    MODELS + "SELECT project_id, model, name, type, calculated, expression, relation FROM allcol WHERE NOT hidden"
)
DISPLAY = """
SELECT 'part' AS source, p_partkey AS key, p_partkey || '. ' || p_name || '-' || p_type || ' ($)' AS name FROM part
UNION ALL SELECT 'page', page_id, url FROM pages
UNION ALL SELECT 'document', doc_id, text FROM documents
UNION ALL SELECT 'size', p_partkey, p_name || p_size FROM part"""
CLEANED = f"SELECT source, key, {clean('name')} AS cleaned FROM ({DISPLAY})"
ORACLE["m3_clean_display_names"] = CLEANED
ORACLE["m3_name_collisions"] = f"SELECT source, cleaned, count(*) AS n FROM ({CLEANED}) GROUP BY ALL HAVING count(*) > 1"
ORACLE["m4_properties_comments"] = (
    MODELS + "SELECT project_id, model, name, properties_comment AS comment FROM commented"
)
ORACLE["m5_calculated_comments"] = (
    MODELS + "SELECT project_id, model, name, properties_comment || calculated_comment AS comment FROM commented"
)
ORACLE["m6_table_headers"] = MODELS + "SELECT project_id, name, pos, content FROM doc WHERE payload = 'TABLE'"
ORACLE["m7_column_commands"] = (
    MODELS + "SELECT project_id, model, rn::INT AS place, name, data_type, is_primary_key, comment FROM own"
)
RELATION = "project_id, model, rel_pos, n_columns::INT AS n_columns, fk_constraint AS \"constraint\", comment, tables"
ORACLE["m8_relationship_commands"] = (
    MODELS
    + f"SELECT 'reference' AS mode, {RELATION} FROM fkc UNION ALL SELECT 'source_only', {RELATION} FROM fkc WHERE source"
)
ORACLE["m9_column_chunks"] = MODELS + "SELECT project_id, name, chunk_no, content FROM chunk"
ORACLE["m10_document_order"] = (
    MODELS
    + """SELECT project_id, name, repeat('TABLE_COLUMNS,', count(*) FILTER (payload = 'TABLE_COLUMNS')) || 'TABLE' AS kinds
         FROM doc WHERE section = 0 GROUP BY ALL"""
)
ORACLE["m11_view_documents"] = MODELS + "SELECT project_id, name, pos, content FROM doc WHERE payload = 'VIEW'"
ORACLE["m12_metric_documents"] = MODELS + "SELECT project_id, name, pos, content FROM doc WHERE payload = 'METRIC'"
ORACLE["m13_schema_documents"] = (
    MODELS
    + """SELECT sha256(concat_ws('|', project_id, 'TABLE_SCHEMA', payload, pos, chunk_no, name)) AS id, project_id,
                'TABLE_SCHEMA' AS type, name, section, pos, kind, chunk_no, content FROM doc"""
)
ORACLE["m14_table_descriptions"] = (
    MODELS + "SELECT id, project_id, 'TABLE_DESCRIPTION' AS type, name, section, pos, content FROM description"
)

# Embedding

ONE_LINE = "replace(coalesce(text, ''), chr(10), ' ')"
ORACLE["e1_embeddable_texts"] = f"SELECT doc_id::VARCHAR AS id, {ONE_LINE} AS prepared FROM documents"


def word_slots(key: str, text: str, source: str) -> str:
    """Hashed word counts per text, scaled to length one and stored as 32-bit floats."""
    return f"""
SELECT {key}, slot, (n / sqrt(sum(n * n) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS value
FROM (SELECT {key}, (('0x' || substr(md5(word), 1, 8))::BIGINT % {DIM})::INT AS slot, count(*) AS n
      FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM {source})
      GROUP BY ALL)"""


ORACLE["e2_embed_documents"] = f"""
SELECT id, slot, round(value, 5) AS value
FROM ({word_slots("id", "content", "(SELECT doc_id::VARCHAR AS id, text AS content FROM documents)")})"""

QUESTIONS = """
SELECT t.conv_id::VARCHAR AS query_id,
       coalesce(string_agg(t.text, chr(10) ORDER BY t.turn) FILTER (t.turn < l.last), '') || chr(10)
       || max(t.text) FILTER (t.turn = l.last) AS question
FROM conversations t JOIN (SELECT conv_id, max(turn) AS last FROM conversations WHERE role = 'user' GROUP BY 1) l
  ON t.conv_id = l.conv_id
WHERE role = 'user' GROUP BY 1"""
ORACLE["e3_question_texts"] = (
    f"SELECT query_id, question, replace(question, chr(10), ' ') AS prepared FROM ({QUESTIONS})"
)
ORACLE["e3_embed_questions"] = f"""
SELECT query_id, slot, round(value, 5) AS value FROM ({word_slots("query_id", "question", f"({QUESTIONS})")})"""

# Document store

DOCUMENTS = "SELECT doc_id::VARCHAR AS id, lang AS project_id, text AS content, source FROM documents"
IN_LANGUAGES = """((lang IN ('en', 'de') AND source IN ('src1', 'src2', 'src3', 'src4', 'src5')) OR lang = 'fr')"""
ORACLE["d1_write_and_read_store"] = (
    "SELECT doc_id::VARCHAR AS id, lang AS project_id, 'doc_' || doc_id AS name, text AS content, source FROM documents"
)
ORACLE["d2_filter_documents"] = (
    f"SELECT doc_id::VARCHAR AS id, lang AS project_id, text AS content FROM documents WHERE {IN_LANGUAGES}"
)
K = "(props->>'$.k')::INT"
ORACLE["d2_filter_json_meta"] = (
    f"SELECT event_id, user_id, value FROM events WHERE {K} BETWEEN 10 AND 39 AND event_type = 'click'"
)
UPSERT = """
WITH incoming AS (
    SELECT user_id::VARCHAR AS id, 'USERS' AS project_id,
           arg_max(event_type || '|' || event_id || '|' || props, (ts, event_id)) AS content FROM events GROUP BY 1, 2)
SELECT c_custkey::VARCHAR AS id, c_mktsegment AS project_id, c_name AS content FROM customer
WHERE c_custkey::VARCHAR NOT IN (SELECT id FROM incoming)
UNION ALL SELECT * FROM incoming"""
ORACLE["d3_upsert"] = UPSERT
ORACLE["d3_upsert_store"] = UPSERT
ORACLE["d4_delete"] = (
    f"SELECT event_id, event_type, props FROM events WHERE NOT coalesce({K} BETWEEN 0 AND 49 OR event_type = 'error', false)"
)
ORACLE["d5_clean_project"] = """
SELECT doc_id::VARCHAR AS id, lang AS project_id, 'documents' AS store FROM documents WHERE lang <> 'en'
UNION ALL SELECT doc_id::VARCHAR, lang, 'labels' FROM documents JOIN labels USING (doc_id) WHERE lang <> 'en'"""
ORACLE["d4_delete_store"] = """
SELECT doc_id::VARCHAR AS id, lang AS project_id, text AS content FROM documents
WHERE NOT coalesce(lang = 'en' AND source = 'src1', false)"""
ORACLE["d5_clean_store"] = """
SELECT doc_id::VARCHAR AS id, lang AS project_id, text AS content FROM documents WHERE lang IS DISTINCT FROM 'en'"""
ORACLE["d6_replace_projects"] = """
SELECT doc_id::VARCHAR AS id, lang AS project_id, text AS content FROM documents WHERE lang = 'en'
UNION ALL SELECT 'b' || item_id, 'es', text FROM benchmark"""
ORACLE["d6_reindex_store"] = (
    MODELS
    + """SELECT project_id, 'TABLE_SCHEMA' AS type, count(*) AS n, count(*) AS n_ids, 0 AS n_embedded FROM doc GROUP BY ALL
         UNION ALL SELECT project_id, 'TABLE_DESCRIPTION', count(*), count(*), count(*) FROM description GROUP BY ALL"""
)
ORACLE["d7_query_by_filters"] = (
    f"SELECT doc_id::VARCHAR AS id, lang AS project_id, text AS content FROM documents WHERE {IN_LANGUAGES} "
    "ORDER BY lang, id LIMIT 25"
)

CENTROIDS = """
SELECT label::VARCHAR AS query_id, list(x ORDER BY slot) AS embedding, max(n) AS n
FROM (SELECT label, slot, round(avg(x::DOUBLE), 6)::FLOAT AS x, count(*) AS n
      FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS slot FROM embeddings)
      GROUP BY ALL) GROUP BY ALL"""
DISTANCE = "round(list_cosine_distance(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 12)"


def nearest(condition: str, k: int, query_id: str = "query_id") -> str:
    return f"""
SELECT {query_id} AS query_id, vec_id AS id, label,
       row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank, distance
FROM (SELECT query_id, vec_id, label, {DISTANCE} AS distance
      FROM ({CENTROIDS}) q JOIN embeddings d ON {condition})
QUALIFY rank <= {k}"""


HIT = "query_id, id, rank, round(distance, 6) AS distance, round(1 / (1 + distance), 6) AS score"
ORACLE["d8_vector_topk"] = f"SELECT {HIT} FROM ({nearest('true', 10)})"
ORACLE["d8_vector_topk_in_blocks"] = (
    f"SELECT {HIT} FROM ({nearest('label::VARCHAR = query_id', 10)}) UNION ALL "
    f"""SELECT {HIT} FROM ({nearest('true', 10, "'all_' || query_id")})"""
)
ORACLE["d9_retrieve_documents"] = f"""
SELECT {HIT}, 'v' || id AS content, label::VARCHAR AS meta FROM ({nearest('n >= 50 AND label::VARCHAR = query_id', 7)})
UNION ALL
SELECT label::VARCHAR, vec_id, (row_number() OVER (PARTITION BY label ORDER BY vec_id))::INT AS rank, NULL, NULL,
       'v' || vec_id, label::VARCHAR
FROM embeddings JOIN ({CENTROIDS}) ON label::VARCHAR = query_id WHERE n < 50 QUALIFY rank <= 7"""

# Retrieval

TABLE_HIT = "query_id, query_id AS project_id, 't_' || id AS name, rank, round(1 / (1 + distance), 6) AS score"
ORACLE["r1_tables_by_vector"] = f"SELECT {TABLE_HIT} FROM ({nearest('label::VARCHAR = query_id', 10)})"
ORACLE["r2_score_threshold"] = (
    f"SELECT {TABLE_HIT} FROM ({nearest('label::VARCHAR = query_id', 40)}) WHERE 1 / (1 + distance) >= {THRESHOLD}"
)

ASKED = """, asked AS (
    SELECT okey::VARCHAR AS query_id, project_id, unnest([model, customer]) AS name, status FROM ord)
"""
ORACLE["r3_tables_by_name"] = (
    MODELS
    + ASKED
    + """SELECT query_id, project_id, name, (row_number() OVER (PARTITION BY query_id ORDER BY pos))::INT AS rank
         FROM asked JOIN description USING (project_id, name)"""
)
ORACLE["r4_schema_chunks"] = (
    MODELS
    + ASKED
    + """SELECT query_id, project_id, name, pos, kind, chunk_no, truncated,
                (row_number() OVER (PARTITION BY query_id ORDER BY pos, kind, chunk_no))::INT AS rank
         FROM (SELECT *, kind = 1 OR nth = 1 OR counted <= 3 AS kept, bool_or(NOT kept) OVER (PARTITION BY query_id) AS truncated
         FROM (SELECT *, row_number() OVER (PARTITION BY query_id, project_id, name, kind ORDER BY pos, chunk_no) AS nth,
                      count(*) FILTER (kind = 0) OVER (PARTITION BY query_id ORDER BY pos, kind, chunk_no) AS counted
               FROM asked JOIN doc USING (project_id, name)))
         WHERE kept"""
)
ORACLE["r4_unscoped_hits"] = f"""
SELECT DISTINCT query_id, e.label::VARCHAR AS project_id, 't_' || e.vec_id % 7 AS name, e.vec_id AS ord
FROM ({nearest('true', 10)}) JOIN embeddings h ON h.vec_id = id
JOIN embeddings e ON e.label = h.label AND e.vec_id % 7 = h.vec_id % 7"""
ORACLE["r5_parse_meta"] = """
SELECT 'event' AS source, event_id AS key, len(json_keys(props))::INT AS n_keys, props->>'$.k' AS k FROM events
UNION ALL SELECT 'document', doc_id, 0, NULL FROM documents WHERE NOT json_valid(text)"""
ORACLE["r6_assemble_schemas"] = (
    MODELS
    + """, commands AS (
    SELECT project_id, model AS name, '[' || string_agg(item, ',' ORDER BY rn) || ']' AS commands FROM command GROUP BY ALL)
SELECT project_id, name, comment, commands FROM header JOIN commands USING (project_id, name)"""
)


def supported(data_type: str) -> str:
    return f"""CASE upper({data_type}) WHEN 'UUID' THEN 'VARCHAR' WHEN 'INT64' THEN 'BIGINT' WHEN 'FLOAT64' THEN 'DOUBLE'
        WHEN 'BIGNUMERIC' THEN 'NUMERIC' ELSE upper({data_type}) END"""


ORACLE["r7_supported_types"] = (
    MODELS + f"SELECT model, name, {supported('type')} AS supported FROM line"
)

JOINED = f"',' || {NL} || '  '"
DDL = f""", ddl_line AS (
    SELECT project_id, model AS name, name AS column_name, rn, true AS is_column, '' AS tables,
           comment || name || ' ' || {supported("data_type")} || CASE WHEN is_primary_key THEN ' PRIMARY KEY' ELSE '' END AS line,
           contains(comment, 'This column is a Calculated Field') AS calculated, data_type = 'json' AS json
    FROM own WHERE data_type <> 'unknown'
    UNION ALL SELECT project_id, model, NULL, rn, false, tables, comment || fk_constraint, false, false FROM fkc),
ddl AS (
    SELECT project_id, name, any_value(pos) AS pos,
           any_value(comment) || 'CREATE TABLE ' || name || ' (' || {NL} || '  '
           || coalesce(string_agg(line, {JOINED} ORDER BY rn), '') || {NL} || ');' AS table_ddl,
           coalesce(bool_or(calculated), false) AS has_calculated_field, coalesce(bool_or(json), false) AS has_json_field
    FROM header LEFT JOIN ddl_line USING (project_id, name)
    WHERE (project_id, name) IN (SELECT (project_id, model) FROM command)
    GROUP BY project_id, name),
vddl AS (
    SELECT project_id, name, pos, comment || 'CREATE VIEW ' || name || {NL} || 'AS ' || statement AS table_ddl FROM vdoc),
mddl AS (
    SELECT project_id, name, pos, comment || 'CREATE TABLE ' || name || ' (' || {NL} || '  ' || dimension_comment
           || dimension || ' TEXT' || CASE WHEN measure_type = 'unknown' THEN ''
              ELSE {JOINED} || measure_comment || 'price ' || {supported("measure_type")} END || {NL} || ');' AS table_ddl
    FROM mdoc)
"""
ORACLE["r8_table_ddl"] = (
    MODELS + DDL + "SELECT project_id, name, table_ddl, has_calculated_field, has_json_field FROM ddl"
)
ORACLE["r9_metric_ddl"] = MODELS + DDL + "SELECT project_id, name, table_ddl FROM mddl"
ORACLE["r10_view_ddl"] = MODELS + DDL + "SELECT project_id, name, table_ddl FROM vddl"


def tokens(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\n\\r]'))::BIGINT"


ORACLE["r11_token_estimates"] = f"""
SELECT 'page' AS source, page_id AS key, {tokens("html")} AS tokens FROM pages
UNION ALL SELECT 'document', doc_id, {tokens("text")} FROM documents"""

FOUND = f""", found AS (
    SELECT query_id, status, ddl.* FROM asked JOIN ddl USING (project_id, name)),
budget AS (
    SELECT query_id, any_value(status) AS status, {tokens("string_agg(table_ddl, ' ' ORDER BY pos)")} AS tokens,
           tokens > {BUDGET} OR any_value(status) <> 'O' AS needs_pruning,
           bool_or(has_calculated_field) AS has_calculated_field, false AS has_metric,
           bool_or(has_json_field) AS has_json_field
    FROM found GROUP BY query_id)
"""
ORACLE["r11_token_budget"] = MODELS + ASKED + DDL + FOUND + "SELECT * EXCLUDE (status) FROM budget"
ORACLE["r12_selection_prompts"] = (
    MODELS
    + ASKED
    + DDL
    + FOUND
    + f"""SELECT query_id, regexp_replace({NL} || '### Database Schema ###' || {NL} || {NL}
                 || string_agg({NL} || '    ' || table_ddl || {NL}, '' ORDER BY pos)
                 || {NL} || {NL} || '### INPUT ###' || {NL} || {NL}, '\\n{{3,}}', {NL} || {NL} || {NL}, 'g') AS prompt
          FROM found JOIN budget USING (query_id) WHERE needs_pruning GROUP BY query_id"""
)
ORACLE["r12_collapse_newlines"] = f"""
SELECT page_id, regexp_replace(regexp_replace(html, '[<>.]', {NL}, 'g'), '\\n{{3,}}', {NL} || {NL} || {NL}, 'g') AS body
FROM pages"""
SELECTED = """, selected AS (
    SELECT okey::VARCHAR AS query_id, model AS table_name, 'custkey' AS columns FROM ord WHERE status = 'F'
    UNION ALL SELECT okey::VARCHAR, customer, 'c_name' FROM ord WHERE status = 'F'
    UNION ALL SELECT okey::VARCHAR, customer, '' FROM ord WHERE status = 'O')
"""
ORACLE["r13_selected_columns"] = (
    MODELS
    + SELECTED
    + "SELECT * FROM selected UNION ALL SELECT okey::VARCHAR, 'rejected', '' FROM ord WHERE status = 'P'"
)

PRUNED = f""", allowed AS (SELECT query_id, list(table_name) AS tables FROM selected GROUP BY ALL),
pruned AS (
    SELECT query_id, f.project_id, f.name AS table_name, any_value(f.status) AS status, any_value(f.pos) AS pos,
           any_value(h.comment) || 'CREATE TABLE ' || f.name || ' (' || {NL} || '  '
           || coalesce(string_agg(line, {JOINED} ORDER BY rn) FILTER (keep), '') || {NL} || ');' AS table_ddl,
           coalesce(bool_or(calculated AND keep), false) AS has_calculated_field, false AS has_metric,
           coalesce(bool_or(json AND keep), false) AS has_json_field
    FROM (
        SELECT found.query_id, found.project_id, found.name, found.status, found.pos, l.line, l.rn, l.calculated, l.json,
               CASE WHEN l.is_column THEN s.columns = '' OR s.columns = l.column_name
                    ELSE list_has_all(a.tables, string_split(l.tables, ',')) END AS keep
        FROM found JOIN selected s ON s.query_id = found.query_id AND s.table_name = found.name
        JOIN allowed a ON a.query_id = found.query_id
        LEFT JOIN ddl_line l ON l.project_id = found.project_id AND l.name = found.name) f
    JOIN header h ON h.project_id = f.project_id AND h.name = f.name
    GROUP BY query_id, f.project_id, f.name)
"""
ORACLE["r14_pruned_results"] = (
    MODELS
    + ASKED
    + DDL
    + FOUND
    + SELECTED
    + PRUNED
    + "SELECT query_id, table_name, table_ddl, has_calculated_field, has_metric, has_json_field FROM pruned"
)
FINAL = f""", final AS (
    SELECT query_id, table_name, table_ddl, pos, has_calculated_field, has_json_field
    FROM pruned JOIN (SELECT query_id AS q, needs_pruning FROM budget) ON q = query_id WHERE needs_pruning
    UNION ALL
    SELECT query_id, name, table_ddl, pos, found.has_calculated_field, found.has_json_field
    FROM found JOIN (SELECT query_id AS q, needs_pruning FROM budget) ON q = query_id
    WHERE status = 'P' OR NOT needs_pruning)
"""
ORACLE["r15_results"] = (
    MODELS
    + ASKED
    + DDL
    + FOUND
    + SELECTED
    + PRUNED
    + FINAL
    + """SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY pos) - 1)::INT AS pos, table_name, table_ddl
         FROM final"""
)
ORACLE["r16_result_flags"] = (
    MODELS
    + ASKED
    + DDL
    + FOUND
    + SELECTED
    + PRUNED
    + FINAL
    + """SELECT okey::VARCHAR AS query_id, coalesce(bool_or(has_calculated_field), false) AS has_calculated_field,
                false AS has_metric, coalesce(bool_or(has_json_field), false) AS has_json_field
         FROM ord LEFT JOIN final ON query_id = okey::VARCHAR GROUP BY okey"""
)
ORACLE["r17_retrieve"] = (
    MODELS
    + DDL
    + f""", q AS ({word_slots("query_id", "question", f"({QUESTIONS})")}),
d AS ({word_slots("id", "content", "description")}),
dot AS (SELECT query_id, id, sum(q.value * d.value) AS dot FROM q JOIN d USING (slot) GROUP BY ALL),
qn AS (SELECT query_id, sqrt(sum(value * value)) AS norm FROM q GROUP BY ALL),
dn AS (SELECT id, sqrt(sum(value * value)) AS norm FROM d GROUP BY ALL),
ranked AS (
    SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round(1 - coalesce(dot, 0) / (qn.norm * dn.norm), 12), id) AS rank
    FROM qn CROSS JOIN dn LEFT JOIN dot USING (query_id, id) QUALIFY rank <= 10),
names AS (SELECT DISTINCT query_id, project_id, name FROM ranked JOIN description USING (id)),
chunks AS (
    SELECT query_id, doc.*, row_number() OVER (PARTITION BY query_id ORDER BY project_id, section, pos, kind, chunk_no) AS rank
    FROM names JOIN doc USING (project_id, name)),
texts AS (
    SELECT query_id, 0 AS section, min(rank) AS place, project_id, name, any_value(table_ddl) AS table_ddl
    FROM chunks JOIN ddl USING (project_id, name) WHERE chunks.section = 0 GROUP BY ALL
    UNION ALL SELECT query_id, 1, rank, project_id, name, table_ddl FROM chunks JOIN vddl USING (project_id, name) WHERE section = 1
    UNION ALL SELECT query_id, 1, rank, project_id, name, table_ddl FROM chunks JOIN mddl USING (project_id, name) WHERE section = 2)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY section, place, project_id) - 1)::INT AS pos,
       name AS table_name, table_ddl FROM texts"""
)
