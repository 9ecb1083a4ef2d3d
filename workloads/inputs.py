"""Dirty inputs derived from the driver tables.

Each text is plain SQL that Spark and the comparison engine read alike; ``{table}`` marks a driver
table. Every row of the table takes part.
"""

from __future__ import annotations

INPUTS = {
    # Cells in the forms each cleaning rule meets.
    "money_txt": """
SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN '$ ' || n WHEN 1 THEN 'USD ' || n
  WHEN 2 THEN n || '.5K' WHEN 3 THEN 'Unknown' WHEN 4 THEN '0' WHEN 5 THEN '-' || n
  WHEN 6 THEN 'a ' || n || ' b 2017' WHEN 7 THEN '34.0M' WHEN 8 THEN '$1,200,000.50' WHEN 9 THEN 'N/A'
  WHEN 10 THEN '9999999999999999B' ELSE n END AS money_txt
FROM (SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS n FROM {orders}) t""",
    "date_txt": """
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN d
  WHEN 1 THEN substr(d,6,2) || '-' || substr(d,9,2) || '-' || substr(d,1,4)
  WHEN 2 THEN substr(d,9,2) || '/' || substr(d,6,2) || '/' || substr(d,1,4)
  WHEN 3 THEN '31/02/2022' WHEN 4 THEN substr(d,1,4) WHEN 5 THEN '' ELSE '25-04-2018' END AS date_txt
FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders}) t""",
    "metric_txt": """
SELECT event_id, v, CASE event_id % 8 WHEN 0 THEN 'Italian' WHEN 1 THEN '' WHEN 2 THEN replace(v,'.',',')
  WHEN 3 THEN 'in 2009, 2010' WHEN 4 THEN '-3' WHEN 5 THEN '99999999999' WHEN 6 THEN ' ' || substr(v,1,1)
  ELSE v END AS metric_txt
FROM (SELECT event_id, CAST(value AS STRING) AS v FROM {events}) t""",
    "status_txt": """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '  released-' WHEN 1 THEN 'Post  Production'
  WHEN 2 THEN '-Planned-' WHEN 3 THEN 'post-production' WHEN 4 THEN 'XYZ123' ELSE NULL END AS status_txt
FROM {orders}""",
    "comment_txt": """
SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN '   ' WHEN 'click' THEN ''
  ELSE event_type || ' ' || props END AS comment_txt
FROM {events}""",
    "list_txt": """
SELECT p_partkey, replace(p_name,' ', CASE p_partkey % 3 WHEN 0 THEN ' , ' WHEN 1 THEN '; ' ELSE '|' END)
  || ', 123, /' || p_brand || '.jpg, "' || upper(p_type) || '"' AS list_txt
FROM {part}""",
    "wide_cells": """
SELECT c_custkey AS key, '"' || c_name || ', Inc."' AS name, CASE c_custkey % 5 WHEN 0 THEN c_mktsegment || ',x,'
  WHEN 1 THEN '"' || c_mktsegment || ', said ""z"" "' WHEN 2 THEN 'a,"b, c",d' WHEN 3 THEN 'x"y' ELSE c_mktsegment END AS cell
FROM {customer}""",
    "credit_txt": """
SELECT p_partkey, replace(p_name,' ', CASE p_partkey % 3 WHEN 0 THEN ' , ' WHEN 1 THEN '; ' ELSE '|' END)
  || ', 6.1, X, N/A' AS actors, CASE WHEN p_size > 25 THEN NULL ELSE '"' || p_type || '"' END AS directors,
  CASE WHEN p_size > 40 THEN 'None' ELSE 'Mc' || p_brand || '|/' || p_brand || '.PNG' END AS writers,
  p_type || ' films, Inc.' AS companies
FROM {part}""",
    "rows_with_gaps": """
SELECT l_orderkey, l_linenumber, CAST(date_trunc('year', l_shipdate) AS DATE) AS loaded, l_quantity, l_extendedprice,
  CASE WHEN l_discount > 0.05 THEN NULL ELSE l_returnflag END AS l_returnflag,
  CASE WHEN l_tax > 0.04 THEN NULL ELSE l_linestatus END AS l_linestatus
FROM {lineitem}""",
    "week_values": """
SELECT o_orderpriority, CASE WHEN o_orderkey % 29 = 0 THEN 'no instant'
  ELSE CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS STRING) || ' '
    || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':09:02.5' END AS read_at,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM {orders}""",
    "rate_payload": """
SELECT CASE WHEN event_id % 17 = 0 THEN '{{"value": []}}' ELSE '{{"value": [{{"dataHoraCotacao": "' || CAST(CAST(ts AS DATE) AS STRING) || ' 13:09:02.5", "cotacaoCompra": '
  || CAST(value AS STRING) || '}}, {{"dataHoraCotacao": "' || CAST(CAST(ts AS DATE) AS STRING)
  || ' 10:00:00.0", "cotacaoCompra": ' || CAST(event_id AS STRING) || '.5}}]}}' END AS payload
FROM {events}""",
    # The raw movie catalogue: a movie is an order, its repeated raw rows are the order's lines.
    "raw_info": """
SELECT CAST(l_orderkey AS STRING) AS id, 'tt' || CAST(l_partkey AS STRING) AS tconst,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE 'Title ' || CAST(l_partkey AS STRING) END AS title,
  CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'Original ' || CAST(l_partkey AS STRING) END AS original_title,
  CASE l_linenumber % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'pt' ELSE NULL END AS original_language,
  CASE l_linenumber % 7 WHEN 0 THEN '31/02/2022'
    WHEN 1 THEN substr(d,6,2) || '-' || substr(d,9,2) || '-' || substr(d,1,4)
    WHEN 2 THEN substr(d,9,2) || '/' || substr(d,6,2) || '/' || substr(d,1,4)
    WHEN 3 THEN substr(d,1,4) ELSE d END AS release_date,
  CASE l_suppkey % 4 WHEN 0 THEN 'abc' WHEN 1 THEN ' ' || n || ' ' ELSE n END AS runtime,
  CASE l_partkey % 7 WHEN 0 THEN '  released-' WHEN 1 THEN 'Post  Production' WHEN 2 THEN '-Planned-'
    WHEN 3 THEN NULL ELSE 'Released' END AS status,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'About ' || l_returnflag || l_linestatus END AS overview,
  CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE 'Tag ' || l_returnflag END AS tagline,
  CAST(date_trunc('year', l_shipdate) AS DATE) AS ingestion_datetime
FROM (SELECT l.*, CAST(CAST(l_shipdate AS DATE) AS STRING) AS d,
  CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) AS n FROM {lineitem} l) t""",
    "raw_financials": """
SELECT CAST(l_orderkey AS STRING) AS id,
  CASE l_linenumber % 8 WHEN 0 THEN '$ ' || n WHEN 1 THEN 'USD ' || n WHEN 2 THEN '12.5K' WHEN 3 THEN 'Unknown'
    WHEN 4 THEN '0' WHEN 5 THEN '-' || n ELSE n END AS budget,
  CASE l_partkey % 9 WHEN 0 THEN '$21,200.50' WHEN 1 THEN '0.034M' WHEN 2 THEN 'a ' || n || ' b 2017'
    WHEN 3 THEN '9999999999999999B' ELSE n END AS revenue,
  CAST(date_trunc('year', l_shipdate) AS DATE) AS ingestion_datetime
FROM (SELECT l.*, CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) AS n FROM {lineitem} l) t""",
    "raw_metrics": """
SELECT CAST(l_orderkey AS STRING) AS id,
  CASE l_linenumber % 6 WHEN 0 THEN replace(v,'.',',') WHEN 1 THEN 'in 2009, 2010' WHEN 2 THEN '-3' ELSE v
    END AS popularity,
  CASE l_partkey % 5 WHEN 0 THEN '76.06' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE CAST(q % 11 AS STRING) || '.5'
    END AS vote_average,
  CASE l_suppkey % 9 WHEN 0 THEN 'Italian' WHEN 1 THEN '99999999999' WHEN 2 THEN '-5' ELSE CAST(q AS STRING)
    END AS vote_count,
  CASE l_partkey % 6 WHEN 0 THEN '10.0' WHEN 1 THEN NULL ELSE CAST(q % 10 AS STRING) || '.25' END AS averageRating,
  CASE WHEN l_suppkey % 8 = 0 THEN '100.0' ELSE CAST(l_partkey AS STRING) END AS numVotes,
  CAST(date_trunc('year', l_shipdate) AS DATE) AS ingestion_datetime
FROM (SELECT l.*, CAST(l_extendedprice AS STRING) AS v, CAST(floor(l_quantity) AS BIGINT) AS q FROM {lineitem} l) t""",
    "raw_credits": """
SELECT CAST(o_orderkey AS STRING) AS id,
  CASE o_orderkey % 6 WHEN 0 THEN 'Drama|War' WHEN 1 THEN 'Action; Comedy, 2013' WHEN 2 THEN 'Science Fiction , TV Movie'
    WHEN 3 THEN 'A night of storms., /x.jpg' WHEN 4 THEN NULL ELSE 'Drama' END AS genres,
  CASE WHEN o_custkey % 10 = 3 THEN NULL ELSE 'ACME ' || CAST(o_custkey % 53 AS STRING) || '; Best Films, Inc.'
    END AS production_companies,
  'dir ' || CAST(o_custkey % 97 AS STRING) || CASE WHEN o_orderstatus = 'F' THEN ' | "Ann McBee"' ELSE '' END AS directors,
  CASE o_orderstatus WHEN 'O' THEN 'N/A' WHEN 'F' THEN NULL ELSE 'Ann McBee' END AS writers,
  'actor ' || CAST(o_custkey % 211 AS STRING) || ', ACTOR ' || CAST(o_orderkey % 31 AS STRING)
    || '; 6.1|/a.jpg, X, mid NAME' AS cast
FROM {orders}""",
    "raw_reviews": """
SELECT CAST(user_id AS STRING) AS id, 'user ' || CAST(event_id % 3 AS STRING) AS nome,
  CASE event_id % 8 WHEN 0 THEN '15.0' WHEN 1 THEN CAST(event_id % 11 AS STRING) WHEN 2 THEN 'ruim' WHEN 3 THEN NULL
    WHEN 4 THEN CAST(event_id % 11 AS STRING) || '.0' WHEN 6 THEN 'N/A' ELSE CAST(event_id % 10 AS STRING) || '.5'
    END AS nota,
  CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN '   ' ELSE event_type END AS comentario
FROM {events}""",
    "raw_rates": """
SELECT CASE WHEN o_orderkey % 29 = 0 THEN 'no instant'
  ELSE CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS STRING) || ' '
    || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':09:02.5' END AS dataHoraCotacao,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL
    ELSE CAST(o_custkey % 10 AS DOUBLE) / CAST(5 AS DOUBLE) + CAST(4 AS DOUBLE) END AS cotacaoCompra
FROM {orders}""",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def input_sql(name: str) -> str:
    """The text with the driver tables under their own names."""
    return INPUTS[name].format(**{t: t for t in TABLES})
