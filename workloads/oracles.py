"""The result of every query as SQL for the comparison engine, written apart from the operators.

Common steps are named sub-queries; a query lists the last ones it needs and gets the rest.
"""

from __future__ import annotations

import re

from lodestrata.plans import catalogue as c
from workloads.inputs import INPUTS, input_sql
from workloads.star import BATCH_DAYS, FEED_END, FEED_START, RATE_END, RATE_START, SECOND_BATCH, TODAY

# The accepted written forms of numbers and amounts.
DECIMAL = r"^-?\d+(\.\d+)?$"
INTEGER = r"^-?\d+$"
MONEY = (
    r"^(?:US\$|USD|R\$|\$|€)?\s*"
    r"(\d{1,16}(?:\.\d{1,6})?|\d{1,3}(?:,\d{3}){1,4}(?:\.\d{1,6})?)\s*([KMB])?$"
)


# --- expressions ----------------------------------------------------------------------------------


def number(x: str, data_type: str = "DOUBLE") -> str:
    pattern = DECIMAL if data_type == "DOUBLE" else INTEGER
    return f"CASE WHEN regexp_matches(trim({x}), '{pattern}') THEN try_cast(trim({x}) AS {data_type}) END"


def stray(x: str, data_type: str = "DOUBLE") -> str:
    pattern = DECIMAL if data_type == "DOUBLE" else INTEGER
    return f"coalesce(trim({x}) <> '' AND NOT regexp_matches(trim({x}), '{pattern}'), FALSE)"


def comma(x: str) -> str:
    return (
        rf"CASE WHEN regexp_matches(trim({x}), '^-?\d+,\d+$') THEN replace(trim({x}), ',', '.') "
        f"ELSE trim({x}) END"
    )


def amount(x: str) -> str:
    digits = f"replace(regexp_extract(upper(trim({x})), '{MONEY}', 1), ',', '')"
    letter = f"regexp_extract(upper(trim({x})), '{MONEY}', 2)"
    scale = f"CASE {letter} WHEN 'K' THEN 1000 WHEN 'M' THEN 1000000 WHEN 'B' THEN 1000000000 ELSE 1 END"
    return (
        f"try_cast(try_cast(nullif({digits}, '') AS DECIMAL(22,6)) * CAST({scale} AS DECIMAL(10,0)) "
        "AS DECIMAL(18,2))"
    )


def day(x: str) -> str:
    forms = (
        (r"^\d{4}-\d{2}-\d{2}$", "%Y-%m-%d"),
        (r"^\d{2}-\d{2}-\d{4}$", "%m-%d-%Y"),
        (r"^\d{2}/\d{2}/\d{4}$", "%d/%m/%Y"),
    )
    cases = (
        f"CASE WHEN regexp_matches(trim({x}), '{p}') THEN CAST(try_strptime(trim({x}), '{f}') AS DATE) END"
        for p, f in forms
    )
    return f"coalesce({', '.join(cases)})"


def label(x: str) -> str:
    return rf"regexp_replace(regexp_replace(upper(trim({x})), '^-+|-+$', '', 'g'), '\s+', ' ', 'g')"


def status(x: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in c.STATUS_LABELS.items())
    return f"CASE {label(x)} {cases} ELSE '{c.UNKNOWN_STATUS}' END"


def elements(x: str) -> str:
    return rf"unnest(regexp_split_to_array(regexp_replace({x}, '[;|]', ',', 'g'), '\s*,\s*'))"


def edges(x: str) -> str:
    return rf"""regexp_replace(trim({x}), '^[\\"\s]+|[\\"\s]+$', '', 'g')"""


def name_test(x: str) -> str:
    return (
        rf"{x} NOT IN ('', 'N/A', 'n/a', 'None') AND NOT regexp_matches({x}, '^-?\d+([.,]\d+)?$') "
        rf"AND NOT regexp_matches({x}, '(?i)^/|\.(jpg|jpeg|png)$') AND length({x}) BETWEEN 2 AND 60"
    )


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({x}, ' '), lambda w: CASE WHEN w = upper(w) OR w = lower(w) "
        "THEN upper(w[1]) || lower(w[2:]) ELSE w END), ' ')"
    )


def margin(revenue: str, cost: str) -> str:
    """Percent with two decimals, halves away from zero, in whole numbers."""
    p, q = f"CAST(({revenue} - {cost}) * 100 AS HUGEINT)", f"CAST({cost} * 100 AS HUGEINT)"
    return (
        f"CASE WHEN {cost} <> 0 THEN CAST(CAST(sign({p}) * ((2 * abs({p}) * 10000 + {q}) // (2 * {q})) "
        "AS DECIMAL(24,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(26,2)) END"
    )


def mean(total: str, count: str, scale: int) -> str:
    """total / (count * scale) with two decimals, halves up, in whole numbers."""
    return (
        f"CAST((2 * CAST({total} AS HUGEINT) * 100 + {count} * {scale}) // (2 * {count} * {scale}) AS DOUBLE) / 100"
    )


def best_row(source: str, keys: str, at: str, columns: str) -> str:
    """The latest row per key, then the fullest, then the smallest hash, then the smallest cells."""
    names = columns.split()
    filled = " + ".join(f"CAST({n} IS NOT NULL AS INTEGER)" for n in names)
    texts = ", ".join(f"CAST({n} AS VARCHAR)" for n in names)
    cells = ", ".join(f"{n} ASC NULLS FIRST" for n in names)
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {at} DESC NULLS LAST, "
        f"{filled} DESC, sha256(concat_ws('|', {texts})) ASC, {cells}) = 1"
    )


def in_scale(x: str) -> str:
    return f"CASE WHEN {x} BETWEEN 0 AND 10 THEN {x} END"


def distinct_key(source: str, columns: dict[str, str], key: str, where: str = "TRUE") -> str:
    chosen = ", ".join(f"{k} AS {v}" for k, v in columns.items())
    names = ", ".join(columns.values())
    return (
        f"SELECT row_number() OVER (ORDER BY {names}) AS {key}, {names} "
        f"FROM (SELECT DISTINCT {chosen} FROM {source} WHERE {where}) u"
    )


def ranges(first: str, last: str) -> str:
    return f"CAST(unnest(generate_series(CAST({first} AS TIMESTAMP), CAST({last} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)"


# --- named steps ----------------------------------------------------------------------------------

STEPS: dict[str, str] = {name: input_sql(name) for name in INPUTS}

STEPS["info_named"] = f"""
SELECT id AS id_filme, tconst, title AS titulo, original_title AS titulo_original,
  original_language AS idioma_original, release_date, runtime AS duracao_minutos, {status("status")} AS status_filme,
  overview AS sinopse, tagline AS frase_divulgacao, ingestion_datetime
FROM raw_info"""
STEPS["info_best"] = best_row(
    "info_named",
    "id_filme",
    "ingestion_datetime",
    "tconst titulo titulo_original idioma_original release_date duracao_minutos status_filme sinopse frase_divulgacao",
)
STEPS["s_info"] = f"""
SELECT id_filme, titulo, titulo_original, {day("release_date")} AS data_lancamento,
  CAST(year({day("release_date")}) AS INTEGER) AS ano_lancamento, {number("duracao_minutos", "INTEGER")} AS duracao_minutos,
  idioma_original, status_filme, sinopse, frase_divulgacao
FROM info_best"""
STEPS["rates_daily"] = """
SELECT CAST(substr(dataHoraCotacao, 1, 10) AS DATE) AS data_cotacao, cotacaoCompra AS rate
FROM (SELECT * FROM raw_rates WHERE dataHoraCotacao <> 'no instant' AND cotacaoCompra IS NOT NULL) t
QUALIFY row_number() OVER (PARTITION BY substr(dataHoraCotacao, 1, 10) ORDER BY dataHoraCotacao DESC, cotacaoCompra DESC) = 1"""
STEPS["s_rates"] = f"""
SELECT d AS data_cotacao, last_value(rate IGNORE NULLS) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS cotacao_dolar
FROM (SELECT {ranges(f"least(DATE '{RATE_START}', (SELECT min(data_cotacao) FROM rates_daily))", f"DATE '{RATE_END}'")} AS d) cal
LEFT JOIN rates_daily ON data_cotacao = d"""
STEPS["rate_now"] = """
SELECT CAST(arg_max(cotacao_dolar, data_cotacao) AS DECIMAL(6,1)) AS rate FROM s_rates WHERE cotacao_dolar IS NOT NULL"""
STEPS["fin_clean"] = f"""
SELECT id AS id_filme, CASE WHEN b > 0 THEN b END AS orcamento_usd, CASE WHEN r > 0 THEN r END AS receita_usd, ingestion_datetime
FROM (SELECT *, {amount("budget")} AS b, {amount("revenue")} AS r FROM raw_financials) t"""
STEPS["fin_brl"] = """
SELECT f.*, CAST(round(orcamento_usd * rate, 2) AS DOUBLE) AS orcamento_brl,
  CAST(round(receita_usd * rate, 2) AS DOUBLE) AS receita_brl FROM fin_clean f, rate_now"""
STEPS["fin_all"] = f"""
SELECT *, CAST(receita_usd - orcamento_usd AS DECIMAL(19,2)) AS lucro_usd, receita_brl - orcamento_brl AS lucro_brl,
  {margin("receita_usd", "orcamento_usd")} AS margem_lucro_percentual FROM fin_brl"""
STEPS["fin_best"] = best_row(
    "fin_all",
    "id_filme",
    "ingestion_datetime",
    "orcamento_usd receita_usd orcamento_brl receita_brl lucro_usd lucro_brl margem_lucro_percentual",
)
STEPS["s_financials"] = """
SELECT id_filme, orcamento_usd, receita_usd, lucro_usd, margem_lucro_percentual, orcamento_brl, receita_brl, lucro_brl
FROM fin_best"""
STEPS["met_clean"] = f"""
SELECT id AS id_filme, {stray("vote_average")} OR {stray("vote_count", "INTEGER")} OR {stray("averageRating")}
    OR {stray("numVotes", "INTEGER")} AS slipped,
  {number(f"({comma('popularity')})")} AS p, {number("vote_average")} AS a, {number("vote_count", "INTEGER")} AS b,
  {number("averageRating")} AS e, {number("numVotes", "INTEGER")} AS f, ingestion_datetime
FROM raw_metrics"""
STEPS["met_valid"] = f"""
SELECT id_filme, CASE WHEN NOT slipped AND p >= 0 THEN p END AS popularidade, {in_scale("a")} AS nota_media_tmdb,
  CASE WHEN b >= 0 THEN b END AS qtd_votos_tmdb, {in_scale("e")} AS nota_media_imdb,
  CASE WHEN f >= 0 THEN f END AS qtd_votos_imdb, ingestion_datetime FROM met_clean"""
STEPS["met_best"] = best_row(
    "met_valid",
    "id_filme",
    "ingestion_datetime",
    "popularidade nota_media_tmdb qtd_votos_tmdb nota_media_imdb qtd_votos_imdb",
)
STEPS["s_metrics"] = """
SELECT id_filme, popularidade, nota_media_tmdb, qtd_votos_tmdb, nota_media_imdb, qtd_votos_imdb FROM met_best"""
STEPS["s_reviews"] = f"""
SELECT id_filme, nome_usuario, {in_scale("nota")} AS nota_usuario,
  CASE WHEN comentario IS NULL OR trim(comentario) = '' THEN '{c.NO_COMMENT}' ELSE comentario END AS comentario_usuario
FROM (SELECT DISTINCT id AS id_filme, nome AS nome_usuario, {number("nota")} AS nota,
  coalesce(CAST({number("nota")} AS VARCHAR), nota) AS as_came, comentario FROM raw_reviews) t"""
STEPS["s_genres"] = f"""
SELECT DISTINCT id_filme, trim(g) AS nome_genero FROM (SELECT id AS id_filme, {elements("genres")} AS g FROM raw_credits) t
WHERE trim(g) IN ({", ".join(f"'{g}'" for g in c.GENRES)})"""
STEPS["credit_cells"] = "\nUNION ALL\n".join(
    f"""SELECT id AS id_filme, '{kind}' AS tipo_entidade, {elements(f'"{column}"')} AS cell FROM raw_credits"""
    for column, kind in c.KIND_OF_COLUMN.items()
)
STEPS["s_names"] = f"""
SELECT DISTINCT id_filme, {title("n")} AS nome_entidade, tipo_entidade
FROM (SELECT id_filme, tipo_entidade, {edges("cell")} AS n FROM credit_cells) t WHERE {name_test("n")}"""

STEPS["g_movies"] = """
SELECT row_number() OVER (ORDER BY id_filme) AS sk_movie_id, id_filme, titulo, data_lancamento, ano_lancamento,
  duracao_minutos, idioma_original, status_filme, sinopse FROM s_info"""
STEPS["g_genres"] = distinct_key("s_genres", {"nome_genero": "nome_genero"}, "sk_genre_id")
STEPS["g_people"] = distinct_key(
    "s_names",
    {"nome_entidade": "nome_pessoa", "tipo_entidade": "tipo_pessoa"},
    "sk_person_id",
    "tipo_entidade IN ('Ator', 'Diretor', 'Roteirista')",
)
STEPS["g_companies"] = distinct_key(
    "s_names", {"nome_entidade": "nome_produtora"}, "sk_company_id", "tipo_entidade = 'Produtora'"
)
STEPS["g_fact"] = """
SELECT sk_movie_id, orcamento_usd, receita_usd, CAST(lucro_usd AS DECIMAL(18,2)) AS lucro_usd,
  CAST(orcamento_brl AS DECIMAL(18,2)) AS orcamento_brl, CAST(receita_brl AS DECIMAL(18,2)) AS receita_brl,
  CAST(lucro_brl AS DECIMAL(18,2)) AS lucro_brl, popularidade, nota_media_tmdb, qtd_votos_tmdb, nota_media_imdb, qtd_votos_imdb
FROM g_movies LEFT JOIN s_financials USING (id_filme) LEFT JOIN s_metrics USING (id_filme) WHERE status_filme = 'Lançado'"""
STEPS["g_bridge_genre"] = """
SELECT DISTINCT sk_movie_id, sk_genre_id FROM s_genres JOIN g_movies USING (id_filme) JOIN g_genres USING (nome_genero)"""
STEPS["g_bridge_person"] = """
SELECT DISTINCT sk_movie_id, sk_person_id FROM s_names JOIN g_movies USING (id_filme)
JOIN g_people ON nome_entidade = nome_pessoa AND tipo_entidade = tipo_pessoa"""
STEPS["g_bridge_company"] = """
SELECT DISTINCT sk_movie_id, sk_company_id FROM s_names JOIN g_movies USING (id_filme)
JOIN g_companies ON nome_entidade = nome_produtora WHERE tipo_entidade = 'Produtora'"""
STEPS["review_sums"] = f"""
SELECT id_filme, count(*) AS qtd_avaliacoes_usuarios,
  CASE WHEN count(nota_usuario) > 0
    THEN {mean("sum(CAST(round(nota_usuario * 10) AS BIGINT))", "count(nota_usuario)", 10)} END AS nota_media_usuarios
FROM s_reviews GROUP BY id_filme"""
STEPS["g_reviews"] = """
SELECT row_number() OVER (ORDER BY id_filme) AS sk_review_id, sk_movie_id, qtd_avaliacoes_usuarios, nota_media_usuarios
FROM review_sums JOIN g_movies USING (id_filme)"""


def people_of(kind: str, output: str) -> str:
    return (
        f"SELECT sk_movie_id, array_to_string(list_sort(list_distinct(list(nome_pessoa))), ', ') AS {output} "
        f"FROM g_bridge_person JOIN g_people USING (sk_person_id) WHERE tipo_pessoa = '{kind}' GROUP BY sk_movie_id"
    )


def sentence() -> str:
    return """'O filme ' || coalesce(titulo, 'Título desconhecido') || ', lançado no ano de '
  || coalesce(CAST(ano_lancamento AS VARCHAR), 'ano desconhecido') || ', faturou '
  || coalesce('US$ ' || format('{:,.2f}', CAST(receita_usd AS DOUBLE)), 'valor de bilheteria não informado')
  || ' e teve um custo de ' || coalesce('US$ ' || format('{:,.2f}', CAST(orcamento_usd AS DOUBLE)), 'orçamento não informado')
  || '. Estrelado por ' || coalesce(atores_principais, 'elenco não informado') || ' e dirigido por '
  || coalesce(diretor, 'direção não informada') || ', o filme possui a seguinte sinopse: '
  || coalesce(sinopse, 'sinopse não disponível') || '.'"""


STEPS["g_actors"] = people_of("Ator", "atores_principais")
STEPS["g_directors"] = people_of("Diretor", "diretor")
STEPS["g_context"] = f"""
SELECT id_filme AS movie_id, titulo AS title, {sentence()} AS llm_context_document
FROM g_movies LEFT JOIN g_fact USING (sk_movie_id) LEFT JOIN g_actors USING (sk_movie_id) LEFT JOIN g_directors USING (sk_movie_id)"""
STEPS["g_released"] = "SELECT sk_movie_id FROM g_movies WHERE status_filme = 'Lançado'"
STEPS["g_cutoff"] = f"""
SELECT max(data_lancamento) AS cut FROM g_movies WHERE status_filme = 'Lançado' AND data_lancamento <= DATE '{TODAY}'"""


def recent(months: int) -> str:
    return (
        f"data_lancamento BETWEEN CAST((SELECT cut FROM g_cutoff) - INTERVAL {months} MONTH AS DATE) "
        "AND (SELECT cut FROM g_cutoff)"
    )


def sql(body: str) -> str:
    """The query with every named step it uses, directly or through other steps, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for step in STEPS:
            if step not in needed and re.search(rf"\b{step}\b", text):
                needed.add(step)
                visit(STEPS[step])

    visit(body)
    order: list[str] = []

    def place(step: str) -> None:
        for other in STEPS:
            if other != step and other not in order and re.search(rf"\b{other}\b", STEPS[step]):
                place(other)
        if step not in order:
            order.append(step)

    for step in STEPS:
        if step in needed:
            place(step)
    steps = ",\n".join(f"{s} AS MATERIALIZED ({STEPS[s]})" for s in order)
    return f"WITH {steps}\n{body}" if steps else body


# --- quality rules: each takes the measured counts ---------------------------------------------------


def grain(counts: str) -> str:
    return f"""SELECT '{c.RULE_GRAIN}' AS regra, n = k AS passou, CASE WHEN n = k THEN n || ' linhas, uma por filme'
  ELSE n || ' linhas para ' || k || ' filmes distintos (grão duplicado)' END AS detalhe FROM ({counts}) t"""


def coverage(counts: str) -> str:
    return f"""SELECT '{c.RULE_COVERAGE}' AS regra, a + b = 0 AS passou, CASE WHEN a + b = 0 THEN n || ' filmes lançados na fato'
  ELSE a || ' lançados fora da fato e ' || b || ' filmes na fato que não são lançados' END AS detalhe FROM ({counts}) t"""


def documents(counts: str) -> str:
    return f"""SELECT '{c.RULE_CONTEXT}' AS regra, b + d = 0 AS passou,
  CASE WHEN b + d = 0 THEN n || ' documentos, um por filme, nenhum vazio'
  ELSE b || ' documentos vazios/nulos e ' || d || ' linhas de diferença para dim_movies' END AS detalhe FROM ({counts}) t"""


def domain(counts: str) -> str:
    return f"""SELECT '{c.RULE_GENRES}' AS regra, b = 0 AS passou, CASE WHEN b = 0 THEN n || ' gêneros, todos do domínio'
  ELSE b || ' gêneros fora do domínio' END AS detalhe FROM ({counts}) t"""


def bridges(*counts: str) -> str:
    links = ("genre->movie", "genre->genre", "person->movie", "person->person", "company->movie", "company->company")
    rows = " UNION ALL ".join(
        f"SELECT {i} AS i, '{link}' AS l, ({count}) AS n" for i, (link, count) in enumerate(zip(links, counts, strict=True))
    )
    return f"""SELECT '{c.RULE_BRIDGES}' AS regra, sum(n) = 0 AS passou,
  CASE WHEN sum(n) = 0 THEN 'todas as chaves das bridges existem nas dimensões' ELSE 'chaves órfãs: {{'
  || string_agg('''' || l || ''': ' || n, ', ' ORDER BY i) FILTER (WHERE n > 0) || '}}' END AS detalhe FROM ({rows}) t"""


def scale(counts: str) -> str:
    return f"""SELECT '{c.RULE_RATINGS}' AS regra, b = 0 AS passou, CASE WHEN b = 0 THEN 'todas as notas estão entre 0 e 10'
  ELSE b || ' notas fora do intervalo de 0 a 10' END AS detalhe FROM ({counts}) t"""


def money(counts: str) -> str:
    return f"""SELECT '{c.RULE_MONEY}' AS regra, a + b = 0 AS passou,
  CASE WHEN a + b = 0 THEN 'sem valores negativos e lucro = receita - orçamento'
  ELSE a || ' valores negativos e ' || b || ' lucros incoerentes' END AS detalhe FROM ({counts}) t"""


# --- the queries ----------------------------------------------------------------------------------

BODIES: dict[str, str] = {
    "safe_number_int": f"SELECT event_id, {number('metric_txt', 'INTEGER')} AS n FROM metric_txt",
    "safe_number_double": f"SELECT event_id, {number('metric_txt')} AS x FROM metric_txt",
    "decimal_comma": f"SELECT event_id, {comma('metric_txt')} AS cell FROM metric_txt",
    "money_parse": f"SELECT o_orderkey, {amount('money_txt')} AS amount FROM money_txt",
    "multi_date": f"SELECT o_orderkey, {day('date_txt')} AS day, CAST(year({day('date_txt')}) AS INTEGER) AS year FROM date_txt",
    "normalize_status": f"SELECT o_orderkey, {label('status_txt')} AS label FROM status_txt",
    "translate_status": f"SELECT o_orderkey, {status('status_txt')} AS status FROM status_txt",
    "null_outside": f"SELECT event_id, {in_scale('value')} AS rating FROM events",
    "null_negative": "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer",
    "null_non_positive": """
SELECT event_id, CASE WHEN g > 0 THEN g END AS gain
FROM (SELECT event_id, round(value - CAST(100 AS DOUBLE), 2) AS g FROM events) t""",
    "column_shift": f"""
SELECT event_id, {stray("metric_txt")} AS slipped, CASE WHEN NOT {stray("metric_txt")} THEN {number("v")} END AS popularity
FROM metric_txt""",
    "default_blank": f"""
SELECT event_id, CASE WHEN comment_txt IS NULL OR trim(comment_txt) = '' THEN '{c.NO_COMMENT}' ELSE comment_txt END AS comment
FROM comment_txt""",
    "title_case": f"""
SELECT p_partkey, {title("x")} AS text
FROM (SELECT p_partkey, concat_ws(' ', directors, writers, companies) AS x FROM credit_txt) t""",
    "currency_margin": f"""
SELECT o_orderkey, CAST(round(r * 5.2, 2) AS DOUBLE) AS converted, CAST(r - k AS DECIMAL(19,2)) AS profit,
  {margin("r", "k")} AS margin
FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS r, CAST(o_custkey + 1 AS DECIMAL(18,2)) AS k FROM orders) t""",
    "explode_list": f"""
SELECT DISTINCT p_partkey, trim(e) AS element FROM (SELECT p_partkey, {elements("list_txt")} AS e FROM list_txt) t
WHERE trim(e) IN ('small', 'red', 'hot', 'ring', 'gear', '123')""",
    "entity_unpivot": f"""
SELECT p_partkey, n AS name, kind FROM (SELECT p_partkey, {edges("cell")} AS n, kind FROM (
  SELECT p_partkey, 'Ator' AS kind, {elements("actors")} AS cell FROM credit_txt
  UNION ALL SELECT p_partkey, 'Diretor', {elements("directors")} FROM credit_txt
  UNION ALL SELECT p_partkey, 'Roteirista', {elements("writers")} FROM credit_txt
  UNION ALL SELECT p_partkey, 'Produtora', {elements("companies")} FROM credit_txt) t) u
WHERE {name_test("n")}""",
    "dedup_latest_complete": best_row(
        "rows_with_gaps", "l_orderkey, l_linenumber", "loaded", "l_quantity l_extendedprice l_returnflag l_linestatus"
    ),
    "drop_exact_duplicates": "SELECT DISTINCT role, text FROM conversations",
    "ingest_stamp": "SELECT *, TIMESTAMP '2026-09-20 06:00:18' AS ingestion_datetime FROM customer",
    "rate_json": "\nUNION ALL\n".join(
        f"""SELECT json_extract_string(payload, '$.value[{i}].dataHoraCotacao') AS dataHoraCotacao,
  CAST(json_extract(payload, '$.value[{i}].cotacaoCompra') AS DOUBLE) AS cotacaoCompra FROM rate_payload WHERE json_array_length(payload, '$.value') > {i}"""
        for i in (0, 1)
    ),
    "calendar_ffill": f"""
SELECT d AS day, last_value(v IGNORE NULLS) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS price
FROM (SELECT {ranges("least(DATE '1999-01-01', (SELECT min(w) FROM week_best))", "DATE '2001-12-31'")} AS d) cal
LEFT JOIN week_best ON w = d""",
    "calendar_ffill_by_series": f"""
SELECT p AS o_orderpriority, d AS day,
  last_value(v IGNORE NULLS) OVER (PARTITION BY p ORDER BY d ROWS UNBOUNDED PRECEDING) AS price
FROM (SELECT p, {ranges("DATE '1994-12-01'", "DATE '2001-12-31'")} AS d
  FROM (SELECT DISTINCT o_orderpriority AS p FROM week_values) s) cal
LEFT JOIN week_best_by ON w = d AND o_orderpriority = p""",
    "latest_rate": "SELECT arg_max(v, w) AS rate FROM week_best",
    "dim_key": distinct_key("customer", {"c_name": "name"}, "sk_customer"),
    "dim_two_col_key": distinct_key("part", {"p_name": "name", "p_brand": "brand"}, "sk_person_id"),
    "bridge_using": """
SELECT DISTINCT sk_movie_id, sk_genre_id FROM lineitem JOIN part ON p_partkey = l_partkey
JOIN order_keys ON o_orderkey = l_orderkey JOIN type_keys USING (p_type)""",
    "bridge_two_cond": """
SELECT DISTINCT sk_movie_id, sk_person_id FROM lineitem JOIN part ON p_partkey = l_partkey
JOIN order_keys ON o_orderkey = l_orderkey JOIN name_keys ON name = p_name AND brand = p_brand""",
    "fact_left": """
SELECT o_orderkey AS sk_movie_id, CAST(revenue AS DECIMAL(18,2)) AS revenue, CAST(visits AS INTEGER) AS visits FROM orders
LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem GROUP BY 1) a
  ON l_orderkey = o_orderkey
LEFT JOIN (SELECT user_id, count(*) AS visits FROM events GROUP BY 1) b ON user_id = o_orderkey
WHERE o_orderstatus = 'F'""",
    "summary_dim": f"""
SELECT row_number() OVER (ORDER BY user_id) AS sk_review_id, c_custkey AS sk_movie_id, n, m AS mean
FROM (SELECT user_id, count(*) AS n, {mean("sum(event_id % 101)", "count(*)", 1)} AS m FROM events GROUP BY user_id) t
JOIN customer ON c_custkey = user_id""",
    "collect_names": """
SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(s_name))), ', ') AS names
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey""",
    "context_document": f"""
SELECT movie_id, titulo AS title, {sentence()} AS llm_context_document
FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS movie_id,
    CASE WHEN o_orderstatus <> 'P' THEN 'Order ' || CAST(o_orderkey AS VARCHAR) END AS titulo,
    CASE WHEN o_orderstatus <> 'O' THEN year(o_orderdate) END AS ano_lancamento,
    CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS sinopse,
    CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_custkey AS VARCHAR) END AS diretor FROM orders) o
LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS receita_usd,
    max(CASE WHEN l_tax > 0.05 THEN CAST(l_tax AS DECIMAL(18,2)) END) AS orcamento_usd
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) f ON f.l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(s_name))), ', ') AS atores_principais
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1) a ON a.l_orderkey = o_orderkey""",
    "q_total": "SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders",
    "q_top5": """
SELECT c_name, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
    "q_count_by_class": """
SELECT p_type, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type ORDER BY n DESC, p_type""",
    "q_rank10": """
SELECT o_orderkey, c_name, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
  CAST(rank() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC) AS INTEGER) AS place
FROM orders JOIN customer ON c_custkey = o_custkey ORDER BY price DESC, o_orderkey LIMIT 10""",
    "q_top_person_window": f"""
SELECT c_name, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey, {{cut}}
WHERE CAST(o_orderdate AS DATE) BETWEEN CAST(cut - INTERVAL 24 MONTH AS DATE) AND cut
GROUP BY c_name ORDER BY n DESC, c_name LIMIT 1""",
    "q_top_company_window": f"""
SELECT s_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey, {{cut}}
WHERE CAST(o_orderdate AS DATE) BETWEEN CAST(cut - INTERVAL 60 MONTH AS DATE) AND cut
GROUP BY s_name ORDER BY total DESC, s_name LIMIT 1""",
    "anti_both_ways": """
SELECT (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS left_rows,
  (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_returnflag = 'R') AS left_keys,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS right_rows,
  (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderstatus = 'F') AS right_keys,
  (SELECT count(*) FROM lineitem l WHERE l_returnflag = 'R'
    AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey = l.l_orderkey)) AS only_left,
  (SELECT count(*) FROM orders o WHERE o_orderstatus = 'F'
    AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o.o_orderkey)) AS only_right""",
    "orphans": """
SELECT count(*) AS orphans FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_size <= 25 AND p_partkey = l_partkey)""",
    "rule_grain": grain("SELECT count(*) AS n, count(DISTINCT l_orderkey) AS k FROM lineitem"),
    "rule_coverage": coverage("""
SELECT (SELECT count(*) FROM lineitem) AS n,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS a,
  (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')) AS b"""),
    "rule_document": documents("""
SELECT count(*) AS n, count(*) FILTER (WHERE comment_txt IS NULL OR trim(comment_txt) = '') AS b,
  abs(count(*) - (SELECT count(*) FROM orders)) AS d FROM comment_txt"""),
    "rule_domain": domain("SELECT count(*) AS n, count(*) FILTER (WHERE p_size > 25) AS b FROM part"),
    "rule_bridges": bridges(
        "SELECT count(*) FROM no_movie",
        "SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)",
        "SELECT count(*) FROM no_movie",
        "SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)",
        "SELECT count(*) FROM no_movie",
        "SELECT count(*) FROM lineitem WHERE l_suppkey % 30 NOT IN (SELECT n_nationkey FROM nation)",
    ),
    "rule_range": scale("""
SELECT (SELECT count(*) FROM events WHERE value < 0 OR value > 10)
  + (SELECT count(*) FROM events WHERE value / 10 < 0 OR value / 10 > 10)
  + (SELECT count(*) FROM customer WHERE c_acctbal / 1000 < 0 OR c_acctbal / 1000 > 10) AS b"""),
    "rule_money": money("""
SELECT count(*) FILTER (WHERE k < 0) + count(*) FILTER (WHERE low AND p < 0) + count(*) FILTER (WHERE k - 100 < 0)
  + count(*) FILTER (WHERE p - 50000 < 0) AS a, count(*) FILTER (WHERE low AND abs(g - (p - k)) > 0.01) AS b
  FROM (SELECT CAST(o_custkey AS DECIMAL(18,2)) AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS p, o_orderpriority <> '5-LOW' AS low,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) - CAST(o_custkey AS DECIMAL(18,2))
      ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS g FROM orders) t"""),
    "silver_info": "SELECT * FROM s_info",
    "silver_financials": "SELECT * FROM s_financials",
    "silver_metrics": "SELECT * FROM s_metrics",
    "silver_reviews": "SELECT * FROM s_reviews",
    "silver_genres": "SELECT * FROM s_genres",
    "silver_people": "SELECT * FROM s_names",
    "silver_rates": "SELECT * FROM s_rates",
    "gold_dim_movies": "SELECT * FROM g_movies",
    "gold_dim_genres": "SELECT * FROM g_genres",
    "gold_dim_people": "SELECT * FROM g_people",
    "gold_dim_companies": "SELECT * FROM g_companies",
    "gold_dim_reviews": "SELECT * FROM g_reviews",
    "gold_fact": "SELECT * FROM g_fact",
    "gold_bridge_genre": "SELECT * FROM g_bridge_genre",
    "gold_bridge_person": "SELECT * FROM g_bridge_person",
    "gold_bridge_company": "SELECT * FROM g_bridge_company",
    "gold_people_per_movie": "SELECT * FROM g_actors",
    "gold_context": "SELECT * FROM g_context",
    "quality_report": "\nUNION ALL\n".join(
        [
            grain("SELECT count(*) AS n, count(DISTINCT sk_movie_id) AS k FROM g_fact"),
            coverage("""
SELECT (SELECT count(*) FROM g_fact) AS n,
  (SELECT count(*) FROM g_released WHERE sk_movie_id NOT IN (SELECT sk_movie_id FROM g_fact)) AS a,
  (SELECT count(*) FROM g_fact WHERE sk_movie_id NOT IN (SELECT sk_movie_id FROM g_released)) AS b"""),
            documents("""
SELECT count(*) AS n, count(*) FILTER (WHERE llm_context_document IS NULL OR trim(llm_context_document) = '') AS b,
  abs(count(*) - (SELECT count(*) FROM g_movies)) AS d FROM g_context"""),
            domain(
                "SELECT count(*) AS n, count(*) FILTER (WHERE nome_genero IS NULL OR nome_genero NOT IN "
                f"({', '.join(f"'{g}'" for g in c.GENRES)})) AS b FROM g_genres"
            ),
            bridges(
                *(
                    f"SELECT count(*) FROM {link} WHERE {key} NOT IN (SELECT {key} FROM {dim})"
                    for link, dim_key, dim_table in (
                        ("g_bridge_genre", "sk_genre_id", "g_genres"),
                        ("g_bridge_person", "sk_person_id", "g_people"),
                        ("g_bridge_company", "sk_company_id", "g_companies"),
                    )
                    for key, dim in (("sk_movie_id", "g_movies"), (dim_key, dim_table))
                )
            ),
            scale("""
SELECT (SELECT count(*) FROM g_fact WHERE nota_media_tmdb < 0 OR nota_media_tmdb > 10)
  + (SELECT count(*) FROM g_fact WHERE nota_media_imdb < 0 OR nota_media_imdb > 10)
  + (SELECT count(*) FROM g_reviews WHERE nota_media_usuarios < 0 OR nota_media_usuarios > 10) AS b"""),
            money("""
SELECT count(*) FILTER (WHERE orcamento_usd < 0) + count(*) FILTER (WHERE receita_usd < 0)
  + count(*) FILTER (WHERE orcamento_brl < 0) + count(*) FILTER (WHERE receita_brl < 0) AS a,
  count(*) FILTER (WHERE abs(lucro_usd - (receita_usd - orcamento_usd)) > 0.01) AS b FROM g_fact"""),
        ]
    ),
    "landing_csv": """
SELECT id, tconst, title, original_title, original_language, release_date, runtime, status, overview, tagline,
  CAST(ingestion_datetime AS VARCHAR) AS ingestion_datetime FROM raw_info""",
    "rate_files": f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) || ' 13:09:02.5' AS dataHoraCotacao, value AS cotacaoCompra FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '{FEED_START}' AND DATE '{FEED_END}'""",
    "table_writes": """
SELECT 'append' AS write, 2 * count(*) AS row_count, CAST(2 * sum(c_custkey) AS BIGINT) AS key_sum FROM customer
UNION ALL SELECT 'overwrite', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier
UNION ALL SELECT 'ingest', 2 * count(*), CAST(2 * sum(c_custkey) AS BIGINT) FROM customer
UNION ALL SELECT 'batches', count(*), CAST(sum(k) AS BIGINT) FROM (SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier) u""",
    "landing_wide_lines": """
SELECT CAST(key AS VARCHAR) AS id, c_name || ', Inc.' AS name, CASE key % 5 WHEN 1 THEN c_mktsegment || ', said "z" ' WHEN 2 THEN 'a'
  WHEN 3 THEN 'x"y' ELSE c_mktsegment END AS cell, CASE WHEN key % 5 IN (0, 2) THEN nth END AS line_number,
  CASE WHEN key % 5 IN (0, 2) THEN 5 END AS fields, CASE WHEN key % 5 IN (0, 2) THEN key || ',' || w.name || ',' || w.cell END AS line
FROM (SELECT *, 1 + row_number() OVER (PARTITION BY key // 500 ORDER BY key) AS nth FROM wide_cells) w
JOIN customer ON c_custkey = key""",
    "records_frame": """
SELECT n_name AS dataHoraCotacao, CAST(n_nationkey AS DOUBLE) AS cotacaoCompra,
  (SELECT nullif(count(*), 0) FROM customer WHERE c_nationkey = n_nationkey) AS customers FROM nation""",
    "calendar_days": f"""
SELECT {ranges("(SELECT CAST(min(o_orderdate) AS DATE) FROM orders)", "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)")} AS day""",
    "question_total_revenue": "SELECT CAST(sum(receita_brl) AS DECIMAL(28,2)) AS receita_total_brl FROM g_fact",
    "question_most_popular": """
SELECT titulo, popularidade FROM g_fact JOIN g_movies USING (sk_movie_id)
ORDER BY popularidade DESC NULLS LAST, sk_movie_id LIMIT 5""",
    "question_movies_per_genre": """
SELECT nome_genero, count(*) AS qtd_filmes FROM g_bridge_genre JOIN g_genres USING (sk_genre_id) GROUP BY nome_genero""",
    "question_highest_revenue": """
SELECT titulo, receita_usd, receita_brl, CAST(rank() OVER (ORDER BY receita_usd DESC NULLS LAST) AS INTEGER) AS posicao_ranking
FROM g_fact JOIN g_movies USING (sk_movie_id) ORDER BY posicao_ranking, sk_movie_id LIMIT 10""",
    "question_busiest_actor": f"""
SELECT nome_pessoa, count(*) AS qtd_participacoes FROM g_bridge_person JOIN g_movies USING (sk_movie_id)
JOIN g_people USING (sk_person_id) WHERE tipo_pessoa = 'Ator' AND {recent(24)}
GROUP BY nome_pessoa ORDER BY qtd_participacoes DESC, nome_pessoa LIMIT 1""",
    "question_most_profitable_company": f"""
SELECT nome_produtora, CAST(sum(lucro_usd) AS DECIMAL(28,2)) AS lucro_total_usd FROM g_bridge_company
JOIN g_movies USING (sk_movie_id) JOIN g_fact USING (sk_movie_id) JOIN g_companies USING (sk_company_id)
WHERE lucro_usd IS NOT NULL AND {recent(60)}
GROUP BY nome_produtora ORDER BY lucro_total_usd DESC, nome_produtora LIMIT 1""",
}
CUT = f"(SELECT CAST(max(o_orderdate) AS DATE) AS cut FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '{TODAY}') x"
for _name in ("q_top_person_window", "q_top_company_window"):
    BODIES[_name] = BODIES[_name].format(cut=CUT)
_RULES = ("rule_grain", "rule_coverage", "rule_document", "rule_domain", "rule_bridges", "rule_range", "rule_money")
BODIES["gate_failures"] = (
    "SELECT regra, detalhe FROM (" + "\nUNION ALL\n".join(BODIES[r] for r in _RULES) + ") r WHERE NOT passou"
)

STEPS["week_known"] = "SELECT * FROM week_values WHERE read_at <> 'no instant' AND o_totalprice IS NOT NULL"
STEPS["week_best"] = """
SELECT CAST(substr(read_at, 1, 10) AS DATE) AS w, o_totalprice AS v FROM week_known
QUALIFY row_number() OVER (PARTITION BY substr(read_at, 1, 10) ORDER BY read_at DESC, o_totalprice DESC) = 1"""
STEPS["week_best_by"] = """
SELECT o_orderpriority, CAST(substr(read_at, 1, 10) AS DATE) AS w, o_totalprice AS v FROM week_known
QUALIFY row_number() OVER (PARTITION BY o_orderpriority, substr(read_at, 1, 10) ORDER BY read_at DESC, o_totalprice DESC) = 1"""
STEPS["order_keys"] = "SELECT row_number() OVER (ORDER BY o_orderkey) AS sk_movie_id, o_orderkey FROM orders"
STEPS["type_keys"] = distinct_key("part", {"p_type": "p_type"}, "sk_genre_id")
STEPS["name_keys"] = distinct_key("part", {"p_name": "name", "p_brand": "brand"}, "sk_person_id")
STEPS["no_movie"] = """
SELECT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"""

BODIES["dedup_merged_batches"] = BODIES["dedup_latest_complete"]

ORACLES: dict[str, str] = {name: sql(body) for name, body in BODIES.items()}

# The run from landing to gate has two batches, where the queries on the star have one for each year.
_YEARLY = "CAST(date_trunc('year', l_shipdate) AS DATE) AS ingestion_datetime"
_BATCHED = (
    f"CASE WHEN l_shipdate < DATE '{SECOND_BATCH}' THEN DATE '{BATCH_DAYS[0]}' ELSE DATE '{BATCH_DAYS[1]}' END AS ingestion_datetime"
)
ORACLES["landing_to_gate"] = ORACLES["quality_report"].replace(_YEARLY, _BATCHED)
