"""The same questions as DuckDB SQL, written apart from the Spark operators.

Only the binding of the test tables (the raw columns) is shared text.
"""

from __future__ import annotations

from vintara.functions.text import whitespace
from vintara.plans import delivery
from vintara.plans.retail import CITY, CUSTOMER_PLACE, MANY_PLACES, PARTS, RAW

# Letters with an accent, and the same ones without.
ACCENTS = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇáàâãäéèêëíìîïóòôõöúùûüç"
BARE = "AAAAAEEEEIIIIOOOOOUUUUCaaaaaeeeeiiiiooooouuuuc"
MEMBER = "NÃO INFORMADO"


def norm(x: str) -> str:
    return f"upper(trim(translate({x}, '{ACCENTS}', '{BARE}')))"


def text(x: str, *more: str) -> str:
    listed = ", ".join(f"'{s}'" for s in ("NULL", "", "(Vazio)", *more))
    return f"CASE WHEN trim({x}) IN ({listed}) THEN NULL ELSE {x} END"


def day(x: str) -> str:
    shape = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?$"
    return f"CASE WHEN regexp_matches({x}, '{shape}') THEN try_cast(substr({x}, 1, 10) AS DATE) END"


def whole(x: str) -> str:
    return rf"CASE WHEN regexp_matches({x}, '^\s*[+-]?\d+\s*$') THEN try_cast({x} AS INTEGER) END"


def coordinate(x: str) -> str:
    number = f"try_cast({text(x, '-')} AS DOUBLE)"
    return f"CASE WHEN isfinite({number}) AND {number} <> 0 THEN {number} END"


def key(*parts: str) -> str:
    joined = " || ".join(f"length({p}) || ':' || {p}" for p in parts)
    return f"CAST('0x' || substr(md5({joined}), 1, 15) AS BIGINT)"


def pct(part: str, total: str) -> str:
    return f"round(100.0::DOUBLE * ({part}) / nullif({total}, 0), 2)"


def raw_cte(columns: dict[str, str]) -> str:
    cells = ",\n".join(f'CAST({t.format(**PARTS)} AS VARCHAR) AS "{n}"' for n, t in columns.items())
    return f"""raw AS (
SELECT {cells}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


RAW_CTE = raw_cte(RAW)

_periods = " ".join(
    f"WHEN {norm('p')} = '{k}' THEN '{v}'"
    for k, v in [
        ("DE MADRUGADA", "De madrugada"),
        ("PELA MANHA", "Pela manhã"),
        ("A TARDE", "A tarde"),
        ("A NOITE", "A noite"),
        ("EM HORA INCERTA", "Em hora incerta"),
    ]
)

SILVER_CTE = f"""city AS (
SELECT *, coalesce(CIDADE, NOME_MUNICIPIO) AS m, coalesce(DATA_COMUNICACAO_BO, DATA_REGISTRO) AS r,
  {text('coalesce(DESCR_PERIODO, DESC_PERIODO)')} AS p,
  coalesce("NOME_MUNICIPIO_CIRCUNSCRIÇÃO", NOME_MUNICIPIO_CIRCUNSCRICAO) AS mc,
  {day('DATA_OCORRENCIA_BO')} AS occurred
FROM raw WHERE {norm('coalesce(CIDADE, NOME_MUNICIPIO)')} = '{CITY}'),
silver AS (
SELECT {text('m')} AS municipio, {text('NUM_BO')} AS num_bo, {whole('ANO_BO')} AS ano_bo,
  occurred AS dt_ocorrencia_bo, {day('r')} AS dt_registro_bo,
  {text('HORA_OCORRENCIA_BO', '-')} AS hora_ocorrencia_bo,
  CASE {_periods} ELSE p END AS desc_periodo,
  {text('DESCR_TIPOLOCAL')} AS descr_tipolocal, {text('DESCR_SUBTIPOLOCAL')} AS descr_subtipolocal,
  {text('BAIRRO')} AS bairro, {text('LOGRADOURO')} AS logradouro,
  {whole('NUMERO_LOGRADOURO')} AS numero_logradouro,
  {coordinate('LATITUDE')} AS latitude, {coordinate('LONGITUDE')} AS longitude,
  {text('RUBRICA')} AS rubrica, {text('DESCR_CONDUTA')} AS descr_conduta,
  {text('NATUREZA_APURADA')} AS natureza_apurada, {text('NOME_DEPARTAMENTO')} AS nome_departamento,
  {text('NOME_SECCIONAL')} AS nome_seccional, {text('NOME_DELEGACIA')} AS nome_delegacia,
  {text('mc')} AS municipio_circunscricao, {whole('MES_ESTATISTICA')} AS mes_estatistica,
  {whole('ANO_ESTATISTICA')} AS ano_estatistica, {whole('COD_IBGE')} AS cod_ibge,
  _arquivo_origem, _guia_origem, coalesce(strftime(occurred, '%Y%m'), '000000') AS ano_mes_ocorrencia
FROM city)"""

TYPE_KEYS = ("rubrica", "natureza_apurada", "descr_tipolocal", "descr_subtipolocal")
_filled = ", ".join(f"coalesce({k}, '{MEMBER}') AS {k}" for k in TYPE_KEYS)

GOLD_CTE = f"""keyed AS (
SELECT * REPLACE ({_filled}),
  CASE WHEN bairro IS NULL OR {norm('bairro')} = 'NAO INFORMADO' THEN '{MEMBER}'
       ELSE {norm('bairro')} END AS bairro_norm
FROM silver),
dim_local AS (
SELECT {key('bairro_norm')} AS id_local, bairro_norm AS bairro,
  round(avg(latitude), 6) AS latitude_centroide, round(avg(longitude), 6) AS longitude_centroide,
  count(*) AS qtd_ocorrencias
FROM keyed GROUP BY bairro_norm),
dim_tipo AS (
SELECT DISTINCT {key(*TYPE_KEYS)} AS id_tipo_ocorrencia, {', '.join(TYPE_KEYS)} FROM keyed),
fato AS (
SELECT num_bo, ano_bo, CAST(strftime(dt_ocorrencia_bo, '%Y%m%d') AS INTEGER) AS id_data,
  l.id_local, t.id_tipo_ocorrencia, hora_ocorrencia_bo, desc_periodo, logradouro, numero_logradouro,
  latitude, longitude, mes_estatistica, ano_estatistica, ano_mes_ocorrencia, 1 AS quantidade
FROM keyed k LEFT JOIN dim_local l ON k.bairro_norm = l.bairro
LEFT JOIN dim_tipo t USING ({', '.join(TYPE_KEYS)}))"""


def calendar(days: str) -> str:
    return f"""SELECT CAST(strftime(data, '%Y%m%d') AS INTEGER) AS id_data, data,
  CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
  CAST(day(data) AS INTEGER) AS dia, CAST(quarter(data) AS INTEGER) AS trimestre,
  CAST(dayofweek(data) + 1 AS INTEGER) AS dia_semana_num,
  ['Domingo', 'Segunda', 'Terça', 'Quarta', 'Quinta', 'Sexta', 'Sábado'][dayofweek(data) + 1]
    AS dia_semana_nome,
  dayofweek(data) IN (0, 6) AS fim_de_semana
FROM ({days})"""


DATE_CTE = f"""dim_data AS (
{calendar("SELECT DISTINCT dt_ocorrencia_bo AS data FROM silver WHERE dt_ocorrencia_bo IS NOT NULL")})"""

# Rows are counted by their keys; names are looked up for the counts.
PLACE_YEAR = f"""place_year AS (
SELECT ano, bairro, n AS total_ocorrencias FROM dim_local JOIN (
  SELECT id_local, id_data // 10000 AS ano, count(*) AS n FROM fato WHERE id_data IS NOT NULL GROUP BY ALL) USING (id_local)
WHERE bairro <> '{MEMBER}')"""

PLACE_TYPE = f"""place_type AS (
SELECT bairro, natureza_apurada, CAST(sum(n) AS BIGINT) AS total FROM dim_local JOIN (
  SELECT id_local, id_tipo_ocorrencia, count(*) AS n FROM fato GROUP BY ALL) USING (id_local)
JOIN dim_tipo USING (id_tipo_ocorrencia) WHERE bairro <> '{MEMBER}' GROUP BY ALL)"""

PLACETYPE = f"""placetype AS (
SELECT descr_tipolocal, natureza_apurada, CAST(sum(n) AS BIGINT) AS total_ocorrencias FROM dim_tipo JOIN (
  SELECT id_tipo_ocorrencia, count(*) AS n FROM fato GROUP BY ALL) USING (id_tipo_ocorrencia)
WHERE descr_tipolocal <> '{MEMBER}' GROUP BY ALL)"""

TREND = """trend AS (
SELECT id_data // 10000 AS ano, id_data // 100 % 100 AS mes, count(*) AS total
FROM fato WHERE id_data IS NOT NULL GROUP BY ALL)"""


def top(k: int) -> str:
    return f"""top{k} AS (SELECT bairro FROM place_year GROUP BY bairro
ORDER BY sum(total_ocorrencias) DESC, bairro LIMIT {k})"""


def of_raw(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((RAW_CTE, *ctes)) + "\n" + select


def of_silver(select: str, *ctes: str) -> str:
    return of_raw(select, SILVER_CTE, *ctes)


def of_star(select: str, *ctes: str) -> str:
    return of_silver(select, GOLD_CTE, DATE_CTE, *ctes)


SILVER_COLUMNS = (
    "municipio num_bo ano_bo dt_ocorrencia_bo dt_registro_bo hora_ocorrencia_bo desc_periodo "
    "descr_tipolocal descr_subtipolocal bairro logradouro numero_logradouro latitude longitude rubrica "
    "descr_conduta natureza_apurada nome_departamento nome_seccional nome_delegacia "
    "municipio_circunscricao mes_estatistica ano_estatistica cod_ibge"
).split()

_nulls = " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, count(*) FILTER ({c} IS NULL) AS nulos, "
    f"coalesce({pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)')}, 0.0) AS pct FROM silver"
    for c in (*SILVER_COLUMNS, "ano_mes_ocorrencia")
)
NULLS = f"nulls AS ({_nulls})"

REPEATED = """repeated AS (
SELECT num_bo, ano_bo, nome_delegacia, count(*) AS qtd FROM silver GROUP BY ALL HAVING count(*) > 1)"""

CATEGORIES = ("rubrica", "natureza_apurada", "bairro", "desc_periodo", "descr_tipolocal")
_counts = " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, {c} AS valor, count(*) AS linhas FROM silver GROUP BY {c}" for c in CATEGORIES
)
COUNTS = f"counts AS ({_counts})"

SENTINELS = """sentinels AS (
SELECT count(*) FILTER (LATITUDE = '0') AS lat_zero, count(*) FILTER (LATITUDE = '-') AS lat_traco,
  count(*) FILTER (LATITUDE = 'NULL') AS lat_null_str,
  count(*) FILTER (HORA_OCORRENCIA_BO = 'NULL') AS hora_null_str,
  count(*) FILTER (COD_IBGE = '(Vazio)') AS ibge_vazio FROM raw)"""

IMPOSSIBLE = "(dt_ocorrencia_bo > DATE '2001-06-30' OR dt_ocorrencia_bo < DATE '1995-06-01')"
OUTSIDE = """(latitude IS NOT NULL AND longitude IS NOT NULL AND (latitude < -23.65 OR latitude > -23.35
  OR longitude < -47.55 OR longitude > -47.30))"""

VALIDITY = f"""validity AS (
SELECT count(*) AS total, count(*) FILTER {IMPOSSIBLE} AS data_impossivel,
  count(*) FILTER (dt_ocorrencia_bo IS NULL) AS data_nula,
  count(*) FILTER (dt_ocorrencia_bo > dt_registro_bo) AS ordem_invertida,
  count(*) FILTER (latitude IS NOT NULL) AS lat_preenchida,
  count(*) FILTER {OUTSIDE} AS fora_da_caixa FROM silver)"""

GROUPED = f"""grouped AS (
SELECT regexp_matches(lower(rubrica), 'promo|economy') AS sensivel, count(*) AS total,
  count(*) FILTER (hora_ocorrencia_bo IS NULL) AS nulos,
  {pct('count(*) FILTER (hora_ocorrencia_bo IS NULL)', 'count(*)')} AS pct_nulos
FROM silver GROUP BY 1)"""

_blank = "".join(f"chr({ord(c)}) || " for c in whitespace())[:-4]


def variants(form: str) -> str:
    return f"""variants AS (
SELECT coluna, chave, count(*) OVER (PARTITION BY coluna, chave) AS grafias, valor, linhas
FROM (SELECT *, {form} AS chave FROM counts WHERE valor IS NOT NULL) QUALIFY grafias > 1)"""


VARIANTS = variants(f"upper(trim(valor, {_blank}))")


def _metrics(check: str, source: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{check}' AS verificacao, '{n}' AS metrica, CAST({n} AS DOUBLE) AS valor FROM {source}"
        for n in names
    )


SUMMARY = " UNION ALL ".join(
    [
        _metrics("sentinelas", "sentinels", "lat_zero lat_traco lat_null_str hora_null_str ibge_vazio".split()),
        "SELECT 'nulos', coluna, CAST(nulos AS DOUBLE) FROM nulls",
        "SELECT 'unicidade', 'chaves', CAST(count(*) AS DOUBLE) FROM repeated",
        "SELECT 'unicidade', 'linhas', CAST(coalesce(sum(qtd), 0) AS DOUBLE) FROM repeated",
        _metrics(
            "validade",
            "validity",
            "total data_impossivel data_nula ordem_invertida lat_preenchida fora_da_caixa".split(),
        ),
        "SELECT 'hora_nula_pct', 'sensivel=' || coalesce(CAST(sensivel AS VARCHAR), 'null'), pct_nulos FROM grouped",
        "SELECT 'cardinalidade', coluna, CAST(count(*) AS DOUBLE) FROM counts GROUP BY coluna",
        "SELECT 'grafias', coluna, CAST(count(DISTINCT chave) AS DOUBLE) FROM variants GROUP BY coluna",
    ]
)


def correlation(thresholds: list[int]) -> tuple[str, ...]:
    levels = ", ".join(f"({t})" for t in thresholds)
    return (
        PLACE_TYPE,
        f"""levels AS (SELECT CAST(v AS BIGINT) AS limiar FROM (VALUES {levels}) x(v)),
types AS (SELECT DISTINCT natureza_apurada AS tipo FROM place_type),
kept AS (SELECT limiar, bairro FROM levels, (SELECT bairro, sum(total) AS volume FROM place_type
  GROUP BY bairro) WHERE volume >= limiar),
cells AS (SELECT k.limiar, k.bairro, t.tipo, coalesce(p.total, 0)::DOUBLE AS n FROM kept k CROSS JOIN types t
  LEFT JOIN place_type p ON p.bairro = k.bairro AND p.natureza_apurada = t.tipo),
corr AS (SELECT a.limiar, count(*) AS locais, a.tipo AS tipo_a, b.tipo AS tipo_b,
  round(covar_pop(a.n, b.n) / nullif(stddev_pop(a.n) * stddev_pop(b.n), 0), 6) + 0.0::DOUBLE AS r
  FROM cells a JOIN cells b ON a.limiar = b.limiar AND a.bairro = b.bairro GROUP BY ALL)""",
    )


def pivoted(source: str, index: str, column: str, value: str, values: list[str]) -> str:
    cells = ", ".join(
        f"CAST(coalesce(sum({value}) FILTER ({column} = '{v}'), 0) AS BIGINT) AS \"{v}\"" for v in values
    )
    return f"SELECT {index}, {cells} FROM {source} GROUP BY {index}"


YEARS = [str(y) for y in range(1995, 2002)]
TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

GRID = """grid AS (
SELECT CAST(floor(latitude / 0.05) AS BIGINT) AS celula_lat, CAST(floor(longitude / 0.05) AS BIGINT) AS celula_lon,
  count(*) AS total FROM fato WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL)"""

MANIFEST = """manifest AS (
SELECT CAST(year(o_orderdate) AS INTEGER) AS ano,
  CASE WHEN year(o_orderdate) = 1998 THEN 0 ELSE count(*) END AS content_length
FROM orders GROUP BY year(o_orderdate)),
control AS (
SELECT ano, 'registros_' || ano AS arquivo, content_length + delta +
    CASE WHEN ano = 1997 THEN 5 ELSE 0 END AS content_length, dia AS dt_download, status
FROM manifest, (VALUES (TIMESTAMP '2024-01-01', 3, 'ok'), (TIMESTAMP '2024-02-01', 0, 'ok'),
  (TIMESTAMP '2024-03-01', 7, 'falha')) h(dia, delta, status) WHERE ano <> 1996),
latest AS (
SELECT ano, arg_max(content_length, dt_download) AS anterior FROM control WHERE status = 'ok' GROUP BY ano)"""

DELIVERED = """SELECT CAST(o_orderkey AS VARCHAR) AS "NUM_BO", o_orderstatus AS "SITUACAO",
  CASE WHEN year(o_orderdate) IN (1997, (SELECT max(year(o_orderdate)) FROM orders))
       THEN o_orderpriority END AS "CANAL",
  CAST(year(o_orderdate) AS VARCHAR) AS _ano_arquivo
FROM orders WHERE year(o_orderdate) <> 1996 AND (year(o_orderdate) <> 1998 OR o_orderstatus = 'F')"""

EVENT_DAYS = f"""dim_data AS (
{calendar("SELECT DISTINCT CAST(ts AS DATE) AS data FROM events WHERE ts IS NOT NULL")}),
fato AS (SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS id_data FROM events)"""

BY_WEEKDAY = """SELECT dia_semana_nome, dia_semana_num, count(*) AS total
FROM fato f JOIN dim_data d ON f.id_data = d.id_data GROUP BY ALL"""

LANDED = ", ".join(
    f'CAST({c} AS VARCHAR) AS "{c}"'
    for c in "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus".split()
)

# --- landing files, delivered twice ---


def _by_era(year: str, of_columns) -> str:
    """An expression over the columns that the files of a year have."""
    columns = {first: delivery.header(list(RAW), first) for first in delivery.LACKING}
    cases = " ".join(f"WHEN {year} >= {first} THEN {of_columns(columns[first])}" for first in sorted(columns, reverse=True))
    return f"CASE {cases} END"


def _line(columns: list[str]) -> str:
    cells = [
        f"""CASE WHEN "{c}" = '' THEN '""' WHEN contains("{c}", ',') THEN '"' || "{c}" || '"' ELSE coalesce("{c}", '') END"""
        for c in columns
    ]
    wide, narrow = " || ',' || ".join(cells), " || ',' || ".join(cells[:3])
    return f"CASE WHEN CAST(NUM_BO AS INTEGER) % 2 = 1 THEN {narrow} ELSE {wide} || ',EXCEDENTE' END"


def _content(columns: list[str]) -> str:
    cells = (f"""coalesce(length("{c}") || ':' || "{c}", '-') || ';'""" for c in sorted(columns))
    return f"CAST('0x' || substr(md5({' || '.join(cells)}), 1, 15) AS BIGINT)"


LANDED_CTE = f"""landed AS (
SELECT *, CAST(_ano_arquivo AS INTEGER) AS ano,
  _ano_arquivo IN {tuple(map(str, delivery.RAGGED))} AND CAST(NUM_BO AS INTEGER) % 97 = 0 AS ragged FROM raw),
good AS (SELECT * EXCLUDE (ragged) FROM landed WHERE NOT ragged),
earlier AS (
SELECT * REPLACE (CASE WHEN ano = {delivery.CHANGED} AND CAST(NUM_BO AS INTEGER) % 89 = 0 AND DESCR_CONDUTA IN ('F', 'O')
  THEN 'X' ELSE DESCR_CONDUTA END AS DESCR_CONDUTA)
FROM good WHERE ano NOT IN ({delivery.FAULTY}, (SELECT max(ano) FROM landed))
  AND NOT (ano = {delivery.PARTIAL} AND _guia_origem LIKE 'JUL-DEZ%')),
years AS (SELECT DISTINCT ano FROM landed),
runs AS (
SELECT ano, carga, (carga = 1 AND ano < (SELECT max(ano) FROM years)) OR (carga = 2 AND ano IN
  ({delivery.CHANGED}, {delivery.FAULTY}, {delivery.PARTIAL}, (SELECT max(ano) FROM years))) AS loaded
FROM years, range(1, 3) r(carga))"""

_marks = ", ".join(
    f"""{name} AS (SELECT _arquivo_origem AS arquivo, count(*) AS linhas,
  CAST(sum({_by_era('ano', _content)}) AS VARCHAR) AS impressao FROM {source} GROUP BY ALL)"""
    for name, source in (("marks_now", "good"), ("marks_before", "earlier"))
)

def ranked(by_year: str) -> str:
    return f"""pairs AS (
SELECT y.ano, x.bairro, x.n AS x, y.n AS y FROM {by_year} x JOIN {by_year} y ON y.bairro = x.bairro AND y.ano = x.ano + 1),
compared AS (
SELECT a.ano, count(*) FILTER ((a.x - b.x) * (a.y - b.y) > 0) AS concordantes,
  count(*) FILTER ((a.x - b.x) * (a.y - b.y) < 0) AS discordantes,
  count(*) FILTER (a.x = b.x) AS empates_antes, count(*) FILTER (a.y = b.y) AS empates_agora, count(*) AS p
FROM pairs a JOIN pairs b ON a.ano = b.ano AND a.bairro < b.bairro GROUP BY a.ano)"""


BY_CUSTOMER = """by_year AS (
SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, o_custkey AS bairro, count(*) AS n FROM orders GROUP BY ALL)"""

CONCORDANCE = """SELECT ano, lugares, concordantes, discordantes, empates_antes, empates_agora,
  round((concordantes - discordantes) / nullif(sqrt(p - empates_antes) * sqrt(p - empates_agora), 0), 6) AS tau_b
FROM compared JOIN (SELECT ano, count(*) AS lugares FROM pairs GROUP BY ano) USING (ano)"""


def of_many(select: str, *ctes: str) -> str:
    """``of_star`` over the rows in hundreds of places."""
    return "WITH " + ",\n".join((raw_cte(MANY_PLACES), SILVER_CTE, GOLD_CTE, DATE_CTE, *ctes)) + "\n" + select


RANK_SHIFT = """SELECT *, lag(posicao) OVER (PARTITION BY bairro ORDER BY ano) - posicao AS mudanca FROM (
SELECT *, rank() OVER (PARTITION BY ano ORDER BY total_ocorrencias DESC) AS posicao FROM place_year)"""

DOMINANT = f"""SELECT bairro, natureza_apurada, total, total_bairro, {pct('total', 'total_bairro')} AS pct FROM (
SELECT *, CAST(sum(total) OVER (PARTITION BY bairro) AS BIGINT) AS total_bairro,
  row_number() OVER (PARTITION BY bairro ORDER BY total DESC, natureza_apurada) AS k
FROM place_type) WHERE k = 1"""

TOP_PLACES = f"""SELECT bairro, n AS total_ocorrencias FROM dim_local
JOIN (SELECT id_local, count(*) AS n FROM fato GROUP BY id_local) USING (id_local)
WHERE bairro <> '{MEMBER}' ORDER BY n DESC, bairro LIMIT 15"""

QUERIES: dict[str, str] = {
    # landing to Bronze
    "ingest_bronze": of_raw("SELECT * EXCLUDE (ano) FROM good", LANDED_CTE),
    "ingest_rejected": of_raw(
        f"""SELECT _arquivo_origem, _guia_origem, _dt_ingestao, _ano_arquivo,
        {_by_era('ano', _line)} AS _linha_rejeitada FROM landed WHERE ragged""",
        LANDED_CTE,
    ),
    "ingest_control": of_raw(
        f"""SELECT ano, 'registros_' || ano AS arquivo, coalesce(CASE carga WHEN 1 THEN e.n ELSE g.n END, 0) AS n_linhas_bronze,
        CASE WHEN carga = 1 AND ano = {delivery.FAULTY} THEN 'falha' ELSE 'ok' END AS status
        FROM runs LEFT JOIN (SELECT ano, count(*) AS n FROM earlier GROUP BY ano) e USING (ano)
        LEFT JOIN (SELECT ano, count(*) AS n FROM good GROUP BY ano) g USING (ano) WHERE loaded""",
        LANDED_CTE,
    ),
    "ingest_outcomes": of_raw(
        f"""SELECT CAST(carga AS INTEGER) AS carga, ano, 'registros_' || ano AS arquivo,
        CASE WHEN ano = {delivery.MISSING} OR carga = 1 AND ano = (SELECT max(ano) FROM years) THEN 'ausente'
          WHEN carga = 1 AND ano = {delivery.FAULTY} THEN 'falha'
          WHEN loaded THEN 'processado' ELSE 'pulado' END AS situacao
        FROM (SELECT * FROM runs UNION ALL SELECT {delivery.MISSING}, unnest([1, 2]), false)""",
        LANDED_CTE,
    ),
    "content_changes": of_raw(
        """SELECT arquivo, n.linhas, n.impressao, b.linhas AS linhas_antes, b.impressao AS impressao_antes,
        CASE WHEN b.linhas IS NULL THEN 'novo' WHEN n.linhas <> b.linhas THEN 'linhas'
          WHEN n.impressao <> b.impressao THEN 'conteudo' ELSE 'igual' END AS mudanca
        FROM marks_now n LEFT JOIN marks_before b USING (arquivo)""",
        LANDED_CTE,
        _marks,
    ),
    "landing_merged": of_raw("SELECT * FROM raw"),
    "layer_swap": """SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS VARCHAR) AS ano, estado
        FROM orders, (VALUES ('depois da falha'), ('depois da troca')) v(estado)
        WHERE estado = 'depois da falha' OR o_orderstatus = 'F'""",
    "rank_concordance": f"WITH {BY_CUSTOMER}, {ranked('by_year')} {CONCORDANCE}",
    "many_top_places": of_many(TOP_PLACES),
    "many_top10_place_year": of_many("SELECT p.* FROM place_year p JOIN top10 USING (bairro)", PLACE_YEAR, top(10)),
    "many_place_rank_shift": of_many(RANK_SHIFT, PLACE_YEAR),
    "many_rank_concordance": of_many(
        CONCORDANCE,
        PLACE_YEAR,
        "by_year AS (SELECT ano, bairro, total_ocorrencias AS n FROM place_year)",
        ranked("by_year"),
    ),
    "many_dominant_type": of_many(DOMINANT, PLACE_TYPE),
    "many_type_correlation": of_many("SELECT * FROM corr", *correlation([20])),
    "moran_distance": f"""WITH places AS (
        SELECT c_custkey AS id, CAST({CUSTOMER_PLACE['latitude']} AS DOUBLE) AS lat,
          CAST({CUSTOMER_PLACE['longitude']} AS DOUBLE) AS lon, coalesce(n, 0) AS v FROM customer
        LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY ALL) USING (c_custkey)),
        located AS (SELECT * FROM places WHERE lat IS NOT NULL),
        mean AS (SELECT avg(v) AS mu, count(*) AS lugares, sum((v - (SELECT avg(v) FROM located)) ** 2) AS spread FROM located),
        apart AS (SELECT a.v AS va, b.v AS vb, 2 * 6371.0088 * asin(least(1.0, sqrt(
          sin(radians(b.lat - a.lat) / 2) ** 2 + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lon - a.lon) / 2) ** 2
          ))) AS km FROM located a JOIN located b ON a.id <> b.id AND abs(a.lat - b.lat) < 0.02)
        SELECT (SELECT count(*) FROM located) AS lugares, count(*) AS pares, round(any_value(lugares) *
          sum((1 - km / 1.5) * (va - mu) * (vb - mu)) / (sum(1 - km / 1.5) * any_value(spread)), 6) AS moran_i
        FROM apart, mean WHERE km <= 1.5""",
    # sources
    "landing_string": f"""SELECT {LANDED}, strftime(l_shipdate, '%Y-%m-%d') AS "l_shipdate" FROM lineitem""",
    "header_clean": """SELECT c_custkey AS "COD_CLIENTE", c_name AS "NOME__COMPLETO_", c_nationkey AS "COD_IBGE",
        c_mktsegment AS "_col3" FROM customer""",
    "bronze": of_raw("SELECT * FROM raw"),
    "bronze_replace": DELIVERED,
    "control_latest": f"WITH {MANIFEST} SELECT ano, anterior FROM latest",
    "control_listing": f"""WITH {MANIFEST} SELECT ano, arquivo, round(content_length / 1e6, 1) AS mb, dt_download,
        CAST(0 AS BIGINT) AS n_linhas_bronze, status FROM control""",
    "change_detection": f"""WITH {MANIFEST} SELECT ano, content_length, anterior,
        (content_length = 0 OR anterior IS DISTINCT FROM content_length
          OR ano = (SELECT max(ano) FROM manifest)) AS processar,
        CASE WHEN anterior IS NULL THEN 'novo' WHEN content_length = 0 THEN 'tamanho desconhecido'
          WHEN anterior <> content_length THEN printf('tamanho: %.1f->%.1f MB', anterior / 1e6, content_length / 1e6)
          WHEN ano = (SELECT max(ano) FROM manifest) THEN 'ano corrente' END AS motivo
        FROM manifest LEFT JOIN latest USING (ano)""",
    # layers
    "silver": of_silver("SELECT * FROM silver"),
    "dim_data": of_star("SELECT * FROM dim_data"),
    "dim_local": of_star("SELECT * FROM dim_local"),
    "dim_tipo": of_star("SELECT * FROM dim_tipo"),
    "fato": of_star("SELECT * FROM fato"),
    "fato_by_join": of_star("SELECT * FROM fato"),
    "silver_updated_by_month": of_silver("SELECT * FROM silver"),
    "fato_updated_by_month": of_star("SELECT * FROM fato"),
    "fk_report": of_star("""SELECT count(*) FILTER (id_local IS NULL) AS id_local_nulo,
        count(*) FILTER (id_tipo_ocorrencia IS NULL) AS id_tipo_nulo,
        count(*) FILTER (id_data IS NULL) AS id_data_nulo, count(*) AS total FROM fato"""),
    "partition_counts": of_star("SELECT ano_mes_ocorrencia, count(*) AS total FROM fato GROUP BY ALL"),
    "layer_counts": of_star("""SELECT 'bronze' AS tabela, count(*) AS linhas FROM raw
        UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'dim_data', count(*) FROM dim_data
        UNION ALL SELECT 'dim_local', count(*) FROM dim_local
        UNION ALL SELECT 'dim_tipo_ocorrencia', count(*) FROM dim_tipo
        UNION ALL SELECT 'fato_ocorrencia', count(*) FROM fato"""),
    "dense_calendar": of_silver(
        calendar(
            """SELECT CAST(unnest(generate_series(min(dt_ocorrencia_bo)::TIMESTAMP,
            max(dt_ocorrencia_bo)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS data FROM silver"""
        )
    ),
    # quality
    "sentinel_counts": of_raw("SELECT * FROM sentinels", SENTINELS),
    "null_profile": of_silver("SELECT * FROM nulls", NULLS),
    "duplicate_keys": of_silver("SELECT * FROM repeated", REPEATED),
    "duplicate_top10": of_silver(
        "SELECT * FROM repeated ORDER BY qtd DESC, num_bo, ano_bo, nome_delegacia LIMIT 10", REPEATED
    ),
    "duplicate_total": of_silver(
        "SELECT count(*) AS chaves, CAST(coalesce(sum(qtd), 0) AS BIGINT) AS linhas FROM repeated", REPEATED
    ),
    "validity": of_silver("SELECT * FROM validity", VALIDITY),
    "impossible_dates": of_silver(f"SELECT num_bo, dt_ocorrencia_bo FROM silver WHERE {IMPOSSIBLE}"),
    "order_violations": of_silver(
        """SELECT num_bo, dt_ocorrencia_bo, dt_registro_bo, rubrica FROM silver
        WHERE dt_ocorrencia_bo > dt_registro_bo"""
    ),
    "order_violations_top10": of_silver(
        """SELECT num_bo, dt_ocorrencia_bo, dt_registro_bo, rubrica FROM silver
        WHERE dt_ocorrencia_bo > dt_registro_bo ORDER BY ALL LIMIT 10"""
    ),
    "geo_outliers": of_silver(f"SELECT num_bo, latitude, longitude FROM silver WHERE {OUTSIDE}"),
    "missing_by_group": of_silver("SELECT * FROM grouped", GROUPED),
    "cardinality": of_silver("SELECT coluna, count(*) AS distintos FROM counts GROUP BY coluna", COUNTS),
    "spelling_variants": of_silver("SELECT * FROM variants", COUNTS, VARIANTS),
    "spelling_variants_accent_free": of_silver("SELECT * FROM variants", COUNTS, variants(norm("valor"))),
    "quality_summary": of_silver(
        SUMMARY, SENTINELS, NULLS, REPEATED, VALIDITY, GROUPED, COUNTS, VARIANTS
    ),
    "city_variants": of_raw(
        f"""SELECT _ano_arquivo, _guia_origem, n_valores, grafia, linhas FROM (
        SELECT _ano_arquivo, _guia_origem, count(*) AS n_valores FROM spelt GROUP BY ALL) LEFT JOIN (
        SELECT * FROM spelt WHERE contains(upper(trim(strip_accents(grafia))), '{CITY}'))
        USING (_ano_arquivo, _guia_origem)""",
        """spelt AS (SELECT _ano_arquivo, _guia_origem, coalesce(CIDADE, NOME_MUNICIPIO) AS grafia,
        count(*) AS linhas FROM raw WHERE coalesce(CIDADE, NOME_MUNICIPIO) IS NOT NULL GROUP BY ALL)""",
    ),
    # analysis
    "top_places": of_star(TOP_PLACES),
    "place_year": of_star("SELECT * FROM place_year", PLACE_YEAR),
    "top10_place_year": of_star(
        "SELECT p.* FROM place_year p JOIN top10 USING (bairro)", PLACE_YEAR, top(10)
    ),
    "top3_place_year": of_star(
        "SELECT p.* FROM place_year p JOIN top3 USING (bairro)", PLACE_YEAR, top(3)
    ),
    "top10_place_year_matrix": of_star(
        pivoted("place_year JOIN top10 USING (bairro)", "bairro", "ano", "total_ocorrencias", YEARS),
        PLACE_YEAR,
        top(10),
    ),
    "place_rank_shift": of_star(RANK_SHIFT, PLACE_YEAR),
    "by_weekday": of_star(BY_WEEKDAY),
    "by_month": of_star("SELECT mes, CAST(sum(total) AS BIGINT) AS total FROM trend GROUP BY mes", TREND),
    "hour_coverage": of_star(f"""SELECT count(hora_ocorrencia_bo) AS preenchidas, count(*) AS total,
        {pct('count(hora_ocorrencia_bo)', 'count(*)')} AS pct FROM fato"""),
    "by_period": of_star("""SELECT desc_periodo, count(*) AS total FROM fato WHERE desc_periodo IS NOT NULL
        GROUP BY desc_periodo"""),
    "place_type": of_star("SELECT * FROM place_type", PLACE_TYPE),
    "top5_place_type": of_star(
        "SELECT p.* FROM place_type p JOIN top5 USING (bairro)", PLACE_TYPE, PLACE_YEAR, top(5)
    ),
    "top5_place_type_matrix": of_star(
        pivoted("place_type JOIN top5 USING (bairro)", "bairro", "natureza_apurada", "total", TYPES),
        PLACE_TYPE,
        PLACE_YEAR,
        top(5),
    ),
    "dominant_type": of_star(DOMINANT, PLACE_TYPE),
    "year_month_trend": of_star("SELECT * FROM trend", TREND),
    "partial_year_compare": of_star(
        "SELECT ano, CAST(sum(total) AS BIGINT) AS total FROM trend WHERE mes <= 4 GROUP BY ano", TREND
    ),
    "covered_months_compare": of_star(
        """SELECT ano, CAST(sum(total) AS BIGINT) AS total FROM trend WHERE mes <= (
        SELECT max(mes) FROM trend WHERE ano = (SELECT max(ano) FROM trend)) GROUP BY ano""",
        TREND,
    ),
    "annual_totals": of_star(
        """SELECT ano, CAST(sum(total) AS BIGINT) AS total,
        (ano = (SELECT max(ano) FROM trend) AND max(mes) < 12) AS parcial FROM trend GROUP BY ano""",
        TREND,
    ),
    "annual_totals_until": of_star(
        """SELECT ano, CAST(sum(total) AS BIGINT) AS total,
        (ano = (SELECT max(ano) FROM known) AND max(mes) < 12) AS parcial FROM known GROUP BY ano""",
        TREND,
        "known AS (SELECT * FROM trend WHERE ano < 2001 OR mes <= 6)",
    ),
    "partial_year_normalised": of_star(
        """SELECT ano, total, CAST(m AS INTEGER) AS meses_cobertos, total * 12.0::DOUBLE / m AS total_anualizado,
        m < 12 AS projecao FROM (SELECT ano, CAST(sum(total) AS BIGINT) AS total,
          CASE WHEN ano = (SELECT max(ano) FROM trend) THEN max(mes) ELSE 12 END AS m FROM trend GROUP BY ano)""",
        TREND,
    ),
    "placetype_type": of_star("SELECT * FROM placetype", PLACETYPE),
    "placetype_type_matrix": of_star(
        pivoted("placetype", "descr_tipolocal", "natureza_apurada", "total_ocorrencias", TYPES), PLACETYPE
    ),
    "placetype_covered_total": of_star(
        "SELECT CAST(coalesce(sum(total_ocorrencias), 0) AS BIGINT) AS total_coberto FROM placetype", PLACETYPE
    ),
    "type_correlation": of_star("SELECT * FROM corr", *correlation([20])),
    "threshold_correlation": of_star("SELECT * FROM corr", *correlation([20, 1900, 2100, 1000000])),
    "threshold_sensitivity": of_star(
        "SELECT limiar, count(bairro) AS locais FROM levels LEFT JOIN kept USING (limiar) GROUP BY limiar",
        *correlation([20, 1900, 2100, 1000000]),
    ),
    "correlation_matrix": of_star(
        "SELECT tipo_a, "
        + ", ".join(f"max(r) FILTER (tipo_b = '{t}') AS \"{t}\"" for t in TYPES)
        + " FROM corr GROUP BY tipo_a",
        *correlation([20]),
    ),
    "heat_grid": of_star("SELECT * FROM grid", GRID),
    "moran": of_star(
        """SELECT (SELECT count(*) FROM grid) AS celulas, count(*) AS vizinhancas,
        round((SELECT count(*) FROM grid) * sum((a.total - mu) * (b.total - mu)) / (count(*) *
          (SELECT sum((total - mu) * (total - mu)) FROM grid, mean)), 6) AS moran_i
        FROM grid a JOIN grid b ON abs(a.celula_lat - b.celula_lat) <= 1 AND abs(a.celula_lon - b.celula_lon) <= 1
          AND (a.celula_lat <> b.celula_lat OR a.celula_lon <> b.celula_lon), mean""",
        GRID,
        "mean AS (SELECT avg(total) AS mu FROM grid)",
    ),
    # after an update by month every table is as a rebuild leaves it
    "dim_data_updated": of_star("SELECT * FROM dim_data"),
    "dim_local_updated": of_star("SELECT * FROM dim_local"),
    "dim_tipo_updated": of_star("SELECT * FROM dim_tipo"),
    "top_places_after_update": of_star(TOP_PLACES),
    "fk_report_after_update": of_star("""SELECT count(*) FILTER (id_local IS NULL) AS id_local_nulo,
        count(*) FILTER (id_tipo_ocorrencia IS NULL) AS id_tipo_nulo,
        count(*) FILTER (id_data IS NULL) AS id_data_nulo, count(*) AS total FROM fato"""),
    # a second input for the calendar questions
    "events_by_weekday": f"WITH {EVENT_DAYS} {BY_WEEKDAY}",
    "events_by_month": f"""WITH {EVENT_DAYS} SELECT d.mes, count(*) AS total
        FROM fato f JOIN dim_data d ON f.id_data = d.id_data GROUP BY d.mes""",
    "events_trend": f"""WITH {EVENT_DAYS} SELECT d.ano, d.mes, count(*) AS total
        FROM fato f JOIN dim_data d ON f.id_data = d.id_data GROUP BY ALL""",
}
