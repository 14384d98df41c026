"""The registered queries as SQL over the same tables, for an outside check."""

from __future__ import annotations

from types import SimpleNamespace

# Written out here again, so that a wrong value in the library does not pass.
# Labels and column names that results have.
NO_CLASS, OTHER_CLASSES = "Sem classe", "Outras"
REASON_VALUE = "valor total implausível para um item de linha"
CHUNK_EPOCH, CHUNK_DAYS, PAGE_SIZE, FOLDS = "2000-01-03", 7, 200, 5
SPEC = SimpleNamespace(status="F", ceiling=100000.0, sum_scale=4, top_classes=20)
ROLES = SimpleNamespace(
    item_id="idCompraItem", included_at="dataInclusaoPncp", kind="materialOuServicoNome",
    class_code="codigoClasse", status="situacaoCompraItemNome", quantity="quantidade",
    unit_estimate="valorUnitarioEstimado", estimated="valorTotal", awarded="valorTotalResultado",
    supplier="nomeFornecedor", organ="orgaoEntidadeCnpj", category="itemCategoriaNome",
    description="descricaoResumida")

# The feed of panelyard.plans.star under its role names, every copy numbered.
FEED = f"""
feed AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS "{ROLES.item_id}",
         l_shipdate AS "{ROLES.included_at}", l_linestatus AS "{ROLES.kind}",
         CASE WHEN p_brand <> 'Brand#1' THEN concat(p_size, '.0') END AS raw_class,
         o_orderstatus AS "{ROLES.status}", l_quantity AS "{ROLES.quantity}",
         p_retailprice AS "{ROLES.unit_estimate}", l_extendedprice AS "{ROLES.estimated}",
         CASE WHEN l_discount <> 0 THEN l_extendedprice * (1 - l_discount) END AS "{ROLES.awarded}",
         s_name AS "{ROLES.supplier}", lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS "{ROLES.organ}",
         p_type AS "{ROLES.category}", p_name AS "{ROLES.description}",
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate, l_partkey, l_suppkey) AS nth
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

ITEM_COLUMNS = ", ".join(f'"{c}"' for c in (
    ROLES.item_id, ROLES.included_at, ROLES.kind, ROLES.status, ROLES.quantity,
    ROLES.unit_estimate, ROLES.estimated, ROLES.awarded, ROLES.supplier, ROLES.organ,
    ROLES.category, ROLES.description))

UNIQUE = f"""{FEED},
uniq AS (SELECT {ITEM_COLUMNS}, regexp_replace(raw_class, '\\.0$', '') AS "{ROLES.class_code}"
         FROM feed WHERE nth = 1),
items AS (SELECT * FROM uniq WHERE "{ROLES.status}" = '{SPEC.status}'),
kept AS (SELECT * FROM items
         WHERE "{ROLES.awarded}" IS NULL OR "{ROLES.awarded}" <= {SPEC.ceiling})"""


def money(column: str) -> str:
    exact = f"CAST({column} AS DECIMAL(18, {SPEC.sum_scale}))"
    return f"coalesce(CAST(sum({exact}) AS DOUBLE), 0.0)"


CLASSES = f"""{UNIQUE},
totals AS (SELECT "{ROLES.class_code}" AS codigo, {money(f'"{ROLES.awarded}"')} AS valor_total
           FROM kept WHERE "{ROLES.class_code}" IS NOT NULL GROUP BY 1),
top AS (SELECT * FROM totals ORDER BY valor_total DESC, codigo LIMIT {SPEC.top_classes}),
reduced AS (SELECT kept.*, CASE WHEN "{ROLES.class_code}" IS NULL THEN '{NO_CLASS}'
                   WHEN codigo IS NOT NULL THEN codigo ELSE '{OTHER_CLASSES}' END AS classe
            FROM kept LEFT JOIN top ON "{ROLES.class_code}" = codigo)"""

_TRUNC = {"W": "week", "M": "month", "Q": "quarter", "D": "day"}
_STEP = {"W": "7 DAY", "M": "1 MONTH", "Q": "3 MONTH", "D": "1 DAY"}
_PER_YEAR = {"W": 52, "M": 12, "Q": 4, "D": 365}


def cells(freq: str) -> str:
    return f"""{CLASSES},
cells AS (
  SELECT CAST(date_trunc('{_TRUNC[freq]}', "{ROLES.included_at}") AS DATE) AS semana,
         "{ROLES.kind}", classe,
         {money(f'"{ROLES.awarded}"')} AS valor_total, count(*) AS n_itens,
         {money(f'"{ROLES.quantity}"')} AS qtd_total, median("{ROLES.quantity}") AS qtd_mediana,
         median("{ROLES.unit_estimate}") AS preco_unitario_mediano,
         {money(f'"{ROLES.estimated}"')} AS valor_estimado_total,
         count(DISTINCT "{ROLES.supplier}") AS n_fornecedores,
         count(DISTINCT "{ROLES.organ}") AS n_orgaos
  FROM reduced GROUP BY ALL)"""


def panel(freq: str) -> str:
    return f"""{cells(freq)},
panel AS (
  SELECT semana, "{ROLES.kind}", classe, coalesce(valor_total, 0.0) AS valor_total,
         coalesce(n_itens, 0) AS n_itens, coalesce(qtd_total, 0.0) AS qtd_total, qtd_mediana,
         preco_unitario_mediano, coalesce(valor_estimado_total, 0.0) AS valor_estimado_total,
         coalesce(n_fornecedores, 0) AS n_fornecedores, coalesce(n_orgaos, 0) AS n_orgaos,
         valor_total / nullif(valor_estimado_total, 0) AS taxa_desconto
  FROM (SELECT DISTINCT "{ROLES.kind}", classe FROM cells)
  CROSS JOIN (SELECT CAST(unnest(generate_series(min(semana), max(semana),
                                                 INTERVAL {_STEP[freq]})) AS DATE) AS semana
              FROM cells)
  LEFT JOIN cells USING (semana, "{ROLES.kind}", classe))"""


def features(freq: str, rounded: bool = True) -> str:
    """Sine and cosine are rounded for the comparison, unless they are used on."""
    wave = "round({}, 6) + 0.0" if rounded else "{}"
    per_year = _PER_YEAR[freq]
    trend = {"W": "date_diff('day', first, semana) // 7", "D": "date_diff('day', first, semana)",
             "M": "date_diff('month', first, semana)",
             "Q": "date_diff('month', first, semana) // 3"}[freq]
    lags = ", ".join(f"lag({target}, {k}) OVER s AS {short}_lag_{k}"
                     for k in dict.fromkeys((1, 4, per_year))
                     for short, target in (("valor", "valor_total"), ("itens", "n_itens")))
    angle = f"2 * pi() * weekofyear(semana) / {per_year}"
    value = f"CAST(valor_total AS DECIMAL(18, {SPEC.sum_scale}))"
    return f"""{panel(freq)},
features AS (
  SELECT panel.*, weekofyear(semana) AS semana_do_ano, month(semana) AS mes,
         {wave.format(f'sin({angle})')} AS sazonal_sen, {wave.format(f'cos({angle})')} AS sazonal_cos,
         {trend} AS tendencia, {lags},
         CASE WHEN count(*) OVER b = 4 THEN CAST(sum({value}) OVER b AS DOUBLE) / 4 END
           AS valor_media_4,
         CASE WHEN count(*) OVER b = 4 THEN CAST(sum(n_itens) OVER b AS DOUBLE) / 4 END
           AS itens_media_4
  FROM panel CROSS JOIN (SELECT min(semana) AS first FROM panel)
  WINDOW s AS (PARTITION BY "{ROLES.kind}", classe ORDER BY semana),
         b AS (PARTITION BY "{ROLES.kind}", classe ORDER BY semana
               ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))"""


def ranking(dimension: str, value: str, limit: int | None = None, label: bool = False) -> str:
    extra = ", substring(grupo, 1, 70) AS rotulo" if label else ""
    cap = f" LIMIT {limit}" if limit else ""
    return f"""WITH {FEED}
SELECT *{extra} FROM (
  SELECT "{dimension}" AS grupo, {money(f'coalesce("{value}", 0)')} AS valor_total,
         count(*) AS n_itens
  FROM feed WHERE "{dimension}" IS NOT NULL GROUP BY 1)
ORDER BY valor_total DESC, grupo{cap}"""


def weekly(source: str, name: str) -> str:
    return f"""
{name}_sums AS (
  SELECT CAST(date_trunc('week', "{ROLES.included_at}") AS DATE) AS monday,
         {money(f'"{ROLES.awarded}"')} AS v FROM {source} GROUP BY 1),
{name}_series AS (
  SELECT monday + 6 AS domingo, coalesce(v, 0.0) AS {name} FROM (
    SELECT CAST(unnest(generate_series(min(monday), max(monday), INTERVAL 7 DAY)) AS DATE) AS monday
    FROM {name}_sums) LEFT JOIN {name}_sums USING (monday))"""


def dedup(direction: str) -> str:
    return f"""SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate {direction}, l_partkey {direction}, l_suppkey {direction}) AS nth
  FROM lineitem) WHERE nth = 1"""


def chunk_of(moment: str) -> str:
    days = f"date_diff('day', DATE '{CHUNK_EPOCH}', CAST({moment} AS DATE))"
    return f"(CAST({moment} AS DATE) - CAST((({days} % {CHUNK_DAYS}) + {CHUNK_DAYS}) % {CHUNK_DAYS} AS INTEGER))"


CHUNKS = f"""
bounds AS (SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events),
chunks AS (
  SELECT chunk_start, chunk_start + {CHUNK_DAYS} AS chunk_end,
         concat(chunk_start, '_', chunk_start + {CHUNK_DAYS}) AS chunk_key
  FROM (SELECT CAST(unnest(generate_series({chunk_of('first')}, last,
                                           INTERVAL {CHUNK_DAYS} DAY)) AS DATE) AS chunk_start
        FROM bounds))"""

PAGES = f"""
assigned AS (SELECT *, {chunk_of('ts')} AS chunk_start, event_id // {PAGE_SIZE} AS block
             FROM events),
paged AS (SELECT *, CAST(block - min(block) OVER (PARTITION BY chunk_start) + 1 AS INTEGER) AS page
          FROM assigned)"""

FOLD_RULE = """
periods AS (SELECT semana, row_number() OVER (ORDER BY semana) - 1 AS rank,
                   count(*) OVER () AS m
            FROM (SELECT DISTINCT semana FROM {source})),
folds AS (
  SELECT CAST(fold AS INTEGER) AS fold, semana,
         CASE WHEN rank < m - ({n} - fold) * (m // ({n} + 1)) THEN 'train'
              WHEN rank < m - ({n} - fold - 1) * (m // ({n} + 1)) THEN 'test' END AS role
  FROM periods CROSS JOIN (SELECT unnest(range({n})) AS fold))"""

KEY = f'semana, "{ROLES.kind}", classe'


def scaled(name: str) -> str:
    return (f"round((coalesce({name}, m_{name}) - a_{name}) / "
            f"CASE WHEN s_{name} = 0 THEN 1 ELSE s_{name} END, 6) AS {name}")


def fold_parts(source: str, n: int) -> str:
    return f"""{FOLD_RULE.format(source=source, n=n)},
parts AS (SELECT fold, role, {source}.* FROM {source} JOIN folds USING (semana) WHERE role IS NOT NULL),
train AS (SELECT * FROM parts WHERE role = 'train')"""


def impute_scale() -> str:
    names = ["valor_lag_1", "qtd_mediana", "taxa_desconto", "itens_media_4"]
    medians = ", ".join(f"median({n}) AS m_{n}" for n in names)
    stats = ", ".join(f"avg(coalesce({n}, m_{n})) AS a_{n}, "
                      f"stddev_pop(coalesce({n}, m_{n})) AS s_{n}" for n in names)
    return f"""WITH {features('M')}, {fold_parts('features', 3)},
medians AS (SELECT fold, {medians} FROM train GROUP BY fold),
stats AS (SELECT fold, {stats} FROM train JOIN medians USING (fold) GROUP BY fold)
SELECT fold, role, {KEY}, {', '.join(scaled(n) for n in names)}
FROM parts JOIN medians USING (fold) JOIN stats USING (fold)"""


# The numeric features of a monthly panel.
MONTHLY_NUMBERS = """tendencia semana_do_ano mes sazonal_sen sazonal_cos qtd_total qtd_mediana
preco_unitario_mediano n_fornecedores n_orgaos taxa_desconto valor_media_4 itens_media_4
valor_lag_1 itens_lag_1 valor_lag_4 itens_lag_4 valor_lag_12 itens_lag_12""".split()


def feature_matrix() -> str:
    names = MONTHLY_NUMBERS
    medians = ", ".join(f"median({n}) AS m_{n}" for n in names)
    stats = ", ".join(f"avg(coalesce({n}, m_{n})) AS a_{n}, "
                      f"stddev_pop(coalesce({n}, m_{n})) AS s_{n}" for n in names)
    total = " + ".join(f"coalesce((coalesce({n}, m_{n}) - a_{n}) / s_{n}, 0)" for n in names)
    present = " + ".join(f"CAST(m_{n} IS NOT NULL AS INTEGER)" for n in names)
    kind = f'"{ROLES.kind}"'
    return f"""WITH {features('M', rounded=False)}, {fold_parts('features', 3)},
medians AS (SELECT fold, {medians} FROM train GROUP BY fold),
stats AS (SELECT fold, {stats} FROM train JOIN medians USING (fold) GROUP BY fold),
widths AS (SELECT fold, count(DISTINCT {kind}) + count(DISTINCT classe) AS slots FROM train GROUP BY fold),
kinds AS (SELECT DISTINCT fold, {kind}, 1 AS has_kind FROM train),
classes AS (SELECT DISTINCT fold, classe, 1 AS has_class FROM train)
SELECT fold, {KEY}, CAST({present} + slots AS INTEGER) AS width, round({total}, 4) AS numeric_sum,
       CAST(coalesce(has_kind, 0) + coalesce(has_class, 0) AS INTEGER) AS n_set
FROM parts JOIN medians USING (fold) JOIN stats USING (fold) JOIN widths USING (fold)
LEFT JOIN kinds USING (fold, {kind}) LEFT JOIN classes USING (fold, classe) WHERE role = 'test'"""


def text_coercion() -> str:
    awarded = "CASE WHEN l_orderkey % 7 IN (0, 1, 2, 3) THEN NULL ELSE l_extendedprice END"
    whole = "CAST(floor(cents / 100) AS BIGINT)"
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  awarded AS "{ROLES.awarded}", CAST(l_partkey AS VARCHAR) AS "{ROLES.class_code}",
  l_shipdate AS "{ROLES.included_at}",
  substring(concat_ws(' ', CAST(l_partkey AS VARCHAR), CAST(awarded AS VARCHAR)), 1, 9) AS texto,
  replace(format('{{:,}}', {whole}), ',', '.') || ','
    || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS numero
FROM (SELECT *, {awarded} AS awarded,
             CAST(round(({awarded}) * 100) AS BIGINT) AS cents FROM lineitem)"""


SUSPECT = f'"{ROLES.status}" = \'{SPEC.status}\' AND "{ROLES.awarded}" > {SPEC.ceiling}'
METRICS = f"""WITH {UNIQUE},
sizes AS (SELECT (SELECT count(*) FROM lineitem) AS raw, count(*) AS uniq,
                 count(*) FILTER (WHERE "{ROLES.status}" = '{SPEC.status}') AS in_status,
                 count(*) FILTER (WHERE {SUSPECT}) AS held,
                 {money(f'CASE WHEN {SUSPECT} THEN "{ROLES.awarded}" END')} AS held_value
          FROM uniq)
SELECT raw - uniq AS duplicadas,
       CAST(raw - uniq AS DOUBLE) / CAST(raw AS DOUBLE) * 100 AS duplicadas_pct,
       uniq - in_status AS fora_do_status, in_status AS restantes, held AS em_quarentena,
       held_value AS valor_em_quarentena FROM sizes"""

BINS = 49
HISTOGRAM = f"""WITH {UNIQUE},
logs AS (SELECT log10("{ROLES.awarded}") AS x FROM kept WHERE "{ROLES.awarded}" > 0),
ends AS (SELECT min(x) AS low, max(x) AS high FROM logs),
counts AS (SELECT CAST(least(floor((x - low) * {BINS} / (high - low)), {BINS - 1}) AS INTEGER) AS faixa,
                  count(*) AS n FROM logs CROSS JOIN ends GROUP BY 1)
SELECT faixa, round(pow(10.0, low + faixa * ((high - low) / {BINS})), 4) AS de,
       round(pow(10.0, low + (faixa + 1) * ((high - low) / {BINS})), 4) AS ate,
       coalesce(n, 0) AS n_itens
FROM ends CROSS JOIN (SELECT CAST(unnest(range({BINS})) AS INTEGER) AS faixa)
LEFT JOIN counts USING (faixa)"""

MEDIAN = f"""WITH {UNIQUE}
SELECT median("{ROLES.awarded}") AS mediana FROM kept WHERE "{ROLES.awarded}" > 0"""

EVENT_TOTALS = f"""SELECT {chunk_of('ts')} AS chunk_start, event_type AS tipo,
       count(*) AS n_itens, {money('value')} AS valor_total FROM events GROUP BY 1, 2"""

def one_hot() -> str:
    def slots(column: str, name: str) -> str:
        return f"""{name}_slots AS (
  SELECT fold, {column}, CAST(row_number() OVER (PARTITION BY fold ORDER BY {column}) AS INTEGER) AS {name}_slot
  FROM (SELECT DISTINCT fold, {column} FROM train WHERE n_itens > 0)),
{name}_sizes AS (SELECT fold, CAST(count(*) AS INTEGER) AS {name}_size FROM {name}_slots GROUP BY fold)"""

    def columns(column: str, name: str) -> str:
        base = f"{column.strip(chr(34))}_onehot"
        return f'coalesce({name}_slot, 0) AS "{base}_slot", {name}_size AS "{base}_size"'

    kind = f'"{ROLES.kind}"'
    return f"""WITH {panel('W')}, {fold_parts('panel', 3)}, {slots(kind, 'k')}, {slots('classe', 'c')}
SELECT fold, {KEY}, {columns(kind, 'k')}, {columns('classe', 'c')}
FROM parts LEFT JOIN k_slots USING (fold, {kind}) LEFT JOIN c_slots USING (fold, classe)
JOIN k_sizes USING (fold) JOIN c_sizes USING (fold) WHERE role = 'test'"""


CELLS_WEEKLY = f"WITH {cells('W')} SELECT * FROM cells"

ORACLE: dict[str, str] = {
    "dedup_first": dedup("ASC"),
    "dedup_last": dedup("DESC"),
    "typed_item_table": f'WITH {UNIQUE} SELECT * EXCLUDE ("{ROLES.category}") FROM items',
    "text_coercion": text_coercion(),
    "source_filters": f"""WITH {FEED}
SELECT "{ROLES.item_id}", "{ROLES.included_at}", "{ROLES.kind}", "{ROLES.status}", "{ROLES.estimated}"
FROM feed WHERE "{ROLES.kind}" = 'F' AND "{ROLES.status}" = 'O'
  AND "{ROLES.included_at}" >= DATE '1995-06-30' - 365 AND "{ROLES.included_at}" < DATE '1995-06-30'""",
    "kept_items": f"WITH {UNIQUE} SELECT * FROM kept",
    "quarantine": f"""WITH {UNIQUE} SELECT *, '{REASON_VALUE}' AS motivo
FROM items WHERE "{ROLES.awarded}" > {SPEC.ceiling}""",
    "run_metrics": METRICS,
    "class_totals": f"WITH {CLASSES} SELECT * FROM totals",
    "top_classes": f"WITH {CLASSES} SELECT * FROM top",
    "reduced_class": f"""WITH {CLASSES}
SELECT "{ROLES.item_id}", "{ROLES.class_code}", classe FROM reduced""",
    "panel_cells": CELLS_WEEKLY,
    "panel_ranked_medians": f"""WITH {cells('D')}
SELECT {KEY}, n_itens, qtd_mediana, preco_unitario_mediano FROM cells""",
    "panel_weekly": f"WITH {panel('W')} SELECT * FROM panel",
    "panel_monthly": f"WITH {panel('M')} SELECT * FROM panel",
    "panel_quarterly": f"WITH {panel('Q')} SELECT * FROM panel",
    "panel_daily": f"WITH {panel('D')} SELECT * FROM panel",
    "panel_invariants": f"""WITH {panel('W')}
SELECT count(*) AS n_rows, count(DISTINCT semana) AS n_periods,
       count(DISTINCT ("{ROLES.kind}", classe)) AS n_combos, round(sum(valor_total), 2) AS total,
       (SELECT round({money(f'"{ROLES.awarded}"')}, 2) FROM kept) AS expected FROM panel""",
    "features_weekly": f"WITH {features('W')} SELECT * FROM features",
    "features_monthly": f"WITH {features('M')} SELECT * FROM features",
    "features_quarterly": f"WITH {features('Q')} SELECT * FROM features",
    "features_daily": f"WITH {features('D')} SELECT * FROM features",
    "annual_lag_coverage": f"""WITH {features('W')}
SELECT {', '.join(f'count({t}_lag_{k}) AS {t}_lag_{k}' for k in (1, 4, 52) for t in ('valor', 'itens'))},
       count(DISTINCT semana) AS n_periodos,
       concat_ws(',', CASE WHEN count(valor_lag_52) = 0 THEN 'valor_lag_52' END,
                 CASE WHEN count(itens_lag_52) = 0 THEN 'itens_lag_52' END) AS empty_lags FROM features""",
    "rank_kind": ranking(ROLES.kind, ROLES.awarded),
    "rank_category": ranking(ROLES.category, ROLES.awarded, 20),
    "rank_description": ranking(ROLES.description, ROLES.awarded, 20, label=True),
    "rank_over_runs": ranking(ROLES.category, ROLES.awarded, 20),
    "rank_estimated": ranking(ROLES.supplier, ROLES.estimated, 20),
    "weekly_raw_vs_kept": f"""WITH {UNIQUE}, {weekly('items', 'bruto')}, {weekly('kept', 'limpo')}
SELECT domingo, bruto, coalesce(limpo, 0.0) AS limpo, bruto / 1e9 AS bruto_bi,
       coalesce(limpo, 0.0) / 1e9 AS limpo_bi
FROM bruto_series LEFT JOIN limpo_series USING (domingo)""",
    "composition_pivot": f"""WITH {panel('W')}
SELECT semana, {', '.join(f'''coalesce(CAST(sum(CAST(valor_total AS DECIMAL(18, 4)))
  FILTER (WHERE "{ROLES.kind}" = '{k}') AS DOUBLE), 0.0) AS "{k}"''' for k in ('F', 'O'))}
FROM panel GROUP BY 1""",
    "log_histogram": HISTOGRAM,
    "median_value": MEDIAN,
    "median_value_ranked": f"""WITH {UNIQUE}
SELECT median("{ROLES.awarded}") AS mediana FROM items WHERE "{ROLES.awarded}" > 0""",
    "quarantine_by_reason": f"""WITH {UNIQUE}
SELECT '{REASON_VALUE}' AS motivo, {money(f'"{ROLES.awarded}"')} AS soma, count(*) AS n_itens
FROM items WHERE "{ROLES.awarded}" > {SPEC.ceiling} GROUP BY 1""",
    "date_chunks": f"WITH {CHUNKS} SELECT * FROM chunks",
    "chunk_assignment": f"""SELECT event_id, c AS chunk_start, c + {CHUNK_DAYS} AS chunk_end,
  concat(c, '_', c + {CHUNK_DAYS}) AS chunk_key
FROM (SELECT event_id, {chunk_of('ts')} AS c FROM events)""",
    "pending_chunks": f"WITH {CHUNKS} SELECT chunks.* FROM chunks, bounds WHERE chunk_end > last",
    "closed_chunks": f"WITH {CHUNKS} SELECT chunks.* FROM chunks, bounds WHERE chunk_end <= last",
    "page_rows": f"""WITH {PAGES}
SELECT chunk_start, page, CAST(row_number() OVER (PARTITION BY chunk_start, page ORDER BY event_id) - 1
       AS INTEGER) AS position, event_id, user_id, event_type, value FROM paged""",
    "page_completeness": f"""WITH {PAGES}
SELECT chunk_start, max(page) AS last_page, count(DISTINCT page) AS n_pages,
       max(page) AS terminal_page, count(*) AS n_records,
       count(DISTINCT page) = max(page) AS complete
FROM paged GROUP BY 1""",
    "collected_chunks": f"""WITH {PAGES}
SELECT chunk_start, count(*) * CASE WHEN chunk_start + {CHUNK_DAYS} <= last THEN 1 ELSE 2 END AS n_rows,
       count(*) AS n_events
FROM assigned CROSS JOIN (SELECT CAST(max(ts) AS DATE) AS last FROM events)
GROUP BY chunk_start, last""",
    "broken_pages": f"""WITH {PAGES},
numbers AS (SELECT DISTINCT chunk_start, page FROM paged),
landed AS (SELECT * FROM numbers WHERE page % 5 <> 4),
ends AS (SELECT chunk_start, max(page) AS last_page FROM landed GROUP BY 1),
lasts AS (SELECT chunk_start, max(page) AS whole FROM numbers GROUP BY 1),
states AS (
  SELECT chunk_start, page, CASE WHEN there IS NULL THEN 'missing' WHEN page % 3 = 2 THEN 'broken'
                                 ELSE 'served' END AS state
  FROM (SELECT chunk_start, CAST(unnest(range(1, last_page + 1)) AS INTEGER) AS page FROM ends)
  LEFT JOIN (SELECT *, 1 AS there FROM landed) USING (chunk_start, page)),
facts AS (
  SELECT chunk_start, count(*) FILTER (WHERE state = 'broken') AS n_broken,
         bool_and(state = 'served') AND max(page) = any_value(whole) AS complete
  FROM states JOIN lasts USING (chunk_start) GROUP BY 1),
records AS (SELECT chunk_start, count(*) AS n_records FROM paged
            WHERE page % 5 <> 4 AND page % 3 <> 2 GROUP BY 1)
SELECT chunk_start, page, state, coalesce(n_records, 0) AS n_records, n_broken, complete
FROM states JOIN facts USING (chunk_start) LEFT JOIN records USING (chunk_start)""",
    "collected_after_repair": f"""WITH {PAGES},
broken AS (SELECT chunk_start, count(DISTINCT page) AS n FROM paged WHERE page % 3 = 2 GROUP BY 1)
SELECT chunk_start, count(*) AS n_events, 2 * coalesce(any_value(n), 0) AS n_rejected,
       any_value(n) IS NULL AS closed_at_once, true AS closed
FROM paged LEFT JOIN broken USING (chunk_start) GROUP BY 1""",
    "landing_append": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    "csv_round_trip": """SELECT doc_id, lang, source, md5(coalesce(text, '')) AS text_md5,
       CAST(length(coalesce(text, '')) AS INTEGER) AS length, CAST(n_chars AS BIGINT) AS n_chars
FROM documents""",
    "csv_stray_quotes": """SELECT doc_id, source, CASE doc_id % 3
  WHEN 0 THEN 'two' || chr(10) || lang || ', "lines"' WHEN 1 THEN 'pipe 5" ' || lang
  ELSE 'quoted' || lang END AS text FROM documents""",
    "csv_rejects": """SELECT l_orderkey AS "order", CAST(l_linenumber AS BIGINT) AS line,
       CASE WHEN (l_orderkey * 8 + l_linenumber) % 5 <> 2 THEN CAST(l_quantity AS DOUBLE) END AS quantity,
       (l_orderkey * 8 + l_linenumber) % 5 = 1 AS rejected FROM lineitem""",
    "csv_torn_tail": """SELECT doc_id, lang, 1 AS torn_files FROM documents
UNION ALL SELECT -5, 'en', 1""",
    "csv_open_quote": "SELECT 'open quote' AS state, count(*) AS n_documents FROM documents",
    "csv_changed_while_read": """SELECT doc_id, lang, true AS changed, 1 AS torn_files FROM documents
UNION ALL VALUES (-7, 'en', true, 1), (-9, 'd', true, 1)""",
    "dedup_first_across_appends": """SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS run FROM lineitem""",
    "dedup_against_index": dedup("ASC"),
    "prepared_from_pages": f"WITH {panel('W')} SELECT * FROM panel",
    "staged_layers": f"""WITH {panel('W')},
weeks AS (SELECT date_diff('week', min(date_trunc('week', "{ROLES.included_at}")),
                           max(date_trunc('week', "{ROLES.included_at}"))) + 1 AS n FROM items)
SELECT 'kept' AS layer, count(*) AS n_rows FROM kept
UNION ALL SELECT 'quarantine', count(*) FROM items WHERE "{ROLES.awarded}" > {SPEC.ceiling}
UNION ALL SELECT 'panel', count(*) FROM panel UNION ALL SELECT 'features', count(*) FROM panel
UNION ALL SELECT 'weekly', n FROM weeks
UNION ALL SELECT 'composition', count(DISTINCT semana) FROM panel""",
    "panel_in_order": f"""WITH {panel('M')}
SELECT {KEY}, CAST(row_number() OVER (ORDER BY {KEY}) AS INTEGER) AS place FROM panel""",
    "union_of_slices": """SELECT doc_id, lang, CASE WHEN lang = 'en' THEN source END AS source
FROM documents""",
    "stream_dedup": """SELECT DATE '2024-01-08' AS chunk_start, 'line' AS tipo, count(*) AS n_itens,
       CAST(count(*) AS DOUBLE) AS valor_total FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
    "stream_late_rows": """SELECT chunk_start, 'line' AS tipo, count(*) AS n_itens,
       CAST(count(*) AS DOUBLE) AS valor_total
FROM (SELECT DISTINCT l_orderkey, l_linenumber,
             CASE WHEN l_orderkey % 2 = 0 THEN DATE '2024-01-08' ELSE DATE '2024-03-04' END AS chunk_start
      FROM lineitem WHERE l_orderkey % 2 = 0 OR l_orderkey % 4 = 1) GROUP BY 1""",
    "stream_restart": """SELECT DATE '2024-01-08' AS chunk_start, 'line' AS tipo, count(*) AS n_itens,
       CAST(count(*) AS DOUBLE) AS valor_total FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
    "stream_late_kept": """SELECT chunk_start, 'line' AS tipo, count(*) AS n_itens,
       CAST(count(*) AS DOUBLE) AS valor_total, count(*) FILTER (WHERE late) AS n_atrasados,
       any_value(n_late_ids) AS n_late_ids
FROM (SELECT *, l_orderkey % 4 = 3 AS late, count(*) FILTER (WHERE l_orderkey % 4 = 3) OVER () AS n_late_ids,
             CASE WHEN l_orderkey % 4 = 1 THEN DATE '2024-03-04' ELSE DATE '2024-01-08' END AS chunk_start
      FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) GROUP BY 1""",
    "stream_first_wins": dedup("ASC"),
    "prepared_from_csv": f"WITH {panel('W')} SELECT * FROM panel",
    "weekly_event_stream": EVENT_TOTALS,
    "temporal_folds": f"""WITH {panel('W')}, {FOLD_RULE.format(source='panel', n=FOLDS)}
SELECT fold, role, {KEY} FROM panel JOIN folds USING (semana) WHERE role IS NOT NULL""",
    "impute_scale_train_only": impute_scale(),
    "feature_matrix": feature_matrix(),
    "one_hot": one_hot(),
}
