"""SQL oracles. Every relation is written the plain way (ordered windows, pairwise anti joins), not
the way the Spark operators compute it, so that agreement means something.

Relations are named `d_*`; `sql()` collects the ones a statement mentions into a WITH list.
"""

from __future__ import annotations

import re

from vendaflow.operators import weekly_queue as wq

TRAIN_REF, SCORE_REF = "2001-07-01", "2001-08-01"
N_REPS = "(SELECT count(*) FROM supplier)"


def br_or_iso(day: str, br: str) -> str:
    return f"CASE WHEN {br} THEN strftime({day}, '%d/%m/%Y') ELSE strftime({day}, '%Y-%m-%d') END"


def parse_date(s: str) -> str:
    return (f"CASE WHEN regexp_full_match({s}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"THEN CAST(try_strptime({s}, '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_full_match({s}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') "
            f"THEN CAST(try_strptime({s}, '%d/%m/%Y') AS DATE) END")


def initcap(s: str) -> str:
    return (f"array_to_string(list_transform(string_split(trim({s}), ' '), "
            f"lambda w: upper(w[1:1]) || lower(w[2:])), ' ')")


def money(s: str) -> str:
    return f"TRY_CAST({s} AS DECIMAL(18,2))"


def half_up(expr: str, digits: int) -> str:
    """Round a double half away from zero on its shortest decimal text."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def quotient(num: str, den: str, factor: int, digits: int) -> str:
    """round(num / den * factor) in decimal arithmetic, where the quotient keeps six digits."""
    q = f"CAST(CAST(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) AS DECIMAL(28,10)) AS DECIMAL(28,6))"
    return f"CAST(round({q} * {factor}, {digits}) AS DOUBLE)"


R: dict[str, str] = {}

# ---- raw text -----------------------------------------------------------------------------------
R["d_clientes_raw"] = f"""
SELECT CASE WHEN k % 7 = 0 THEN ' ' || k ELSE CAST(k AS VARCHAR) END AS cliente_id,
  CASE WHEN k % 3 = 0 THEN g[1:2] || '.' || g[3:5] || '.' || g[6:8] || '/' || g[9:12] || '-' || g[13:14]
       WHEN k % 3 = 1 THEN ' ' || g || ' ' ELSE CAST(root * 13 + 42 AS VARCHAR) END AS cnpj,
  CASE WHEN k % 5 = 0 THEN upper('casa  ' || lower(c_name)) ELSE 'casa  ' || lower(c_name) END AS razao_social,
  c_mktsegment AS segmento, n_name AS cidade, r_name AS uf, 'Bairro ' || (k % 20) AS bairro,
  CASE WHEN k % 97 = 0 THEN '1994-1-5' ELSE
    {br_or_iso("(DATE '1994-01-01' + CAST(k % 365 AS INTEGER))", "k % 4 = 0")} END AS data_cadastro,
  CASE WHEN k % 33 = 0 THEN NULL WHEN k % 10 = 0 THEN 'N' ELSE 'S' END AS ativo
FROM (SELECT *, lpad(CAST(root * 13 + 42 AS VARCHAR), 14, '0') AS g
      FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 50 = 49 THEN c_custkey - 1 ELSE c_custkey END AS root,
                   c_name, c_mktsegment, c_nationkey FROM customer))
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
R["d_vendedores_raw"] = f"""
SELECT CAST(k AS VARCHAR) AS vendedor_id, 'Rep ' || (CASE WHEN k % 20 = 19 THEN k - 1 ELSE k END) AS nome,
  r_name AS regiao, n_name AS uf,
  {br_or_iso("(DATE '1993-01-01' + CAST(k % 300 AS INTEGER))", "k % 3 = 0")} AS data_admissao,
  CASE WHEN k % 14 = 0 THEN '31/12/2000' WHEN k % 7 = 0 THEN '2000-12-31' END AS data_desligamento,
  CAST(40000 + 15000 * (k % 5) AS VARCHAR) AS meta_mensal
FROM (SELECT s_suppkey AS k, s_nationkey FROM supplier)
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
R["d_produtos_raw"] = f"""
SELECT CAST(k AS VARCHAR) AS sku, ' ' || p_name AS descricao, p_type AS categoria, p_brand AS marca,
  'Nota ' || (p_size % 12) AS nota_olfativa, CAST(preco AS VARCHAR) AS preco_tabela,
  CAST(CAST(preco * 0.60 AS DECIMAL(18,2)) AS VARCHAR) AS custo_unitario,
  CASE WHEN k % 2 = 0 THEN 'UN' ELSE 'CX' END AS unidade,
  CASE WHEN p_size % 10 = 0 THEN 'N' ELSE 'S' END AS ativo,
  CASE WHEN k % 6 = 0 THEN
    {br_or_iso("(DATE '2001-01-01' + CAST(k % 200 AS INTEGER))", "k % 12 = 0")} END AS data_lancamento
FROM (SELECT p_partkey AS k, CAST(p_retailprice AS DECIMAL(18,2)) AS preco, * FROM part)"""
R["d_pedidos_raw"] = f"""
SELECT o_orderkey || ' ' AS pedido_id, CAST(o_custkey AS VARCHAR) AS cliente_id,
  CAST(o_orderkey % {N_REPS} AS VARCHAR) AS vendedor_id,
  {br_or_iso("CAST(o_orderdate AS DATE)", "o_orderkey % 3 = 0")} AS data_pedido, o_orderpriority AS canal,
  CASE WHEN o_orderstatus = 'P' THEN ' Cancelado' ELSE 'Faturado' END AS status,
  CASE WHEN o_orderkey % 1000 = 7 THEN 'abc' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS valor_total
FROM orders"""
R["d_itens_raw"] = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS item_id, CAST(l_orderkey AS VARCHAR) AS pedido_id,
  CAST(l_partkey AS VARCHAR) AS sku,
  CASE WHEN l_orderkey % 997 = 5 THEN 'abc' ELSE CAST(q AS VARCHAR) END AS quantidade,
  CAST(preco AS VARCHAR) AS preco_praticado, CAST(CAST(l_discount * 100 AS DECIMAL(18,2)) AS VARCHAR) AS desconto_pct,
  CAST(CAST(q * preco AS DECIMAL(18,2)) AS VARCHAR) AS valor_bruto
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END AS q,
             CAST(p_retailprice AS DECIMAL(18,2)) AS preco
      FROM lineitem JOIN part ON l_partkey = p_partkey)"""
R["d_estoque_raw"] = f"""
SELECT {br_or_iso("(DATE '2001-07-04' + CAST(w * 7 AS INTEGER))", "w % 2 = 0")} AS data_snapshot,
  CAST(k AS VARCHAR) AS sku,
  CASE WHEN k % 211 = 0 THEN '-1' WHEN k % 307 = 0 THEN 'x' ELSE CAST((k * 7 + w * 3) % 50 AS VARCHAR) END AS saldo, 'N' AS ruptura
FROM (SELECT p_partkey AS k, unnest(range(4)) AS w FROM part)"""
R["d_carteira_raw"] = f"""
SELECT 'A' || c_custkey AS carteira_id, CAST(c_custkey AS VARCHAR) AS cliente_id,
  CAST(c_custkey % {N_REPS} AS VARCHAR) AS vendedor_id, '01/03/1995' AS data_inicio,
  CASE WHEN c_custkey % 6 = 0 THEN '2000-01-31' END AS data_fim FROM customer
UNION ALL SELECT 'B' || c_custkey, CAST(c_custkey AS VARCHAR), CAST((c_custkey + 1) % {N_REPS} AS VARCHAR),
  '1999-05-01', NULL FROM customer WHERE c_custkey % 10 = 3"""
_EVENT_DAY = "(CAST(ts AS DATE) - 8249)"
R["d_oportunidades_raw"] = f"""
SELECT CAST(event_id AS VARCHAR) AS oportunidade_id, CAST(user_id AS VARCHAR) AS cliente_id,
  CAST(user_id % {N_REPS} AS VARCHAR) AS vendedor_id, event_type AS origem,
  {br_or_iso(_EVENT_DAY, "event_id % 2 = 0")} AS data_abertura,
  ['Prospecção','Qualificação','Proposta enviada','Negociação','Fechado ganho','Fechado perdido'][event_id % 6 + 1] AS etapa,
  CAST(event_id % 100 AS VARCHAR) AS probabilidade_pct, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS valor_estimado,
  CASE WHEN event_id % 6 >= 4 THEN
    {br_or_iso(f"({_EVENT_DAY} + CAST(event_id % 60 AS INTEGER))", "event_id % 3 = 0")} END AS data_fechamento,
  CAST(event_id % 60 AS VARCHAR) AS ciclo_dias, CASE WHEN event_id % 6 = 5 THEN 'Preço ' END AS motivo_perda
FROM events WHERE event_type IN ('click', 'view')"""
R["d_visitas_raw"] = f"""
SELECT CAST(event_id AS VARCHAR) AS visita_id, CAST(user_id AS VARCHAR) AS cliente_id,
  CAST(user_id % {N_REPS} AS VARCHAR) AS vendedor_id, {br_or_iso(_EVENT_DAY, "event_id % 5 = 0")} AS data_visita,
  CASE WHEN event_type = 'purchase' THEN ' Pedido realizado' ELSE 'Sem interesse' END AS resultado,
  CASE WHEN event_id % 401 = 0 THEN '?' ELSE CAST(event_id % 90 AS VARCHAR) END AS duracao_min
FROM events WHERE event_type IN ('purchase', 'signup', 'error')"""

# ---- cleaned ------------------------------------------------------------------------------------
R["d_clientes_limpos"] = f"""
SELECT trim(cliente_id) AS cliente_id, lpad(regexp_replace(trim(cnpj), '[^0-9]', '', 'g'), greatest(14, length(regexp_replace(trim(cnpj), '[^0-9]', '', 'g')))::INT, '0') AS cnpj,
  regexp_replace({initcap("razao_social")}, ' +', ' ', 'g') AS razao_social,
  {parse_date("data_cadastro")} AS data_cadastro, coalesce(trim(ativo) = 'S', false) AS ativo,
  trim(segmento) AS segmento, trim(cidade) AS cidade, trim(uf) AS uf, trim(bairro) AS bairro
FROM d_clientes_raw"""
R["d_clientes"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY cnpj) AS qtd_registros
  FROM d_clientes_limpos WINDOW w AS (PARTITION BY cnpj ORDER BY data_cadastro ASC NULLS FIRST, cliente_id ASC))
WHERE rn = 1"""
R["d_vendedores"] = f"""
SELECT trim(vendedor_id) AS vendedor_id, trim(nome) AS nome, trim(regiao) AS regiao, trim(uf) AS uf,
  {parse_date("data_admissao")} AS data_admissao, {parse_date("data_desligamento")} AS data_desligamento,
  data_desligamento IS NULL AS ativo, {money("meta_mensal")} AS meta_mensal FROM d_vendedores_raw"""
R["d_produtos"] = f"""
SELECT trim(sku) AS sku, trim(descricao) AS nome, trim(categoria) AS categoria, trim(marca) AS marca,
  trim(nota_olfativa) AS nota_olfativa, {parse_date("data_lancamento")} AS data_lancamento,
  {money("preco_tabela")} AS preco_tabela, {money("custo_unitario")} AS custo_unitario, trim(unidade) AS unidade,
  coalesce(trim(ativo) = 'S', false) AS ativo FROM d_produtos_raw"""
R["d_pedidos"] = f"""
SELECT *, CASE WHEN cancelado THEN 0 ELSE valor_total END AS valor_liquido,
       CAST(year(data_pedido) AS INTEGER) AS ano, CAST(month(data_pedido) AS INTEGER) AS mes
FROM (SELECT trim(pedido_id) AS pedido_id, trim(cliente_id) AS cliente_id, trim(vendedor_id) AS vendedor_id,
        {parse_date("data_pedido")} AS data_pedido, trim(canal) AS canal, {money("valor_total")} AS valor_total,
        coalesce(trim(status) = 'Cancelado', false) AS cancelado FROM d_pedidos_raw)"""
R["d_itens"] = f"""
SELECT i.item_id, i.pedido_id, i.sku, quantidade, abs(quantidade) AS quantidade_abs, quantidade < 0 AS devolucao,
  preco_praticado, desconto_pct, valor_bruto, p.custo_unitario,
  p.sku IS NOT NULL AND NOT p.ativo AS sku_descontinuado
FROM (SELECT trim(item_id) AS item_id, trim(pedido_id) AS pedido_id, trim(sku) AS sku,
        TRY_CAST(quantidade AS INTEGER) AS quantidade, {money("preco_praticado")} AS preco_praticado,
        {money("desconto_pct")} AS desconto_pct, {money("valor_bruto")} AS valor_bruto FROM d_itens_raw) i
LEFT JOIN d_produtos p ON i.sku = p.sku"""
R["d_carteira"] = f"""
SELECT carteira_id, cliente_id, vendedor_id, {parse_date("data_inicio")} AS data_inicio,
  {parse_date("data_fim")} AS data_fim,
  data_fim IS NULL AND NOT EXISTS (SELECT 1 FROM d_vendedores v WHERE v.vendedor_id = c.vendedor_id
    AND v.data_desligamento IS NOT NULL) AS vigente,
  data_fim IS NULL AND EXISTS (SELECT 1 FROM d_vendedores v WHERE v.vendedor_id = c.vendedor_id
    AND v.data_desligamento IS NOT NULL) AS orfao_vendedor_desligado
FROM d_carteira_raw c"""
R["d_oportunidades"] = f"""
SELECT trim(oportunidade_id) AS oportunidade_id, trim(cliente_id) AS cliente_id, trim(vendedor_id) AS vendedor_id,
  trim(origem) AS origem,
  CASE trim(etapa) WHEN 'Fechado ganho' THEN 'ganha' WHEN 'Fechado perdido' THEN 'perdida' ELSE lower(trim(etapa)) END AS etapa,
  coalesce(trim(etapa) = 'Fechado ganho', false) AS ganancia, coalesce(trim(etapa) = 'Fechado perdido', false) AS perdida,
  {parse_date("data_abertura")} AS data_abertura, {parse_date("data_fechamento")} AS data_fechamento,
  TRY_CAST(probabilidade_pct AS DECIMAL(5,2)) AS probabilidade_pct, {money("valor_estimado")} AS valor_estimado,
  TRY_CAST(ciclo_dias AS INTEGER) AS ciclo_dias, trim(motivo_perda) AS motivo_perda FROM d_oportunidades_raw"""
R["d_visitas"] = f"""
SELECT trim(visita_id) AS visita_id, trim(cliente_id) AS cliente_id, trim(vendedor_id) AS vendedor_id,
  {parse_date("data_visita")} AS data_visita, trim(resultado) AS resultado,
  TRY_CAST(duracao_min AS INTEGER) AS duracao_min FROM d_visitas_raw"""
R["d_pagamentos"] = """
SELECT 'P' || o_orderkey AS pagamento_id, CAST(o_orderkey AS VARCHAR) AS pedido_id,
  ['Boleto','Cartão','Pix'][o_orderkey % 3 + 1] AS forma_pagamento, CAST(1 + o_orderkey % 6 AS INTEGER) AS parcelas,
  CAST(o_totalprice AS DECIMAL(18,2)) AS valor,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) - o_orderkey % 5 AS DECIMAL(18,2)) AS valor_liquido,
  CAST(o_orderkey % 5 AS DECIMAL(5,2)) AS taxa_pct, CAST(o_orderdate AS DATE) + 30 AS data_vencimento,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 11 AS INTEGER) END AS data_pagamento,
  CASE WHEN o_orderkey % 9 <> 0 THEN 'Pago' ELSE 'Aberto' END AS status_pagamento FROM orders"""
R["d_pagamentos_raw"] = f"""
SELECT pagamento_id, pedido_id, forma_pagamento, CAST(parcelas AS VARCHAR) AS parcelas, CAST(valor AS VARCHAR) AS valor,
  CAST(taxa_pct AS VARCHAR) AS taxa_pct, CAST(valor_liquido AS VARCHAR) AS valor_liquido,
  {br_or_iso("data_vencimento", "parcelas > 3")} AS data_vencimento,
  {br_or_iso("data_pagamento", "parcelas > 3")} AS data_pagamento, ' ' || status_pagamento AS status_pagamento FROM d_pagamentos"""
R["d_estoque"] = f"""
SELECT {parse_date("data_snapshot")} AS data_snapshot, trim(sku) AS sku, TRY_CAST(saldo AS INTEGER) AS saldo,
  coalesce(TRY_CAST(saldo AS INTEGER) = 0, false) AS ruptura FROM d_estoque_raw"""

# ---- gold ---------------------------------------------------------------------------------------
# a line with its amounts: known quantity, known price, product of known cost
R["d_linhas_valoradas"] = """
SELECT pedido_id, item_id, sku, quantidade, quantidade_abs, preco_praticado, devolucao, sku_descontinuado, categoria, marca,
  nota_olfativa, quantidade * preco_praticado AS receita, quantidade_abs * custo_do_sku AS custo
FROM (SELECT * EXCLUDE (custo_unitario) FROM d_itens WHERE quantidade * preco_praticado IS NOT NULL)
JOIN (SELECT sku, categoria, marca, nota_olfativa, custo_unitario AS custo_do_sku FROM d_produtos WHERE custo_unitario IS NOT NULL)
USING (sku)"""
R["d_fato"] = """
SELECT * EXCLUDE (custo), custo, receita - custo AS margem
FROM d_linhas_valoradas
JOIN (SELECT pedido_id, cliente_id, vendedor_id, data_pedido, ano, mes, canal FROM d_pedidos WHERE NOT cancelado) USING (pedido_id)
LEFT JOIN (SELECT cliente_id, razao_social, segmento, cidade FROM d_clientes) USING (cliente_id)"""
# orders first, customers second
R["d_bruto_pedido"] = "SELECT pedido_id, sum(valor_bruto) AS bruto FROM d_itens GROUP BY pedido_id"
R["d_historico"] = """
SELECT cliente_id, count(*) AS quantos, sum(bruto) AS bruto, min(data_pedido) AS primeiro_pedido, max(data_pedido) AS ultimo_pedido
FROM (SELECT pedido_id, cliente_id, data_pedido FROM d_pedidos WHERE NOT cancelado) JOIN d_bruto_pedido USING (pedido_id)
GROUP BY cliente_id"""
R["d_dim_cliente"] = f"""
SELECT * EXCLUDE (qtd_registros, quantos, bruto), coalesce(quantos, 0) AS total_pedidos,
  CAST(coalesce(bruto, 0) AS DOUBLE) AS receita_acumulada, CAST(DATE '{SCORE_REF}' - ultimo_pedido AS INTEGER) AS dias_sem_comprar
FROM d_clientes LEFT JOIN d_historico USING (cliente_id)"""
R["d_vendidas"] = "SELECT * FROM d_fato WHERE NOT devolucao"
# lines to orders, orders to the customers whom a rep served in a month, those to the month
R["d_pedido_rep"] = "SELECT vendedor_id, cliente_id, ano, mes, pedido_id, sum(receita) AS valor, sum(margem) AS ganho FROM d_fato GROUP BY ALL"
R["d_cliente_rep"] = """
SELECT vendedor_id, ano, mes, cliente_id, count(*) AS quantos, sum(valor) AS valor, sum(ganho) AS ganho FROM d_pedido_rep GROUP BY ALL"""
R["d_mes_rep"] = """
SELECT vendedor_id, ano, mes, count(cliente_id) AS clientes_atendidos, CAST(sum(quantos) AS BIGINT) AS pedidos_unicos, sum(valor) AS valor, sum(ganho) AS ganho
FROM d_cliente_rep GROUP BY ALL"""
R["d_mart_vendedor"] = f"""
SELECT * EXCLUDE (valor, ganho, meta), CAST(meta AS DOUBLE) AS meta_mensal, CAST(valor AS DOUBLE) AS receita, CAST(ganho AS DOUBLE) AS margem,
  CAST(valor - ganho AS DOUBLE) AS custo, {quotient('valor', 'clientes_atendidos', 1, 2)} AS ticket_por_cliente,
  CASE WHEN meta > 0 THEN {quotient('valor', 'meta', 100, 2)} END AS atingimento_pct
FROM d_mes_rep JOIN (SELECT vendedor_id, meta_mensal AS meta FROM d_vendedores) USING (vendedor_id)"""
R["d_sku_mes"] = f"""
SELECT sku, categoria, marca, ano, mes, CAST(sum(quantidade_abs) AS BIGINT) AS quantidade, sum(receita) AS receita,
  sum(margem) AS margem, {quotient('sum(margem)', 'nullif(sum(receita), 0)', 100, 2)} AS margem_pct
FROM d_fato GROUP BY ALL"""
R["d_abc"] = """
SELECT sku, categoria, marca, ano, mes, quantidade, CAST(receita AS DOUBLE) AS receita, CAST(margem AS DOUBLE) AS margem,
  margem_pct, CASE WHEN parte <= 0.80 THEN 'A' WHEN parte <= 0.95 THEN 'B' ELSE 'C' END AS curva_abc
FROM (SELECT *, CAST(sum(receita) OVER (PARTITION BY ano, mes ORDER BY receita DESC) AS DOUBLE)
        / nullif(CAST(sum(receita) OVER (PARTITION BY ano, mes) AS DOUBLE), 0) AS parte FROM d_sku_mes)"""
# one row per order and month, then per month
R["d_pedido_mes"] = "SELECT ano, mes, pedido_id, sum(receita) AS valor, sum(margem) AS ganho FROM d_fato GROUP BY ALL"
R["d_kpis"] = """
SELECT *, make_date(ano, mes, 1) AS data_ref, CAST(ano * 100 + mes AS INTEGER) AS ano_mes_order,
  round(receita / pedidos_unicos, 6) AS ticket_por_pedido, round(100 * (margem / nullif(receita, 0)), 6) AS margem_pct
FROM (SELECT ano, mes, count(*) AS pedidos_unicos, CAST(sum(valor) AS DOUBLE) AS receita, CAST(sum(ganho) AS DOUBLE) AS margem
      FROM d_pedido_mes GROUP BY ano, mes)"""
R["d_dimensoes"] = """
SELECT *, round(CAST(margem AS DOUBLE) * 100 / nullif(CAST(receita AS DOUBLE), 0), 6) AS margem_pct
FROM (SELECT cliente_id, razao_social, segmento, cidade, canal, categoria, marca, sum(receita) AS receita, sum(margem) AS margem,
        CAST(sum(quantidade_abs) AS BIGINT) AS quantidade FROM d_fato GROUP BY ALL)"""
# what a customer spent per brand, and the brands from dearest to cheapest
R["d_gasto_marca"] = "SELECT cliente_id, marca, sum(receita) AS gasto, max(data_pedido) AS ultima FROM d_fato GROUP BY ALL"
R["d_marcas_cliente"] = """
SELECT cliente_id, list(marca ORDER BY gasto DESC, marca) AS marcas, max(ultima) AS ultima_compra FROM d_gasto_marca GROUP BY cliente_id"""
R["d_estoque_atual"] = "SELECT * FROM d_estoque WHERE data_snapshot = (SELECT max(data_snapshot) FROM d_estoque)"


# ---- features, per cut-off ----------------------------------------------------------------------
def _feature_relations(tag: str, ref: str) -> None:
    d = f"DATE '{ref}'"
    cut = f"({d} - 7)"
    R[f"d_lacunas_{tag}"] = f"""
SELECT *, CAST(data_pedido - data_anterior AS INTEGER) AS gap_dias FROM (
  SELECT cliente_id, pedido_id, data_pedido,
    lag(data_pedido) OVER (PARTITION BY cliente_id ORDER BY data_pedido, pedido_id) AS data_anterior
  FROM (SELECT DISTINCT cliente_id, pedido_id, data_pedido FROM d_fato WHERE data_pedido < {cut}))"""
    R[f"d_rfm_{tag}"] = f"""
SELECT cliente_id, greatest(0.0, CAST({cut} - max(data_pedido) FILTER (WHERE data_pedido < {cut}) AS DOUBLE)) AS recencia_dias,
  CAST(count(DISTINCT pedido_id) AS DOUBLE) AS frequencia_pedidos, CAST(sum(receita) AS DOUBLE) AS valor_total,
  CAST(sum(receita) AS DOUBLE) / count(DISTINCT pedido_id) AS ticket_medio, CAST(sum(margem) AS DOUBLE) AS margem_total,
  CAST(sum(margem) AS DOUBLE) / nullif(CAST(sum(receita) AS DOUBLE), 0) AS margem_percentual,
  max(data_pedido) FILTER (WHERE data_pedido < {cut}) AS ultimo
FROM d_fato WHERE data_pedido < {d} GROUP BY cliente_id"""
    R[f"d_90d_{tag}"] = f"""
SELECT cliente_id, count(DISTINCT pedido_id) AS pedidos_ultimos_90d FROM d_fato
WHERE data_pedido >= {cut} - 90 AND data_pedido < {cut} GROUP BY cliente_id"""
    R[f"d_ritmo_{tag}"] = f"""
SELECT r.cliente_id, g.intervalo_medio_dias, g.desvio_intervalo_dias,
  CASE WHEN r.ultimo IS NULL THEN NULL
       WHEN g.intervalo_medio_dias > 0 THEN least(CAST({cut} - r.ultimo AS DOUBLE) / g.intervalo_medio_dias, 10.0)
       ELSE 10.0 END AS atraso_relativo,
  CAST(coalesce(n.pedidos_ultimos_90d, 0) AS DOUBLE) AS pedidos_ultimos_90d, r.ultimo IS NULL AS sem_historico_ritmo
FROM d_rfm_{tag} r
LEFT JOIN (SELECT cliente_id, avg(gap_dias) AS intervalo_medio_dias, stddev_samp(gap_dias) AS desvio_intervalo_dias
           FROM d_lacunas_{tag} GROUP BY cliente_id) g ON r.cliente_id = g.cliente_id
LEFT JOIN d_90d_{tag} n ON r.cliente_id = n.cliente_id"""
    R[f"d_opp_{tag}"] = f"""
SELECT cliente_id, CAST(sum(CASE WHEN NOT ganancia AND NOT perdida THEN 1 ELSE 0 END) AS DOUBLE) AS oportunidades_abertas,
  CAST(sum(CASE WHEN ganancia THEN 1 ELSE 0 END) AS DOUBLE) AS oportunidades_ganhas,
  avg(CASE WHEN ganancia THEN 1.0 ELSE 0.0 END) AS taxa_ganho
FROM d_oportunidades WHERE data_abertura < {d} GROUP BY cliente_id"""
    R[f"d_vis_{tag}"] = f"""
SELECT cliente_id, CAST(count(*) AS DOUBLE) AS visitas_90d,
  avg(CASE WHEN resultado = 'Pedido realizado' THEN 1.0 ELSE 0.0 END) AS conversao_visita
FROM d_visitas WHERE data_visita >= {cut} - 90 AND data_visita < {cut} GROUP BY cliente_id"""
    R[f"d_lanc_{tag}"] = f"""
SELECT DISTINCT cliente_id FROM d_fato f JOIN d_produtos p ON f.sku = p.sku
WHERE f.data_pedido < {d} AND p.data_lancamento >= {d} - 120"""
    R[f"d_mix_{tag}"] = f"""
SELECT m.cliente_id, skus_distintos, categorias_distintas, marcas_distintas, melhor / nullif(total, 0) AS concentracao_marca_top,
  CAST(l.cliente_id IS NOT NULL AS DOUBLE) AS comprou_lancamento
FROM (SELECT cliente_id, CAST(count(DISTINCT sku) AS DOUBLE) AS skus_distintos, CAST(sum(receita) AS DOUBLE) AS total,
        CAST(count(DISTINCT categoria) AS DOUBLE) AS categorias_distintas, CAST(count(DISTINCT marca) AS DOUBLE) AS marcas_distintas
      FROM d_fato WHERE data_pedido < {d} GROUP BY cliente_id) m
JOIN (SELECT cliente_id, max(r) AS melhor FROM (
        SELECT cliente_id, marca, CAST(sum(receita) AS DOUBLE) AS r FROM d_fato WHERE data_pedido < {d} GROUP BY 1, 2)
      GROUP BY 1) b ON m.cliente_id = b.cliente_id
LEFT JOIN d_lanc_{tag} l ON m.cliente_id = l.cliente_id"""
    R[f"d_feat_{tag}"] = f"""
SELECT r.cliente_id, recencia_dias, frequencia_pedidos, valor_total, ticket_medio, margem_total, margem_percentual,
  intervalo_medio_dias, desvio_intervalo_dias, atraso_relativo, pedidos_ultimos_90d,
  coalesce(oportunidades_abertas, 0.0) AS oportunidades_abertas, coalesce(oportunidades_ganhas, 0.0) AS oportunidades_ganhas,
  taxa_ganho, coalesce(visitas_90d, 0.0) AS visitas_90d, conversao_visita, skus_distintos, categorias_distintas,
  marcas_distintas, concentracao_marca_top, comprou_lancamento, sem_historico_ritmo, {d} AS _referencia
FROM d_rfm_{tag} r JOIN d_ritmo_{tag} t ON r.cliente_id = t.cliente_id JOIN d_mix_{tag} m ON r.cliente_id = m.cliente_id
LEFT JOIN d_opp_{tag} o ON r.cliente_id = o.cliente_id LEFT JOIN d_vis_{tag} v ON r.cliente_id = v.cliente_id"""


_feature_relations("t", TRAIN_REF)
_feature_relations("s", SCORE_REF)
for _i in range(12):
    _feature_relations(f"h{_i}", f"{2000 + (8 + _i) // 12}-{(8 + _i) % 12 + 1:02d}-01")
R["d_alvo"] = f"""
SELECT DISTINCT cliente_id FROM d_fato WHERE data_pedido BETWEEN DATE '{TRAIN_REF}' AND DATE '{TRAIN_REF}' + 6"""
R["d_treino"] = """
SELECT f.*, CASE WHEN a.cliente_id IS NULL THEN 0.0 ELSE 1.0 END AS comprou_em_7d
FROM d_feat_t f LEFT JOIN d_alvo a ON f.cliente_id = a.cliente_id"""

# ---- scores and queue ---------------------------------------------------------------------------
R["d_score"] = "SELECT cliente_id, round(1 / (1 + recencia_dias), 6) AS score FROM d_rfm_s"
R["d_faixas"] = """
SELECT cliente_id, score, ['Muito quente','Quente','Morna','Fria'][CAST(least(ceil(rk / (n / 4.0)), 4) AS INTEGER)] AS faixa
FROM (SELECT *, row_number() OVER (ORDER BY score DESC, md5(cliente_id), cliente_id) AS rk, count(*) OVER () AS n FROM d_score)"""
R["d_pontuado"] = """
SELECT t.*, round(1 / (1 + recencia_dias), 6) AS score FROM d_treino t"""
# the open assignment of an active rep that began last
R["d_responsavel"] = """
SELECT DISTINCT ON (cliente_id) cliente_id, vendedor_id, vendedor
FROM (SELECT * FROM d_carteira WHERE vigente AND NOT orfao_vendedor_desligado)
JOIN (SELECT vendedor_id, nome AS vendedor FROM d_vendedores WHERE ativo) USING (vendedor_id)
ORDER BY cliente_id, data_inicio DESC NULLS LAST, carteira_id DESC"""
R["d_elegiveis"] = """
SELECT * FROM d_faixas JOIN d_responsavel USING (cliente_id)
JOIN (SELECT cliente_id, razao_social, cidade, uf FROM d_dim_cliente) USING (cliente_id)
JOIN (SELECT cliente_id, ticket_medio, atraso_relativo, recencia_dias, intervalo_medio_dias, valor_total, comprou_lancamento
      FROM d_feat_s) USING (cliente_id)"""
R["d_top"] = "SELECT * FROM d_elegiveis ORDER BY score DESC, cliente_id LIMIT 200"
R["d_limite"] = """
SELECT min(valor_total) AS limite FROM (
  SELECT valor_total, cume_dist() OVER (ORDER BY valor_total) AS cd FROM d_feat_s) WHERE cd >= 0.75"""


R["d_recentes"] = f"SELECT DISTINCT cliente_id, sku FROM d_fato WHERE data_pedido >= DATE '{SCORE_REF}' - 90"
R["d_prateleira"] = """
SELECT sku, marca, nome, saldo FROM (SELECT sku, saldo FROM d_estoque_atual WHERE saldo > 0)
JOIN (SELECT sku, marca, nome FROM d_produtos) USING (sku)"""


def _suggestion_relations(tag: str, customers: str) -> None:
    """Preferred brand, then every shelf place of that brand except those of recent purchases."""
    R[f"d_pref_{tag}"] = f"""
SELECT DISTINCT ON (cliente_id) cliente_id, marca FROM (
  SELECT cliente_id, marca, sum(receita) AS gasto FROM d_fato SEMI JOIN {customers} USING (cliente_id)
  WHERE data_pedido >= DATE '{SCORE_REF}' - 90 GROUP BY ALL) ORDER BY cliente_id, gasto DESC, marca"""
    R[f"d_pares_{tag}"] = f"""
SELECT *, count(*) OVER (PARTITION BY cliente_id) AS candidatos,
  row_number() OVER (PARTITION BY cliente_id ORDER BY saldo DESC, md5(sku), sku) AS rn
FROM d_pref_{tag} JOIN d_prateleira USING (marca) ANTI JOIN d_recentes USING (cliente_id, sku)"""


_suggestion_relations("top", "d_top")
_suggestion_relations("todos", "d_elegiveis")


def _texts(parts: tuple[str, ...], *values: str) -> str:
    """Fixed text parts with a value between each two."""
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || ".join(x for pair in zip(quoted, values) for x in pair) + " || " + quoted[-1]


# the texts are the fixed ones of the queue, in the order in which its rules are tried
REASON = f"""
CASE WHEN intervalo_medio_dias IS NOT NULL AND atraso_relativo > {wq.VERY_LATE}
     THEN {_texts(wq.TEXT_VERY_LATE, "format('{:,.0f}', intervalo_medio_dias)", "format('{:,.0f}', recencia_dias)")}
     WHEN intervalo_medio_dias IS NOT NULL AND atraso_relativo > {wq.LATE}
     THEN {_texts(wq.TEXT_LATE, "format('{:,.1f}', atraso_relativo)")}
     WHEN comprou_lancamento = 1 THEN '{wq.TEXT_LAUNCH}'
     WHEN valor_total >= (SELECT limite FROM d_limite) THEN {_texts(wq.TEXT_BIG, "format('{:,.2f}', valor_total)")}
     ELSE '{wq.TEXT_STEADY}' END"""
R["d_fila"] = f"""
SELECT * EXCLUDE (score, ticket_medio, palpite), round(score, 4) AS score, {half_up('ticket_medio', 2)} AS ticket_medio,
  {REASON} AS motivo, coalesce(palpite, '{wq.TEXT_NO_SUGGESTION}') AS sugestao,
  CAST(row_number() OVER (PARTITION BY vendedor_id ORDER BY score DESC, cliente_id) AS INTEGER) AS ordem
FROM d_top LEFT JOIN (
  SELECT cliente_id, sku || {_texts(wq.TEXT_SUGGESTION, "nome", "saldo")} AS palpite FROM d_pares_top WHERE rn = 1) USING (cliente_id)"""


def sql(statement: str) -> str:
    """Prefix the statement with every relation it needs, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bd_\w+", text):
            if name in R and name not in order:
                visit(R[name])
                order.append(name)

    visit(statement)
    if not order:
        return statement.strip()
    parts = ",\n".join(f"{n} AS ({R[n].strip()})" for n in order)
    return f"WITH {parts}\n{statement.strip()}"
