"""Table contracts as data: raw columns, typing rules, CHECK predicates and comments.

Column names, stage names and the flag letters are fixed values of the domain.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Source system, file name and header of every raw extract.
RAW_TABLES: dict[str, tuple[str, str, list[str]]] = {
    "produtos": ("erp", "produtos.csv", [
        "sku", "descricao", "categoria", "marca", "nota_olfativa", "preco_tabela",
        "custo_unitario", "unidade", "ativo", "data_lancamento"]),
    "pedidos": ("erp", "pedidos.csv", [
        "pedido_id", "cliente_id", "vendedor_id", "data_pedido", "canal", "status", "valor_total"]),
    "itens_pedido": ("erp", "itens_pedido.csv", [
        "item_id", "pedido_id", "sku", "quantidade", "preco_praticado", "desconto_pct", "valor_bruto"]),
    "pagamentos": ("erp", "pagamentos.csv", [
        "pagamento_id", "pedido_id", "forma_pagamento", "parcelas", "valor", "taxa_pct",
        "valor_liquido", "data_vencimento", "data_pagamento", "status_pagamento"]),
    "estoque": ("erp", "estoque.csv", ["data_snapshot", "sku", "saldo", "ruptura"]),
    "clientes": ("crm", "clientes.csv", [
        "cliente_id", "cnpj", "razao_social", "segmento", "cidade", "uf", "bairro",
        "data_cadastro", "ativo"]),
    "vendedores": ("crm", "vendedores.csv", [
        "vendedor_id", "nome", "regiao", "uf", "data_admissao", "data_desligamento", "meta_mensal"]),
    "carteira": ("crm", "carteira.csv", [
        "carteira_id", "cliente_id", "vendedor_id", "data_inicio", "data_fim"]),
    "oportunidades": ("crm", "oportunidades.csv", [
        "oportunidade_id", "cliente_id", "vendedor_id", "origem", "data_abertura", "etapa",
        "probabilidade_pct", "valor_estimado", "data_fechamento", "ciclo_dias", "motivo_perda"]),
    "visitas": ("crm", "visitas.csv", [
        "visita_id", "cliente_id", "vendedor_id", "data_visita", "resultado", "duracao_min"]),
}

# Typing rule per silver column: (target, source, kind). Kinds are resolved in functions.text.
SILVER_COLUMNS: dict[str, list[tuple[str, str, str]]] = {
    "clientes": [
        ("cliente_id", "cliente_id", "text"), ("cnpj", "cnpj", "cnpj"),
        ("razao_social", "razao_social", "title"), ("data_cadastro", "data_cadastro", "date"),
        ("ativo", "ativo", "flag"), ("segmento", "segmento", "text"), ("cidade", "cidade", "text"),
        ("uf", "uf", "text"), ("bairro", "bairro", "text")],
    "pedidos": [
        ("pedido_id", "pedido_id", "text"), ("cliente_id", "cliente_id", "text"),
        ("vendedor_id", "vendedor_id", "text"), ("data_pedido", "data_pedido", "date"),
        ("canal", "canal", "text"), ("valor_total", "valor_total", "money")],
    "produtos": [
        ("sku", "sku", "text"), ("nome", "descricao", "text"), ("categoria", "categoria", "text"),
        ("marca", "marca", "text"), ("nota_olfativa", "nota_olfativa", "text"),
        ("data_lancamento", "data_lancamento", "date"), ("preco_tabela", "preco_tabela", "money"),
        ("custo_unitario", "custo_unitario", "money"), ("unidade", "unidade", "text"),
        ("ativo", "ativo", "flag")],
    "itens_pedido": [
        ("item_id", "item_id", "text"), ("pedido_id", "pedido_id", "text"), ("sku", "sku", "text"),
        ("quantidade", "quantidade", "int"), ("preco_praticado", "preco_praticado", "money"),
        ("desconto_pct", "desconto_pct", "money"), ("valor_bruto", "valor_bruto", "money")],
    "vendedores": [
        ("vendedor_id", "vendedor_id", "text"), ("nome", "nome", "text"),
        ("regiao", "regiao", "text"), ("uf", "uf", "text"),
        ("data_admissao", "data_admissao", "date"),
        ("data_desligamento", "data_desligamento", "date"), ("ativo", "data_desligamento", "absent"),
        ("meta_mensal", "meta_mensal", "money")],
    "carteira": [
        ("carteira_id", "carteira_id", "text"), ("cliente_id", "cliente_id", "text"),
        ("vendedor_id", "vendedor_id", "text"), ("data_inicio", "data_inicio", "date"),
        ("data_fim", "data_fim", "date"), ("_aberta", "data_fim", "absent")],
    "oportunidades": [
        ("oportunidade_id", "oportunidade_id", "text"), ("cliente_id", "cliente_id", "text"),
        ("vendedor_id", "vendedor_id", "text"), ("origem", "origem", "text"),
        ("etapa", "etapa", "text"), ("data_abertura", "data_abertura", "date"),
        ("data_fechamento", "data_fechamento", "date"),
        ("probabilidade_pct", "probabilidade_pct", "percent"),
        ("valor_estimado", "valor_estimado", "money"), ("ciclo_dias", "ciclo_dias", "int"),
        ("motivo_perda", "motivo_perda", "text")],
    "visitas": [
        ("visita_id", "visita_id", "text"), ("cliente_id", "cliente_id", "text"),
        ("vendedor_id", "vendedor_id", "text"), ("data_visita", "data_visita", "date"),
        ("resultado", "resultado", "text"), ("duracao_min", "duracao_min", "int")],
    "pagamentos": [
        ("pagamento_id", "pagamento_id", "text"), ("pedido_id", "pedido_id", "text"),
        ("forma_pagamento", "forma_pagamento", "text"), ("parcelas", "parcelas", "int"),
        ("valor", "valor", "money"), ("valor_liquido", "valor_liquido", "money"),
        ("taxa_pct", "taxa_pct", "percent"), ("data_vencimento", "data_vencimento", "date"),
        ("data_pagamento", "data_pagamento", "date"),
        ("status_pagamento", "status_pagamento", "text")],
    "estoque": [
        ("data_snapshot", "data_snapshot", "date"), ("sku", "sku", "text"),
        ("saldo", "saldo", "int")],
}

# CHECK names. A row violates the rule when the predicate is false (NULL passes, as in SQL).
CHECKS: dict[str, dict[str, str]] = {
    "clientes": {
        "cnpj_14_digitos": "length(cnpj) = 14",
        "cnpj_com_digito": "cnpj <> '00000000000000'",
        "data_cadastro_obrigatoria": "data_cadastro IS NOT NULL"},
    "pedidos": {
        "data_pedido_obrigatoria": "data_pedido IS NOT NULL",
        "pedido_cancelado_zerado": "NOT cancelado OR valor_liquido = 0"},
    "itens_pedido": {"quantidade_abs_positiva": "quantidade_abs > 0"},
}

FACT_COMMENTS: dict[str, str] = {
    "quantidade": "Peças da linha, com sinal: menor que zero quando volta mercadoria.",
    "receita": "quantidade vezes preco_praticado, com o sinal da quantidade.",
    "custo": "quantidade_abs vezes custo_unitario do cadastro; zero ou mais.",
    "margem": "receita - custo.",
    "devolucao": "quantidade < 0.",
    "sku_descontinuado": "SKU inativo no cadastro de hoje.",
}

TABLE_COMMENTS: dict[str, str] = {
    **{t: f"Extrato ou tabela limpa de {t}." for t in RAW_TABLES},
    "_raw_arquivos": "Arquivos recebidos na última carga, com tamanho e linhas.",
    "clientes_descartados": "Cada cadastro repetido e o cadastro que ficou no lugar.",
    "dim_cliente": "Um cliente por linha, com o resumo das compras.",
    "dim_produto": "Um SKU por linha.",
    "dim_vendedor": "Um vendedor por linha.",
    "dim_calendario": "Um dia por linha.",
    "fato_vendas": "Uma linha de pedido faturado por linha, devoluções incluídas.",
    "mart_vendas_por_vendedor": "Vendas de cada vendedor em cada mês, contra a meta.",
    "mart_produto_performance": "Vendas de cada SKU em cada mês, com a classe ABC.",
    "mart_financeiro_recebimento": "Parcelas por mês de vencimento.",
    "features_treino": "Variáveis até o corte de treino, com o rótulo da semana seguinte.",
    "features_cliente": "As mesmas variáveis no corte de pontuação.",
    "score_propensao": "Propensão de compra por cliente.",
    "calibragem_holdout": "Taxa observada por faixa na parte reservada.",
    "diag_falha_modelo": "Números do treino que a aceitação recusou.",
    "modelo_artefato": "Onde está o modelo salvo.",
    "fila_semanal": "Quem ligar para quem nesta semana, e por quê.",
}
COLUMN_COMMENTS: dict[str, str] = {
    **FACT_COMMENTS,
    "cnpj": "Só dígitos, com zeros à esquerda até catorze; números maiores ficam inteiros.",
    "data_cadastro": "Data lida de um dos dois formatos; nula quando ilegível.",
    "qtd_registros": "Cadastros com o mesmo CNPJ.",
    "cliente_id_mantido": "Cadastro que representa este CNPJ.",
    "valor_liquido": "Zero em pedido cancelado.",
    "vigente": "Carteira aberta com vendedor em atividade.",
    "orfao_vendedor_desligado": "Carteira aberta cujo vendedor saiu.",
    "ruptura": "Saldo igual a zero.",
    "receita_acumulada": "Soma do valor bruto dos pedidos válidos.",
    "dias_sem_comprar": "Dias entre o último pedido e a data de referência.",
    "descontinuado": "O contrário de ativo.",
    "pedidos_unicos": "Pedidos diferentes no período.",
    "atingimento_pct": "Receita sobre a meta do mês, em %.",
    "curva_abc": "A até 80 % da receita acumulada do mês, B até 95 %, C o resto.",
    "atraso_medio_dias": "Média de dias depois do vencimento.",
    "custo_taxa": "Taxas das formas de pagamento.",
    "recencia_dias": "Dias desde a última compra antes do corte.",
    "atraso_relativo": "Recência sobre o intervalo médio, no máximo 10.",
    "score": "Entre 0 e 1.",
    "faixa": "Quartil do score, do mais quente ao mais frio.",
    "_referencia": "Data de corte.",
    "_linhas_origem": "Linhas do extrato de origem.",
    "_processado_em": "Momento da limpeza.",
    "_ingerido_em": "Momento da leitura.",
    "_arquivo_origem": "Arquivo de onde veio a linha.",
}

# The twenty model features, in table order.
FEATURES: list[str] = [
    "recencia_dias", "frequencia_pedidos", "valor_total", "ticket_medio", "margem_total",
    "margem_percentual", "intervalo_medio_dias", "desvio_intervalo_dias", "atraso_relativo",
    "pedidos_ultimos_90d", "oportunidades_abertas", "oportunidades_ganhas", "taxa_ganho",
    "visitas_90d", "conversao_visita", "skus_distintos", "categorias_distintas",
    "marcas_distintas", "concentracao_marca_top", "comprou_lancamento",
]
LABEL = "comprou_em_7d"

QUEUE_SCHEMA = T.StructType([
    T.StructField("vendedor", T.StringType(), True, {"comment": "Quem deve ligar."}),
    T.StructField("ordem", T.IntegerType(), True, {"comment": "Posição na fila do vendedor; 1 é a primeira."}),
    T.StructField("cliente_id", T.StringType(), True, {"comment": "Chave para as consultas de contexto."}),
    T.StructField("razao_social", T.StringType(), True, {"comment": "Nome do cliente."}),
    T.StructField("cidade", T.StringType(), True, {"comment": "Cidade do cliente."}),
    T.StructField("uf", T.StringType(), True, {"comment": "UF do cliente."}),
    T.StructField("score", T.DoubleType(), True, {"comment": "Propensão entre 0 e 1."}),
    T.StructField("faixa", T.StringType(), True, {"comment": "Quartil do score."}),
    T.StructField("ticket_medio", T.DoubleType(), True, {"comment": "Valor médio por pedido."}),
    T.StructField("motivo", T.StringType(), True, {"comment": "Por que ligar."}),
    T.StructField("sugestao", T.StringType(), True, {"comment": "SKU com saldo que o cliente não comprou há pouco."}),
    T.StructField("vendedor_id", T.StringType(), True, {"comment": "Chave do vendedor; nomes se repetem."}),
])


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_TABLES[table][2]])
