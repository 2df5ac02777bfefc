"""Cleansing rules on hand-made rows, and typed adapters against cleaned raw text."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vendaflow import schemas
from vendaflow.operators import quality, silver


def raw(spark, table, rows):
    cols = schemas.RAW_TABLES[table][2]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, schemas.raw_schema(table))


def customer(i, cnpj, day="2024-01-01", **kw):
    return {"cliente_id": str(i), "cnpj": cnpj, "razao_social": kw.get("nome", "x"), "data_cadastro": day,
            "ativo": kw.get("ativo", "S")}


def test_customer_text_rules(spark):
    rows = [customer(1, "12.345.678/0001-90", nome="  MARIA  DA   SILVA "),
            customer(2, " 1234567000190 ", "31/12/2024", ativo="N"),
            customer(3, "123456789012345", "2024-1-5", ativo=None),
            customer(4, None, "", ativo="x")]
    got = {r.cliente_id: r for r in silver.clientes(raw(spark, "clientes", rows)).collect()}
    assert got["1"].cnpj == "12345678000190" and got["1"].razao_social == "Maria Da Silva"
    assert got["2"].cnpj == "01234567000190" and got["2"].data_cadastro == date(2024, 12, 31)
    assert got["2"].ativo is False and got["1"].ativo is True
    assert got["3"].cnpj == "123456789012345" and got["3"].data_cadastro is None and got["3"].ativo is False
    assert got["4"].cnpj is None and got["4"].data_cadastro is None and got["4"].ativo is False


def test_dedup_keeps_oldest_then_smallest_text_id_and_lists_the_rest(spark):
    same = "12345678000190"
    rows = [customer(9, same, "2024-01-02"), customer(10, " 12.345.678/0001-90", "2024-01-02"),
            customer(7, same, "2024-05-01"), customer(5, "1")]
    got = {r.cliente_id: r for r in silver.clientes(raw(spark, "clientes", rows)).collect()}
    assert set(got) == {"10", "5"}
    assert got["10"].qtd_registros == 3 and got["5"].qtd_registros == 1


def test_null_tax_ids_form_one_group(spark):
    rows = [customer(1, None, "2024-01-02"), customer(2, None, "2024-01-01")]
    frame = raw(spark, "clientes", rows)
    assert [(r.cliente_id, r.qtd_registros) for r in silver.clientes(frame).collect()] == [("2", 2)]
    assert [r.cliente_id for r in silver.duplicate_map(silver.typed(frame, "clientes")).collect()] == ["1"]


def test_long_and_digitless_tax_ids_are_reported(spark):
    rows = [customer(1, "123456789012345", "2024-01-01"), customer(2, "123456789012346", "2024-01-02"), customer(3, "x-", "2024-01-03"),
            customer(4, "7", "2024-01-03")]
    frame = raw(spark, "clientes", rows)
    kept = silver.clientes(frame)
    assert {r.cliente_id: r.cnpj for r in kept.collect()} == {
        "1": "123456789012345", "2": "123456789012346", "3": "0" * 14, "4": "0" * 13 + "7"}
    profile = quality.dirt_profile(frame).first()
    assert (profile.cnpj_longo, profile.cnpj_sem_digito) == (2, 1)
    broken = {r.regra: r.violacoes for r in quality.constraint_violations({"clientes": kept}).collect()}
    assert broken["cnpj_14_digitos"] == 2 and broken["cnpj_com_digito"] == 1


def test_group_is_complete_in_the_long_form(spark):
    rows = [customer(i, "1", f"2024-01-{i:02d}") for i in range(1, 9)]
    frame = raw(spark, "clientes", rows)
    kept = silver.clientes(frame).collect()
    assert len(kept) == 1 and kept[0].qtd_registros == 8
    long = silver.duplicate_map(silver.typed(frame, "clientes")).collect()
    assert {r.cliente_id for r in long} == {str(i) for i in range(2, 9)}
    assert {r.cliente_id_mantido for r in long} == {"1"}


def test_remap_moves_rows_of_discarded_ids(spark):
    mapping = spark.createDataFrame([("2", "1", "x", 2)], "cliente_id string, cliente_id_mantido string, cnpj string, qtd_registros long")
    orders = spark.createDataFrame([("a", "2"), ("b", "3")], "pedido_id string, cliente_id string")
    got = {r.pedido_id: r.cliente_id for r in silver.remap_duplicate_ids(orders, mapping).collect()}
    assert got == {"a": "1", "b": "3"}


def test_orders(spark):
    rows = [{"pedido_id": " 1", "status": " Cancelado ", "valor_total": "10.50", "data_pedido": "2025-02-03"},
            {"pedido_id": "2", "status": "Faturado", "valor_total": "abc", "data_pedido": "03/02/2025"},
            {"pedido_id": "3", "status": None, "valor_total": " 7 ", "data_pedido": "x"}]
    got = {r.pedido_id: r for r in silver.pedidos(raw(spark, "pedidos", rows)).collect()}
    assert got["1"].cancelado and got["1"].valor_liquido == Decimal("0.00") and got["1"].valor_total == Decimal("10.50")
    assert not got["2"].cancelado and got["2"].valor_liquido is None and (got["2"].ano, got["2"].mes) == (2025, 2)
    assert got["3"].cancelado is False and got["3"].valor_liquido == Decimal("7.00") and got["3"].ano is None


def test_lines_keep_returns_and_flag_discontinued(spark):
    products = silver.produtos(raw(spark, "produtos", [
        {"sku": "a", "ativo": "N", "custo_unitario": "2"}, {"sku": "b", "ativo": "S", "custo_unitario": "x"}]))
    rows = [{"item_id": "1", "sku": "a", "quantidade": "-3"}, {"item_id": "2", "sku": "b", "quantidade": "0"},
            {"item_id": "3", "sku": "zz", "quantidade": "abc"}, {"item_id": "4", "sku": "b", "quantidade": None}]
    got = {r.item_id: r for r in silver.itens_pedido(raw(spark, "itens_pedido", rows), products).collect()}
    assert (got["1"].devolucao, got["1"].quantidade_abs, got["1"].sku_descontinuado) == (True, 3, True)
    assert (got["2"].devolucao, got["2"].quantidade_abs, got["2"].sku_descontinuado) == (False, 0, False)
    assert (got["3"].quantidade, got["3"].custo_unitario, got["3"].sku_descontinuado) == (None, None, False)
    assert got["4"].devolucao is None and len(got) == 4


def test_assignments(spark):
    reps = silver.vendedores(raw(spark, "vendedores", [
        {"vendedor_id": "on"}, {"vendedor_id": "off", "data_desligamento": "2025-01-01"}]))
    rows = [{"carteira_id": "1", "vendedor_id": "on"}, {"carteira_id": "2", "vendedor_id": "off"},
            {"carteira_id": "3", "vendedor_id": "on", "data_fim": "2025-01-01"},
            {"carteira_id": "4", "vendedor_id": "off", "data_fim": "01/01/2025"}]
    got = {r.carteira_id: (r.vigente, r.orfao_vendedor_desligado)
           for r in silver.carteira(raw(spark, "carteira", rows), reps).collect()}
    assert got == {"1": (True, False), "2": (False, True), "3": (False, False), "4": (False, False)}


def test_opportunity_stages(spark):
    rows = [{"oportunidade_id": s, "etapa": s} for s in (" Fechado ganho", "Fechado perdido ", "Proposta Enviada")]
    rows.append({"oportunidade_id": "nada", "etapa": None})
    got = {r.oportunidade_id: (r.etapa, r.ganancia, r.perdida)
           for r in silver.oportunidades(raw(spark, "oportunidades", rows)).collect()}
    assert got == {"Fechado ganho": ("ganha", True, False), "Fechado perdido": ("perdida", False, True),
                   "Proposta Enviada": ("proposta enviada", False, False), "nada": (None, False, False)}


def test_stockout_only_at_zero(spark):
    rows = [{"sku": s, "saldo": s} for s in ("0", "5", "-1", "x")]
    got = {r.sku: r.ruptura for r in silver.estoque(raw(spark, "estoque", rows)).collect()}
    assert got == {"0": True, "5": False, "-1": False, "x": False}


@pytest.mark.parametrize("table, build, typed", [
    ("pedidos", lambda d: silver.pedidos(d.raw_pedidos), lambda d: d.pedidos),
    ("itens", lambda d: silver.itens_pedido(d.raw_itens, d.produtos), lambda d: d.itens),
    ("pagamentos", lambda d: silver.pagamentos(d.raw_pagamentos), lambda d: d.pagamentos)])
def test_typed_adapters_equal_cleaned_text(domain, table, build, typed):
    a, b = build(domain), typed(domain)
    b = b.select([F.col(f.name).cast(f.dataType) for f in a.schema.fields])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
