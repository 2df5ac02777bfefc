"""SQL table functions for callers that query by SQL.

Each one filters the DataFrame operator of the same answer for all entities, kept as a view: the rules are written once, and
Catalyst carries the filter on the parameter down to the base tables.
"""

from __future__ import annotations

import uuid
from pyspark.sql import DataFrame, SparkSession

from vendaflow.schemas import COLUMN_COMMENTS, QUEUE_SCHEMA

# name: (parameters, condition, order, description)
FUNCTIONS = {
    "priorizar_carteira": ("p_vendedor STRING COMMENT 'Id do vendedor', p_quantos INT COMMENT 'Quantas ligações'",
                           "vendedor_id = p_vendedor AND ordem <= p_quantos", "ordem", "Primeiras ligações da fila de um vendedor."),
    "contexto_cliente": ("p_cliente_id STRING COMMENT 'Id do cliente'", "cliente_id = p_cliente_id", "cliente_id",
                         "Números, marcas e score de um cliente."),
    "sugerir_produtos": ("p_cliente_id STRING COMMENT 'Id do cliente'", "cliente_id = p_cliente_id", "receita_total DESC, sku",
                         "SKUs que o cliente comprava antes do período recente."),
    "checar_disponibilidade": ("p_sku STRING COMMENT 'SKU'", "sku = p_sku", "sku", "Saldo do SKU no último inventário."),
}


def create(spark: SparkSession, name: str, answers: DataFrame) -> None:
    """Create or replace one function for this session over `answers`, the operator's rows for every entity."""
    parameters, condition, order, description = FUNCTIONS[name]
    told = {**COLUMN_COMMENTS, **{f.name: f.metadata["comment"] for f in QUEUE_SCHEMA.fields}}
    view = f"{name}_{uuid.uuid4().hex[:12]}"
    answers.createOrReplaceTempView(view)

    def column(f) -> str:
        note = " COMMENT '{}'".format(told[f.name].replace("'", "''")) if f.name in told else ""
        return f"{f.name} {f.dataType.simpleString()}{note}"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
              f"RETURNS TABLE({', '.join(column(f) for f in answers.schema.fields)}) COMMENT '{description}' "
              f"RETURN SELECT * FROM {view} WHERE {condition} ORDER BY {order}")


#: Table in the gold layer that answers each function, laid out by the id it is asked for.
SERVED_BY = {"priorizar_carteira": "fila_semanal", "contexto_cliente": "contexto_servico", "sugerir_produtos": "sugestoes_servico",
             "checar_disponibilidade": "disponibilidade_servico"}


def register_table_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the four functions over the tables that the nightly run saved, for this session; returns their names. A call for one
    customer or SKU reads one bucket of one table, not the fact.

    They are temporary because Spark calls a table function by its bare name only.
    """
    for name, table in SERVED_BY.items():
        create(spark, name, spark.table(f"{prefix}gold.{table}"))
    return list(FUNCTIONS)
