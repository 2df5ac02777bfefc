"""Features at many cut-offs, distinct counts from bitmaps, quantiles from sketches."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from vendaflow.operators import active_windows, feature_history, features, month_quantiles, serving
from vendaflow.operators.ordering import exact_quantiles
from vendaflow.schemas import FEATURES


def rounded(df):
    columns = ["cliente_id", "_referencia", "sem_historico_ritmo", *FEATURES]
    return sorted(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect())


def test_history_equals_every_single_table(spark, domain, tmp_path):
    path = str(tmp_path / "fato")
    # some lines without brand or category, some orders without a date
    domain.fato.withColumns({"marca": F.expr("IF(item_id LIKE '%7', NULL, marca)"), "categoria": F.expr("IF(item_id LIKE '%3', NULL, categoria)"),
                             "data_pedido": F.expr("IF(pedido_id % 40 = 1, NULL, data_pedido)")}).write.parquet(path)
    fact = spark.read.parquet(path)
    refs = ["2001-08-01", "1995-01-05", "2001-04-19", "2001-07-25", "1990-01-01", "2001-07-25"]
    found = feature_history.feature_history(fact, domain.oportunidades, domain.visitas, domain.produtos, refs)
    # the result no longer reads the fact: one scan fed it all
    assert path not in found._jdf.queryExecution().executedPlan().toString()
    got = rounded(found)
    want = []
    for ref in sorted(set(refs)):
        want += rounded(features.feature_table(fact, domain.oportunidades, domain.visitas, domain.produtos, ref))
    assert got == sorted(want, key=lambda r: r[:2]) and len({r[1] for r in got}) >= 3


def test_top_share_keeps_one_row_a_brand(spark, monkeypatch):
    """Best brand's share at many cut-offs, in blocks of them: brands are folded into customers before any cut-off makes a row."""
    monkeypatch.setattr(feature_history, "REFS_AT_ONCE", 3)
    line = feature_history.Timeline.of([f"2026-0{m}-01" for m in range(1, 9)])
    at = [line.points.index(r) for r in line.refs]
    data = [(c, b, s, None if (c + s) % 11 == 0 else float(c * s % 7 - 1)) for c in range(6) for b in ("x", "y", None) for s in range(c, len(line.points), 3)]
    found = feature_history._top_share(spark.createDataFrame(data, "cliente_id long, marca string, _seg int, receita double"), line)
    want = {}
    for c in range(6):
        for ref, k in zip(line.refs, at):
            sums = {}
            for _, b, _, v in (d for d in data if d[0] == c and d[2] <= k and d[3] is not None):
                sums[b] = sums.get(b, 0) + v
            if sums and sum(sums.values()):
                want[c, ref] = max(sums.values()) / sum(sums.values())
    got = {(r["cliente_id"], r["_referencia"]): r["concentracao_marca_top"] for r in found.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want) and len(want) > 20
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # three blocks: one Generate each, above both groupings
    assert plan.count("Generate ") == 3 and plan.count("Aggregate ") == 6 and "Window" not in plan


def test_summaries_merge_in_order(spark):
    days = [("a", d) for d in (1, 2, 10, 11, 40)] + [("b", 10)]
    rows = spark.createDataFrame([(c, date(2026, 1, 1) + timedelta(days=d), 1, 1.0, 1.0) for c, d in days], "cliente_id string, data_pedido date, pedidos long, receita double, margem double")
    line = feature_history.Timeline.of(["2026-01-12"])
    merged = feature_history.merged(feature_history.customer_segments(rows, line)).where("cliente_id = 'a'").orderBy("_seg").collect()
    assert merged[-1]["_quadrados"] == 1 + 8**2 + 1 + 29**2 and merged[-1]["_pedidos"] == 5
    assert (merged[-1]["_primeiro"], merged[-1]["_ultimo"]) == (date(2026, 1, 2), date(2026, 2, 10))


def test_numbers_are_dense_and_stay(spark):
    first = active_windows.dense_numbers(spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "c string"), "c")
    known = {r.c: r.numero for r in first.collect()}
    assert sorted(known.values()) == [1, 2, 3]
    more = active_windows.dense_numbers(spark.createDataFrame([("b",), ("x",), ("y",)], "c string"), "c", first)
    after = {r.c: r.numero for r in more.collect()}
    assert {k: after[k] for k in known} == known and sorted(after.values()) == [1, 2, 3, 4, 5]


def test_windows_over_several_blocks(spark):
    # numbers beyond one bitmap, days without sales, a window that reaches before the first day
    rows = spark.range(80_000).select(F.col("id").alias("c"), F.expr("date_add(DATE '2026-01-01', CAST(id % 5 * 3 AS INT))").alias("dia"))
    numbers = active_windows.dense_numbers(rows, "c")
    maps = active_windows.bitmaps(rows.union(rows.limit(100)), numbers, "c", ["dia"]).persist()
    assert maps.select("bloco").distinct().count() == 3
    got = {(r.dia, r.janela): r.distintos for r in active_windows.distinct_by_day(maps, "dia", "2026-01-02", "2026-01-20", [0, 3, 30]).collect()}
    for d in range(2, 21):
        day = date(2026, 1, d)
        for n in (0, 3, 30):
            assert got[day, n] == sum(16_000 for k in range(5) if 0 <= (day - date(2026, 1, 1 + 3 * k)).days <= n), (day, n)
    assert active_windows.distinct_count(maps).first().distintos == 80_000
    assert active_windows.distinct_count(maps.where("false")).first().distintos == 0
    maps.unpersist()


def test_stored_bitmaps_answer_the_single_question(spark, domain):
    sales = serving.sold(domain.fato)
    maps = active_windows.bitmaps(sales, active_windows.dense_numbers(sales, "cliente_id"), "cliente_id", ["data_pedido"])
    last = sales.agg(F.max("data_pedido")).first()[0]
    want = serving.active_customers(domain.fato, last).first()[0]
    assert active_windows.distinct_by_day(maps, "data_pedido", last, last, [30]).first().distintos == want


def test_merged_sketches_keep_their_rank_error(spark):
    values = spark.range(200_000).select(F.expr("CAST(2025 + id % 24 DIV 12 AS INT)").alias("ano"), F.expr("CAST(id % 24 % 12 + 1 AS INT)").alias("mes"),
                                         F.expr("IF(id % 3 = 0, 7.0, CAST(pmod(xxhash64(id), 100000) AS DOUBLE))").alias("v"))
    values = values.union(spark.createDataFrame([(2025, 1, None), (2025, 2, float("nan"))], values.schema))
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    ranges = spark.createDataFrame([(24300 + i, 24300 + i + 3 * i) for i in range(5)] + [(1, 2)], "inicio int, fim int")
    found = month_quantiles.merged_quantiles(month_quantiles.month_sketches(values, "v"), ranges, probs).persist()
    assert found.count() == 5                                # a range without values has no row
    sound = values.where("v IS NOT NULL AND NOT isnan(v)")
    worst = month_quantiles.rank_error(sound, "v", found, probs).select(F.greatest(*[f"erro_{p}" for p in probs]).alias("e")).agg(F.max("e")).first()[0]
    assert worst <= month_quantiles.RANK_ERROR
    exact = exact_quantiles(month_quantiles.in_ranges(sound, ranges), "v", {"p10": 0.1}, ["inicio"])
    assert exact.join(found.select("inicio", F.col("p10").alias("q")), "inicio").where("p10 = 7 AND q <> 7").count() == 0
    found.unpersist()
