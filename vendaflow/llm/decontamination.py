"""Benchmark passages inside documents by a prefix-filtered join (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
#: Rows of benchmark shingles (about 40 bytes each) up to which they are broadcast; beyond, the same join shuffles.
BROADCAST_SHINGLES = 1_000_000
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    """Words after lower-casing A-Z. `lower` is faster than `translate` and the same unless other letters have case; letters
    that the pattern's Unicode version does not know yet may have."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{Cn}&&[^A-Z]]"), F.translate(text, _UPPER, _SMALL)).otherwise(F.lower(text))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _key(at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(F.col("words"), at + j) for j in range(size)])


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every different window of each item once: window (digest of its words), item, n_win (words), words."""
    items = (benchmark.select(F.col(id_col).alias("item"), _words(F.col(text_col)).alias("words"))
             .where("item is not null and size(words) > 0")
             .withColumn("n_win", F.least(F.lit(WINDOW), F.size("words"))))
    starts = items.select("item", "n_win", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("n_win"))).alias("s"), "words")
    return (starts.select("item", "n_win", F.expr("slice(words, s + 1, n_win)").alias("words"))
            .withColumn("window", F.sha2(F.concat_ws(" ", F.col("words")), 256)).dropDuplicates(["item", "window"]))


def window_shingles(windows: DataFrame) -> DataFrame:
    """One row per different window and shingle in it, however many items hold it: window, n_win, offset, n_shingles, size, key."""
    sized = (windows.dropDuplicates(["window"]).withColumn("size", F.least(F.lit(SHINGLE), F.col("n_win")))
             .withColumn("n_shingles", F.col("n_win") - F.col("size") + 1))
    key = F.when(F.col("size") == 3, _key(F.col("offset"), 3)).when(F.col("size") == 2, _key(F.col("offset"), 2)).otherwise(
        _key(F.col("offset"), 1))
    return (sized.select("*", F.explode(F.sequence(F.lit(0), F.col("n_shingles") - 1)).alias("offset"))
            .select("window", "n_win", "n_shingles", "offset", "size", key.alias("key")))


def _item_lists(occurring: DataFrame, owners: DataFrame) -> DataFrame:
    """row, n_items, items_sha256 from rows (row, window) and (window, item).

    Windows with the same items form a class, and rows with the same classes share one list, so a template that many items
    and many documents hold is listed once, not once for each of its places."""
    held = owners.groupBy("window").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    held = materialize(held.select("window", F.sha2(F.to_json("items"), 256).alias("class"), "items"), "itens")
    sets = (occurring.join(held.select("window", "class"), "window").groupBy("row")
            .agg(F.array_sort(F.collect_set("class")).alias("classes")).withColumn("set", F.sha2(F.array_join("classes", ","), 256)))
    sets = materialize(sets, "conjuntos")
    lists = (sets.dropDuplicates(["set"]).select("set", F.explode("classes").alias("class"))
             .join(held.dropDuplicates(["class"]).select("class", "items"), "class").groupBy("set")
             .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
             .select("set", F.size("items").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")))
    return sets.select("row", "set").join(lists, "set").select("row", "n_items", "items_sha256")


def find_benchmark_words(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Words of every document that lie inside a window of ten consecutive words of a benchmark item.

    An item with fewer words, but not none, is one window. Every document is read once: its words are exploded with
    their positions and looked up by three-word shingle among the benchmark's (shorter items: their whole sequence),
    and only hits are written. Their counts over all documents order each window's shingles by rarity. Containment of
    a whole window makes every one of its shingles necessary, so the rarest alone is joined; a window with a shingle
    that occurs nowhere is out. The length bound asks that the window ends inside the document, the positional
    bound that every further shingle stands at its own distance; all of them must, which is exact containment, and the
    same holds for each occurrence. A window that several items hold is sought once; its items are attached to what was found.

    Null text has no words and null items are ignored; null ids and repeated rows are kept row by row; empty tables give
    no hits. Other columns are ignored. Returns id, n_words, n_hit, n_items, items_sha256, contaminated."""
    owned = materialize(benchmark_windows(benchmark, item_col, item_text_col), "janelas")
    windows = materialize(window_shingles(owned), "trechos")
    shingles = windows.select("size", "key").distinct()
    facts = windows.agg(F.collect_set("size").alias("sizes")).first()
    sizes = sorted(facts["sizes"], reverse=True) or [SHINGLE]
    known = shingles.select("key", F.lit(True).alias("known"))
    if shingles.count() <= BROADCAST_SHINGLES:
        known = F.broadcast(known)
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), _words(F.col(text_col)).alias("words"))
    words = rows.select("id", "row", "words", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "w"))
    keys = [_key(F.col("pos"), size) for size in sizes]
    if len(keys) == 1:
        keyed = words.select("id", "row", "n_words", "pos", keys[0].alias("key"))
    else:
        keyed = words.select("id", "row", "n_words", "pos", F.explode(F.array(*keys)).alias("key"))
    found = (keyed.join(known, "key", "left")
             .where("known or pos is null or pos = 0")
             .select("id", "row", "n_words", "pos", F.when(F.col("known"), F.col("key")).alias("key")))
    found = materialize(found, "achados")
    base = found.where("pos is null or pos = 0").groupBy("row").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"))
    hits = found.where("key is not null").select("row", "n_words", "pos", "key")

    counts = hits.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    ranked = windows.join(counts, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_rarity = Window.partitionBy("window")
    prefix = (ranked.withColumn("least", F.min(F.struct("n", "offset")).over(by_rarity))
              .where("least.n > 0 and least.offset = offset")
              .select("key", "window", "n_win", "n_shingles", "offset"))
    prefix = materialize(prefix, "prefixos")
    starts = (hits.join(prefix, "key")
              .select("row", "window", "n_win", "n_shingles", (F.col("pos") - F.col("offset")).alias("start"), "n_words")
              .where("start >= 0 and start + n_win <= n_words"))
    starts = materialize(starts.select("row", "window", "n_win", "n_shingles", "start"), "candidatos")
    places = materialize(windows.select("window", "offset", "key"), "lugares")
    asked = starts.join(places, "window").select(
        "row", "window", "n_win", "n_shingles", "start", "key", (F.col("start") + F.col("offset")).alias("pos"))
    kept = (asked.join(hits.select("row", "pos", "key").distinct(), ["row", "pos", "key"])
            .groupBy("row", "window", "n_win", "n_shingles", "start").agg(F.count(F.lit(1)).alias("n"))
            .where("n = n_shingles"))
    kept = materialize(kept.select("row", "window", "start", "n_win"), "ocorrencias")
    hit = (kept.select("row", "start", "n_win").distinct()
           .select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n_win") - 1)).alias("pos"))
           .distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit")))
    items = _item_lists(kept.select("row", "window").distinct(), owned.select("window", "item"))
    return (base.join(hit, "row", "left").join(items, "row", "left")
            .select(F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
