"""Which terms set a source apart from its language, and how far sources of a language lie from one another.

Terms of a group that share their two counts, in the group and in the language, form a cell: the divergence is evaluated once per
cell, cells are ranked by their cumulative multiplicity, and only the cells that reach the report are expanded into terms."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaflow.session import materialize

#: Bytes of a term: ASCII letters in lower case and every byte of a character outside ASCII; all others separate terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Counts that a task holds before it hands them on, and counts of terms by source that one block may hold at most.
HELD, BLOCK = 400_000, 2_000_000
#: Entries of the dense (source, cell) matrix of one step.
DENSE = 2_000_000
SCALE, PRIOR = 1_000_000_000, 5

_COUNTS = "lang string, source string, term binary, n long, docs long"


def _count_terms(batches):
    """Occurrences and documents of each term by language and source; a row without a term says that the group occurs."""
    words: dict[tuple, Counter] = {}
    held: dict[tuple, Counter] = {}

    def rows():
        out = [[], [], [], [], []]
        for (lang, source), found in words.items():
            docs = held[lang, source]
            out[0] += [lang] * (len(found) + 1)
            out[1] += [source] * (len(found) + 1)
            out[2] += [None, *found]
            out[3] += [0, *found.values()]
            out[4] += [0, *map(docs.__getitem__, found)]
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        words.clear()
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            terms = text.translate(TERM_BYTES).split()
            words.setdefault((lang, source), Counter()).update(terms)
            held.setdefault((lang, source), Counter()).update(set(terms))
        if sum(map(len, words.values())) > HELD:
            yield rows()
    if words:
        yield rows()


def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kept)) in whole numbers; null where nothing is kept."""
    return F.expr(f"1 + ({SCALE}BD * (cast({count} as decimal(20,0)) + {PRIOR})) div nullif(cast({total} as decimal(20,0)) + {PRIOR} * cast({kept} as decimal(15,0)), 0)")


def _distances(key, cells: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of absolute differences over the cells of one block, for each two sources of the language (the first name smaller)."""
    order = np.argsort(np.array(sources["name"].to_pylist(), object))
    names = sources["name"].take(pa.array(order))
    empty = sources["empty"].fill_null(0).to_numpy()[order]
    at = np.empty(len(order), np.int64)
    at[sources["place"].to_numpy()[order]] = np.arange(len(order))
    sums = np.zeros((len(order), len(order)), np.int64)
    step = max(1, DENSE // max(1, len(order)))
    for start in range(0, cells.num_rows, step):
        part = cells.slice(start, step).combine_chunks()
        profile = part["profile"].chunk(0)
        owner = np.repeat(np.arange(part.num_rows), np.diff(profile.offsets.to_numpy()))
        entries = profile.flatten()
        shares = np.repeat(empty[:, None], part.num_rows, 1)
        shares[at[entries.field("place").to_numpy(zero_copy_only=False)], owner] = entries.field("p").to_numpy(zero_copy_only=False)
        many = part["m"].to_numpy()
        for i in range(len(order) - 1):
            sums[i, i + 1:] += np.abs(shares[i + 1:] - shares[i]) @ many
    i, j = np.triu_indices(len(order), 1)
    return pa.table({"lang": pa.repeat(key[0], len(i)).cast(pa.string()), "a": names.take(pa.array(i)), "b": names.take(pa.array(j)), "value": sums[i, j]})


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang",
                      source_col: str = "source") -> DataFrame:
    """Divergence of every (language, source) group from its language, by term, and from the language's other sources.

    A language keeps the terms that at least `min_docs` of its documents hold. A group's share of a kept term is
    p = 1 + floor(1e9 * (count + 5) / (N + 5 V)), N the group's occurrences of kept terms and V their number; the language's share q
    likewise. Part `term` lists the `top` terms with the largest p - q above zero among those that occur in the group; part `pair`
    lists every other source of the language with the sum of absolute differences of the shares over all kept terms (0 without any).

    Terms are runs of ASCII letters and characters outside ASCII, with only A-Z lower-cased. Null text, language and source count as
    empty; a group without terms still has its pairs; repeated rows count as often as they stand; ties are ordered by the UTF-8 bytes
    of the item; an empty table gives no rows; other columns are ignored. Returns lang, source, part, item, value, rank."""
    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    given = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).cast("binary").alias("text"))
    counted = materialize(given.mapInArrow(_count_terms, _COUNTS).groupBy("lang", "source", F.col("term").cast("string").alias("term"))
                          .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "termos")
    of_lang = materialize(counted.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
                          .where(F.col("docs") >= min_docs).drop("docs"), "termos-lingua")
    kept = materialize(counted.where("term is not null").select("lang", "source", "term", "n").join(of_lang, ["lang", "term"]), "mantidos")
    langs = of_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_sum"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_sum"))
    groups = (counted.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("group_sum", F.lit(0)).alias("group_sum"), F.coalesce("kept", F.lit(0)).alias("kept"),
                      F.coalesce("lang_sum", F.lit(0)).alias("lang_sum")))
    # a source's place among those of its language stands for its name in the profiles
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = materialize(groups.withColumn("place", place).withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang"))), "grupos")
    return _terms(kept, groups, top).unionAll(_pairs(kept, groups))


def _terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    cells = kept.groupBy("lang", "source", "n", "total").agg(F.count(F.lit(1)).alias("m"))
    worth = _share("n", "group_sum", "kept") - _share("total", "lang_sum", "kept")
    valued = materialize(cells.join(groups, ["lang", "source"]).withColumn("value", worth).where("value > 0")
                         .select("lang", "source", "n", "total", "m", "value"), "celas")
    within = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # every value holds a term at least, so no more than `top` values of a group can matter
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("m").alias("m")).withColumn("place", F.row_number().over(within)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("m").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = merged.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value")
    chosen = valued.join(reached, ["lang", "source", "value"]).select("lang", "source", "n", "total", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return (kept.join(chosen, ["lang", "source", "n", "total"]).withColumn("rank", rank).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Terms with the same shares in all sources are one cell; cells are dealt in blocks, each of which meets the list of sources."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("sources") / BLOCK)).cast("int")
    shared = kept.join(groups, ["lang", "source"]).withColumn("p", _share("n", "group_sum", "kept")).withColumn("blocks", blocks)
    profiles = shared.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("place", "p"))).alias("profile"), F.first("blocks").alias("blocks"))
    cells = profiles.groupBy("lang", "profile").agg(F.count(F.lit(1)).alias("m"), F.first("blocks").alias("blocks"))
    cells = cells.select("lang", F.pmod(F.xxhash64("profile"), "blocks").cast("int").alias("block"), "profile", "m")
    sources = groups.select("lang", F.col("source").alias("name"), "place", _share("0", "group_sum", "kept").alias("empty"),
                            F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    parts = cells.groupBy("lang", "block").cogroup(sources.groupBy("lang", "block")).applyInArrow(_distances, "lang string, a string, b string, value long")
    pairs = materialize(parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pares")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionAll(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
