"""Repeated passages: every byte inside a long string that starts at two places or more, by prefix-free parsing.

A rolling hash over short windows triggers the phrase breaks (anchors): the smallest hash of every `width` neighbouring
starts. What breaks a text thus depends on the bytes around alone, equal strings are broken alike, and every string of the
asked length holds an anchor. A phrase is the text around an anchor: everything that strings with this first anchor cover.
Phrases form the dictionary, the anchors of a text its parse. Only phrases whose part common to all of their strings
occurs twice are kept; their strings are then put in order by fingerprint, and neighbours that agree are repeats."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaflow.llm.arrow import column, slices, text_bytes, whole_groups
from vendaflow.llm.hashing import Rolling, mix
from vendaflow.llm.tables import bucketed
from vendaflow.session import materialize

LENGTH = 200
_TRIGGER, _BYTES = 16, 1 << 20
#: Members of one phrase group that a task compares at once; larger groups are dealt over several tasks.
GROUP = 1024
_LOW = np.uint64((1 << 32) - 1)


def _width(length: int) -> int:
    return max(1, (length - _TRIGGER) * 3 // 4)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """For rows cut at `offsets`: anchors (byte positions), first and last start of the strings of each, and the rolling hash."""
    none = np.zeros(0, np.int64)
    rolling = Rolling(data)
    width, n = _width(length), len(data)
    if n < length:
        return none, none, none, rolling
    at = np.arange(n - _TRIGGER + 1)
    low = (rolling(at, at + _TRIGGER) & ~_LOW) | at.astype(np.uint64)
    step = 1
    while step * 2 <= width:
        low[:-step] = np.minimum(low[:-step], low[step:])
        step *= 2
    rest = width - step
    if rest:
        low[:-rest] = np.minimum(low[:-rest], low[rest:])
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(offsets[:-1], offsets[1:]) if b - a >= length] or [none])
    if not len(starts):
        return none, none, none, rolling
    where = (low[starts] & _LOW).astype(np.int64)
    new = np.concatenate(([True], (where[1:] != where[:-1]) | (starts[1:] != starts[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(starts)])) - 1
    return where[first], starts[first], starts[last], rolling


def _rows_of(offsets, positions):
    return np.searchsorted(offsets, positions, side="right") - 1


def _keys(length: int):
    common = length - _width(length) + 1

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets, _BYTES):
                part, ends = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                at, _, _, rolling = anchors(part, ends, length)
                if not len(at):
                    continue
                key, row = rolling(at, at + common), _rows_of(ends, at)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0).take(pa.array(a + row)), pa.array((at - ends[row]).astype(np.int32))],
                                                 ["key", "digest", "pos"])
    return run


def _phrases(length: int):
    """digest, text, the anchors (pos, key, salts) to compare -> phrases, one per distinct content in this batch."""
    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            wanted = batch.column(2)
            for a, b in slices(offsets, _BYTES):
                part, ends = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                at, lo, hi, rolling = anchors(part, ends, length)
                asked = wanted.slice(a, b - a)
                n = np.asarray(asked.value_lengths())
                flat = asked.flatten()
                if not len(flat):
                    continue
                pos, salts = np.asarray(flat.field("pos")) + np.repeat(ends[:-1], n), np.asarray(flat.field("salts"))
                i = np.searchsorted(at, pos)
                row = _rows_of(ends, pos)
                at, lo, hi = at[i], lo[i], hi[i]
                key = np.asarray(flat.field("key"))
                content = mix(rolling(lo, hi + length) + (at - lo).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
                _, one, back, count = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
                again = count[back] > 1
                sent = np.zeros(len(at), bool)
                sent[one] = True
                raw = part.tobytes()
                body = [raw[x:y + length] if s else None for x, y, s in zip(lo, hi, sent)]
                salt = (content % salts.astype(np.uint64)).astype(np.int64)
                keep = again | sent
                group = mix(key.view(np.uint64) + np.where(sent, salt.astype(np.uint64), content + lo.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group.view(np.int64)), pa.array(key), batch.column(0).take(pa.array(a + row)),
                     pa.array(lo - ends[row]), pa.array(hi - ends[row]), pa.array((at - lo).astype(np.int32)), pa.array(salts > 1),
                     pa.array(again), pa.array(body, pa.binary())],
                    ["g", "key", "digest", "lo", "hi", "lead", "spread", "again", "body"]).filter(pa.array(keep))
    return run


def _compare(length: int):
    """Whole groups of phrases -> start ranges of repeated strings; for groups dealt over several tasks also one row for each
    distinct string, with its place if it is alone here."""
    def run(batches):
        for table in whole_groups(batches, "g", 4096):
            g, key, lo, hi, lead = (table[c].to_numpy() for c in ("g", "key", "lo", "hi", "lead"))
            digest, spread = column(table, "digest"), table["spread"].to_numpy(zero_copy_only=False)
            again = table["again"].to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(column(table, "body"))
            n = np.where(np.diff(offsets) > 0, hi - lo + 1, 0)
            owner = np.repeat(np.arange(len(n)), n)
            shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = offsets[:-1][owner] + shift
            mark = Rolling(data)(start, start + length)
            mark = mix(mark + key.view(np.uint64)[owner] * np.uint64(3) + (lead[owner] - shift).astype(np.uint64))
            order = np.lexsort((mark, g[owner]))
            same = (mark[order][1:] == mark[order][:-1]) & (g[owner][order][1:] == g[owner][order][:-1])
            twin = np.zeros(len(mark), bool)
            twin[order[1:]] |= same
            twin[order[:-1]] |= same
            edge = np.concatenate((np.ones(min(1, len(twin)), bool), (twin[1:] != twin[:-1]) | (owner[1:] != owner[:-1])))
            begin = np.flatnonzero(edge)
            finish = np.concatenate((begin[1:], [len(twin)])) - 1
            begin, finish = begin[twin[begin]], finish[twin[begin]]
            out = [(owner[begin], lo[owner[begin]] + shift[begin], lo[owner[finish]] + shift[finish], np.zeros(len(begin), np.int64), np.zeros(len(begin), bool))]
            lone = np.zeros(len(mark), bool)
            lone[order] = np.concatenate((np.ones(min(1, len(same) + 1, len(mark)), bool), ~same))
            lone &= spread[owner]
            at = np.flatnonzero(lone)
            place = np.where(twin[at], -1, lo[owner[at]] + shift[at])
            out.append((owner[at], place, place, mark[at].view(np.int64), np.ones(len(at), bool)))
            done = np.flatnonzero(again)
            out.append((done, lo[done], hi[done], np.zeros(len(done), np.int64), np.zeros(len(done), bool)))
            row, first, last, seen, shared = (np.concatenate([o[k] for o in out]) for k in range(5))
            yield pa.RecordBatch.from_arrays([digest.take(pa.array(row)), pa.array(first), pa.array(last), pa.array(seen), pa.array(shared)],
                                             ["digest", "first", "last", "mark", "shared"])
    return run


def _strip(length: int):
    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            found, copies = batch.column(2), np.asarray(batch.column(3))
            n = np.asarray(found.fill_null([]).value_lengths()) if found.null_count else np.asarray(found.value_lengths())
            flat = found.flatten()
            first, last = np.asarray(flat.field("first")), np.asarray(flat.field("last"))
            at, removed, spans, digest = 0, [], [], []
            for row in range(batch.num_rows):
                text = data[offsets[row]:offsets[row + 1]]
                depth = np.zeros(len(text) + 1, np.int64)
                if copies[row] > 1 and len(text) >= length:
                    depth[0] = 1
                np.add.at(depth, first[at:at + n[row]], 1)
                np.add.at(depth, last[at:at + n[row]] + length, -1)
                at += n[row]
                gone = np.cumsum(depth[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                digest.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())],
                                             ["digest", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes of every whole text that a string of `length` bytes covers which also starts anywhere else.

    Distinct texts are written once (a text with copies is a repeat as a whole, if long enough). Their anchors' common parts are
    counted; anchors whose part occurs twice go back to their text, which sends out the phrase around them. A group of phrases
    larger than `GROUP` is dealt over several tasks by content; strings that such a task has once are counted over all tasks.
    Equality is that of 64-bit fingerprints. Order is by fingerprint, not alphabetical: only equality decides here.

    Null text is empty; texts shorter than `length` keep all bytes; null ids and repeated rows are handled row by row; an empty table
    gives no rows; other columns are ignored. Returns id, n_bytes, n_removed, n_spans, kept_sha256."""
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    given = given.withColumn("digest", F.unhex(F.md5("text")))
    texts = bucketed(given.groupBy("digest").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")), "digest", "textos")
    places = texts.select("digest", "text").mapInArrow(_keys(length), "key long, digest binary, pos int")
    twice = materialize(places.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                        .select("key", F.ceil(F.col("n") / GROUP).cast("int").alias("salts")), "frases")
    asked = places.join(twice, "key").groupBy("digest").agg(F.collect_list(F.struct("pos", "key", "salts")).alias("asked"))
    phrases = texts.select("digest", "text").join(asked, "digest").select("digest", "text", "asked").mapInArrow(
        _phrases(length), "g long, key long, digest binary, lo long, hi long, lead int, spread boolean, again boolean, body binary")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = phrases.repartition(parts, "g").sortWithinPartitions("g")
    found = materialize(dealt.mapInArrow(_compare(length), "digest binary, first long, last long, mark long, shared boolean"), "achados")
    shared = found.where("shared").select("mark", "digest", "first")
    common = materialize(shared.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark"), "comuns")
    across = shared.where("first >= 0").join(common, "mark").select("digest", "first", F.col("first").alias("last"))
    repeated = (found.where("not shared").select("digest", "first", "last").unionAll(across))
    marked = repeated.groupBy("digest").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    none = F.from_json(F.lit("[]"), "array<struct<first:bigint,last:bigint>>")
    stripped = texts.join(marked, "digest", "left").select("digest", "text", F.coalesce("found", none).alias("found"), "copies").mapInArrow(
        _strip(length), "digest binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    stripped = materialize(stripped, "limpos")
    light = materialize(given.select("id", "digest"), "resumos")
    return light.join(stripped, "digest").select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")
