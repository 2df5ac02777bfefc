"""Personal data: base patterns, high-recall candidates, boosted trees on format and context, calibrated thresholds."""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaflow.operators.ordering import running_totals
from vendaflow.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Different candidates that one task of the fit holds, on average; all take part, each with its number of occurrences as weight.
FIT_ROWS = 20_000
#: Most bins of a feature. Up to its square of different candidates, splits are proposed from all of them.
MAX_BINS = 1_024
PRECISION = 0.995
#: Lowest score that any kind's threshold may have, whatever precision held-out examples show below it.
FLOOR = 0.9
#: Classes of examples: a base span, the same in a form that the base pattern does not know, a span that is no personal data.
BASE, FORM, WRONG = 0, 1, 2

# The base patterns. A digit run's inner starts cannot succeed where its first failed, hence the look-behind.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_AT = re.compile(r"(?<![\w.+%-])[\w.+%-]{1,64} ?(?:@|\(at\)|\[at\]) ?[\w-]{1,64}(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[\w-]{1,64}){1,6}")
_DOTTED = re.compile(r"(?<![0-9.])[0-9]{1,12}(?:(?:\.|\[\.\]| ?\(dot\) ?| ?\[dot\] ?)[0-9]{1,12}){2,7}")
_NUMBER = re.compile(r"(?<![0-9])(?:\+|\(\+?)?[0-9](?:[ ().\-/]{0,2}[0-9]){6,24}")
_DATE = re.compile(r"(?:19|20)[0-9]{2}([-/.])[01]?[0-9]\1[0-3]?[0-9](?![0-9])")
#: Decimal numbers and amounts with separators of thousands.
_AMOUNT = re.compile(r"[0-9]+[.][0-9]+|[0-9]{1,3}(?:[. ][0-9]{3}){2,}")
_HINTS = (("mail", "contact", "correo"), ("ip", "host", "server", "addr"), ("card", "visa", "iban", "pay"),
          ("call", "phone", "tel", "fax", "mobil"))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping per kind, failing matches dropped; sorted.

    An address is found from its sign outwards, in time linear in the text."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append((start, 0, found.end()))
            floor = found.end()
        at = text.find("@", max(at + 1, floor))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of everything that may be personal data; spans overlap, and numbers count as card and as phone."""
    found = set(base_spans(text))
    if "@" in text or "at)" in text or "at]" in text:
        found.update((m.start(), 0, m.end()) for m in _AT.finditer(text))
    if _DIGIT.search(text):
        found.update((m.start(), 1, m.end()) for m in _DOTTED.finditer(text))
        for m in _NUMBER.finditer(text):
            found.add((m.start(), 2, m.end()))
            found.add((m.start(), 3, m.end()))
    return sorted(found)


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def fits(span: str, kind: int) -> bool:
    """Whether the value passes its kind's own check, whatever its form."""
    digits = _digits(span)
    if kind == 0:
        return bool(re.search(r"[A-Za-z]{2,}\Z", span))
    if kind == 1:
        groups = [g.lstrip("0") for g in re.findall(r"[0-9]+", span)]
        return len(groups) == 4 and all(len(g) <= 3 and int(g or 0) <= 255 for g in groups)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 10 <= len(digits) <= 15


def describe(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a span."""
    span, before, after = text[start:end], text[max(0, start - 24):start].lower(), text[end:end + 1]
    digits, groups = _digits(span), re.findall(r"[0-9]+", span)
    left = before[-1:]
    return [float(x) for x in (
        kind, len(span), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        span.count("."), span.count("-"), span.count(" "), span.count("("), span.count("/"), "@" in span, span[:1] == "+",
        luhn(digits) if digits else 0, all(len(g) <= 3 and int(g) <= 255 for g in groups) if groups else 0,
        sum(c.isalpha() for c in span) / max(1, len(span)), left.isalnum(), left.isspace() or not left, after.isalnum(),
        after in "%€$£" and bool(after), fits(span, kind), span == digits, bool(_DATE.match(span)), bool(_AMOUNT.fullmatch(span)), *(any(h in before for h in hints) for hints in _HINTS))]


def other_forms(span: str, kind: int) -> tuple[list[str], list[str]]:
    """A base span written in other forms, and the same forms with values that fail the kind's check."""
    if kind == 0:
        name, host = span.split("@")
        forms = [f"{name}(at){host}", f"{name} [at] {host}", f"{name} @ {host}", f"{name}(at){host.replace('.', '(dot)')}",
                 f"{name} (at) {host.replace('.', ' (dot) ')}"]
        wrong = [re.sub(r"[A-Za-z-]+\Z", "7", f) for f in forms]
    elif kind == 1:
        dots = ["[.]", "(dot)", " [dot] "]
        forms = [span.replace(".", d) for d in dots]
        wrong = [d.join([*span.split(".")[:3], "999"]) for d in dots] + [d.join(span.split(".")[:3]) for d in dots] + [d.join([*span.split("."), "1"]) for d in dots]
    elif kind == 2:
        digits = _digits(span)
        failing = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        forms, wrong = ([sep.join(d[i:i + 4] for i in range(0, len(d), 4)) for sep in (".", "/", "  ", " - ")] for d in (digits, failing))
    else:
        groups, digits = re.findall(r"[0-9]+", span), _digits(span)
        forms = [span[1:], ".".join(groups), "-".join(groups), " ".join(groups), "/".join(groups), "00" + " ".join(groups), "".join(groups)]
        # the same digits in the usual groups of three, three and the rest
        forms += [sep.join((digits[:3], digits[3:6], digits[6:])) for sep in ".-"]
        wrong = []
        for f in forms:
            ends = [i + 1 for i, c in enumerate(f) if "0" <= c <= "9"]
            wrong += [f[:ends[7]], f + " " + f[-8:]]
        wrong += [f"20{digits[-2:]}{sep}0{int(digits[-3]) % 9 + 1}{sep}1{digits[-4]} 1030" for sep in "-/."] * 2
    return forms, wrong


def plain_number(seed: int) -> str:
    """A number that is nobody's, in its usual place, by turns a run of digits of any length from seven to 19, a time in seconds or in
    milliseconds, a decimal, an amount with thousands, an order, a version or a span of years. It follows from `seed`."""
    digits = str((seed * 0x9E3779B97F4A7C15 + 1) % 10**20).rjust(20, "7")
    sort, place = seed % 10, ("sum {} ok", "id={}", "order #{},", "at {} UTC", "{}", "row {};", "({})", "total: {}.", "[{}]", "no {} of")[seed // 10 % 10]
    if sort < 4:
        return place.format(digits[:7 + seed // 100 % 13])
    return place.format(("1" + digits[:9], f"1{digits[:12]}", f"{digits[:8]}.{digits[8:11]}", f"{int(digits[0]) + 1}.{digits[1:4]}.{digits[4:7]}.{digits[7:10]}",
                         f"1.{digits[:2]}.{digits[2:6]}", f"19{digits[:2]}-20{digits[2:4]} {digits[4:6]}")[sort - 4])


def verdict(text: str, start: int, kind: int, end: int) -> bool | None:
    """For a candidate that no base pattern finds: False if its own check fails or its form and place contradict it, else None."""
    span = text[start:end]
    if (start and text[start - 1].isalnum()) or text[end:end + 1].isalnum() or not fits(span, kind):
        return False
    if kind < 2:
        return None
    if text[end:end + 1] in tuple("%€$£") or _DATE.match(span) or _AMOUNT.fullmatch(span):
        return False
    # a bare run of digits is a number of any sort unless the words before it say otherwise
    before = text[max(0, start - 24):start].lower()
    return False if kind == 3 and span.isdecimal() and not any(h in before for h in _HINTS[3]) else None


def examples(text: str) -> list[tuple[int, int, list[float]]]:
    """(kind, class, features) to learn from: base spans, their other forms in the same place, candidates that are wrong, of the text and
    of plain numbers.

    Candidates of which neither is known, and those that overlap a base span and thus are never asked for, teach nothing."""
    base = base_spans(text)
    taken = Taken(base)
    out = [(kind, BASE, describe(text, start, kind, end)) for start, kind, end in base]
    out += [(kind, WRONG, describe(text, start, kind, end)) for start, kind, end in candidates(text)
            if taken.free(start, end) and verdict(text, start, kind, end) is False]
    for start, kind, end in base:
        left, right = text[max(0, start - 64):start], text[end:end + 64]
        for forms, label in zip(other_forms(text[start:end], kind), (FORM, WRONG)):
            # one of each, so that every base span weighs alike
            span = forms[zlib.crc32(f"{start} {text[start:end]}".encode("utf-8", "surrogatepass")) % len(forms)]
            made, at = left + span + right, (len(left), kind, len(left) + len(span))
            if at in candidates(made) and Taken(base_spans(made)).free(at[0], at[2]) and verdict(made, *at) is (None if label == FORM else False):
                out.append((kind, label, describe(made, *at)))
        # and a plain number, where the words before say nothing
        made = plain_number(zlib.crc32(text[start:end].encode("utf-8", "surrogatepass")))
        there = Taken(base_spans(made))
        out += [(other, WRONG, describe(made, s, other, e)) for s, other, e in candidates(made) if there.free(s, e) and verdict(made, s, other, e) is False]
    return out


class Taken:
    """Ranges of a text that spans cover, kept apart and in order, so that a new span is tested in logarithmic time."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for start, _, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start: int, end: int) -> bool:
        return bisect_left(self.starts, end) == bisect_right(self.ends, start)

    def add(self, start: int, end: int) -> None:
        """A span that is free."""
        at = bisect_left(self.starts, end)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


@dataclass(frozen=True)
class PiiModel:
    """Boosted trees as nested (feature, threshold, left, right) or leaf values, their weights, and a threshold per kind."""
    trees: tuple
    weights: tuple
    thresholds: tuple

    @property
    def silent(self) -> tuple[str, ...]:
        """Kinds to which nothing is added beside base spans: no threshold held on the examples kept aside, or there is no model."""
        return tuple(k for i, k in enumerate(KINDS) if not self.trees or self.thresholds[i] > 1)

    def score(self, x: list[float]) -> float:
        margin = 0.0
        for tree, weight in zip(self.trees, self.weights):
            while isinstance(tree, tuple):
                feature, threshold, left, right = tree
                tree = left if x[feature] <= threshold else right
            margin += weight * tree
        return float(1 / (1 + np.exp(-2 * margin)))

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans, and base spans with the further ones that the trees select, best first, without overlap."""
        base = base_spans(text)
        if not self.trees:
            return base, base
        scored, taken = [], Taken(base)
        for start, kind, end in candidates(text):
            if taken.free(start, end):
                score = self.score(describe(text, start, kind, end))
                if score >= self.thresholds[kind]:
                    scored.append((-score, start, kind, end))
        chosen = list(base)
        for _, start, kind, end in sorted(scored):
            if taken.free(start, end):
                taken.add(start, end)
                chosen.append((start, kind, end))
        return base, sorted(chosen)


NO_MODEL = PiiModel((), (), ())


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return split.featureIndex(), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def _propose(batches):
    for batch in batches:
        rows = [e for text in batch.column(0).to_pylist() for e in examples(text)]
        kind, label, x = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(label, pa.int32()), pa.array(x, pa.list_(pa.float64()))],
                                         ["kind", "class", "x"])


def _texts(docs: DataFrame, text_col: str):
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text")


def _scored(model: PiiModel):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.score(x) for x in batch.column(1).to_pylist()], pa.float64()), *batch.columns[2:]],
                                             ["kind", "score", "label", "n"])
    return run


def fit_pii(docs: DataFrame, text_col: str = "text", fit_rows: int = FIT_ROWS, precision: float = PRECISION,
            floor: float = FLOOR) -> PiiModel:
    """Boosted trees that tell personal data in any form from other candidates, by format and context.

    Right are the base spans and, in the same places, their other forms: `(at)`, no plus, other separators. Wrong are
    candidates that fail their kind's own check or contradict it: found ones, such forms with a failing value, and plain numbers (runs of
    digits of every length, times, decimals, amounts, orders, versions). What is neither (a number that may be a phone's) is not
    learned from. Thresholds are set on forms and wrong candidates alone, as base spans need no score.

    Candidates of all texts are listed and equal ones counted; each different one takes part, with its number of occurrences as
    weight, and none is sampled. They are dealt over tasks of about `fit_rows`. Trees learn on those that a hash puts into four fifths; on
    the rest a kind's threshold is the lowest score (midway to the next lower one) from which on `precision` of
    the candidates, by weight, are right, though not below `floor`; nothing is added for a kind that never reaches it, which
    `PiiModel.silent` names. With fewer than ten different candidates of a class there is no model and only base spans are
    found."""
    found = docs.select(_texts(docs, text_col)).mapInArrow(_propose, "kind int, class int, x array<double>")
    strata = ["kind", "class"]
    shapes = materialize(found.groupBy(*strata, "x").agg(F.count(F.lit(1)).alias("n")).withColumn("h", F.xxhash64(*strata, "x")), "candidatos")
    good = F.col("class") != WRONG
    seen = {r["good"]: r["n"] for r in shapes.groupBy(good.alias("good")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(seen.get(True, 0), seen.get(False, 0)) < 10:
        return NO_MODEL
    many = sum(seen.values())
    held = F.pmod("h", F.lit(5)) == 2
    rows = shapes.where(~held).select("h", "x", good.cast("double").alias("label"), array_to_vector("x").alias("features"), F.col("n").cast("double").alias("weight"))
    # Spark proposes splits from all rows where they are no more than the square of the bins
    bins = min(MAX_BINS, max(32, math.isqrt(many) + 1))
    fitted = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, maxBins=bins, seed=7, labelCol="label", weightCol="weight").fit(
        rows.repartition(-(-many // max(1, fit_rows)), "h").sortWithinPartitions("h", "x"))
    model = PiiModel(tuple(_tree(t._java_obj.rootNode()) for t in fitted.trees), tuple(fitted.treeWeights), ())
    kept = shapes.where(held & (F.col("class") != BASE)).select("kind", "x", good.cast("long").alias("label"), "n")
    scores = materialize(kept.mapInArrow(_scored(model), "kind int, score double, label long, n long"), "notas")
    curve = materialize(running_totals(scores, ["kind"], "score", {"right": F.col("label") * F.col("n"), "all": F.col("n")}, descending=True), "curva")
    cuts = curve.where(F.col("right_ate") >= precision * F.col("all_ate")).groupBy("kind").agg(F.min("score").alias("cut"))
    lower = curve.join(cuts, "kind").groupBy("kind", "cut").agg(F.max(F.when(F.col("score") < F.col("cut"), F.col("score"))).alias("next"))
    chosen = {r["kind"]: max(r["cut"] if r["next"] is None else (r["cut"] + r["next"]) / 2, floor) for r in lower.collect()}
    return PiiModel(model.trees, model.weights, tuple(chosen.get(kind, 2.0) for kind in range(len(KINDS))))


def find_pii(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every whole text, in one pass without a shuffle; base spans always stay.

    Null text counts as empty and has no spans; null ids and repeated rows stay row by row; other columns are ignored. Returns
    id and all spans as an array of (kind, start, end, base), offsets in code points, end exclusive, by start, then kind."""
    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, spans = model.spans(text)
                kept = set(base)
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "base": (s, k, e) in kept} for s, k, e in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], [id_col, "spans"])

    given = docs.select(F.col(id_col), _texts(docs, text_col))
    kind = given.schema[0].dataType.simpleString()
    return given.mapInArrow(run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def redact(docs: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every span replaced by its kind in brackets; null text stays null."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                if text:
                    parts, done = [], 0
                    for s, k, e in model.spans(text)[1]:
                        if s >= done:
                            parts += [text[done:s], f"[{KINDS[k].upper()}]"]
                        done = max(done, e)
                    text = "".join([*parts, text[done:]])
                out.append(text)
            columns = [pa.array(out, batch.schema.types[at]) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
