"""Secrets in texts: three base patterns, and strings that a character Markov model finds random (DataFrame functions only)."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaflow.session import materialize

# The base patterns, in the order in which kinds are listed.
_NAME = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = rf"""({_NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
ORDINARY = "[A-Za-z][A-Za-z0-9_-]{7,}"
#: Documents, in expectation, whose ordinary words train the second model; the fit is the only thing that is sampled.
SAMPLE_DOCS = 2_000
_CODES, _STRETCH = 128, 512
#: Generated random strings per alphabet that join the corpus' own as labelled samples, and their lengths.
GENERATED, SHORTEST, LONGEST = 400, 20, 64
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Alphabets in which keys and tokens are written.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "hex upper": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "base58": "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz",
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64 url": _UPPER + _LOWER + _DIGITS + "-_",
}
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"

# Common words of identifiers; generated identifiers are labelled samples of what is ordinary.
WORDS = (
    "access action add after alert amount any apply article audit average balance batch between body branch buffer business bytes "
    "call card change character child city clean cloud collect column comment common compare config content control count create "
    "customer data default delivery detail different display domain driver early element employee enable entity error every "
    "execute external failed field filter find folder format frame function generate graph handler header history house import "
    "index input interface invoice job jump keyboard language last layer left level light line load location login lookup main map "
    "master maximum memory message minimum model month move name next number offset order owner page partial payment percent phone "
    "pipeline plan point position previous primary product project provider purchase quantity queue random rating receive recovery "
    "region release remove request resource result revenue right root route sales schedule score script second select sequence "
    "service setting share simple small source special stage start status stock store string student submit supplier switch table "
    "task template text thread time total track transaction tree type unit upload valid variable version visit wait warning "
    "weather weight window work write zone").split()


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 1) -> Column:
    """Leftmost non-overlapping matches with their code point offsets: matches and the gaps between them add up to the
    text, so the running sum of both lengths is each match's place. The sum runs over stretches of `_STRETCH` matches, as
    appending to one long array would take time with the square of its length."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("v"))
    parts = parts.cast("array<struct<g:string,m:string,v:string>>")
    none = F.from_json(F.lit("[]"), _SPAN)

    def step(acc, x):
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["v"].alias("value"))
        found = F.when(F.length(x["v"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.when(x["m"].isNull(), acc).otherwise(F.struct(end.alias("at"), found.cast(_SPAN).alias("out")))

    def opened(at):
        return F.struct(at.alias("at"), none.alias("out"))

    def stretch(done, part):
        return F.concat(done, F.array(F.aggregate(part, opened(F.element_at(done, -1)["at"]), step)))

    stretches = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _STRETCH).cast("int")),
                            lambda k: F.slice(parts, k * _STRETCH + 1, F.lit(_STRETCH)))
    listed = F.aggregate(stretches, F.array(opened(F.lit(0))), stretch, lambda done: F.flatten(F.transform(done, lambda s: s["out"])))
    return F.when(text.rlike(pattern), listed).otherwise(none)


def generated_secrets(spark: SparkSession, each: int = GENERATED, seed: int = 0) -> DataFrame:
    """Labelled random strings, `each` of every alphabet: alphabet, value. A hash of seed, number and place picks each character."""
    known = F.array(*[F.struct(F.lit(k).alias("alphabet"), F.lit(v).alias("letters")) for k, v in ALPHABETS.items()])
    names = spark.range(1).select(F.inline(known))
    numbered = names.select("alphabet", "letters", F.explode(F.sequence(F.lit(1), F.lit(each))).alias("i"))
    length = SHORTEST + F.pmod(F.xxhash64(F.lit(seed), "alphabet", "i"), F.lit(LONGEST - SHORTEST + 1)).cast("int")

    def letter(at: Column) -> Column:
        return F.substr("letters", F.pmod(F.xxhash64(F.lit(seed), "alphabet", "i", at), F.length("letters")).cast("int") + 1, F.lit(1))

    return numbered.select("alphabet", F.array_join(F.transform(F.sequence(F.lit(1), length), letter), "").alias("value"))


def generated_identifiers(spark: SparkSession, each: int = 8 * GENERATED, seed: int = 0) -> DataFrame:
    """Labelled ordinary identifiers of 3 to 6 common words, `each` of every way to join them: form, value."""
    numbered = spark.range(1, each + 1, 1, 8)
    words = F.array(*map(F.lit, WORDS))

    def word(at: Column) -> Column:
        return F.get(words, F.pmod(F.xxhash64(F.lit(seed), F.lit("word"), "id", at), F.lit(len(WORDS))).cast("int"))

    last = 3 + F.pmod(F.xxhash64(F.lit(seed), F.lit("words"), "id"), F.lit(4)).cast("int")
    picked = numbered.select(F.transform(F.sequence(F.lit(1), last), word).alias("w"))
    capital = F.array_join(F.transform("w", lambda w: F.initcap(w)), "")
    forms = {"snake": F.array_join("w", "_"), "constant": F.upper(F.array_join("w", "_")), "kebab": F.array_join("w", "-"), "path": F.array_join("w", "/"),
             "pascal": capital, "camel": F.concat(F.get("w", F.lit(0)), F.substr(capital, F.length(F.get("w", F.lit(0))) + 1)), "joined": F.array_join("w", "")}
    return picked.select(F.explode(F.array(*[F.struct(F.lit(k).alias("form"), v.alias("value")) for k, v in forms.items()])).alias("f")).select("f.*")


def ordinary_forms(words: DataFrame) -> DataFrame:
    """Ordinary identifiers from rows (value): each word, and the forms in which programs and paths write two words, here twice
    the same: in upper case, joined by underscore, hyphen or slash, and in camel case."""
    w = F.col("value")
    upper, first = F.upper(w), F.initcap(w)
    return words.select(F.explode(F.array(
        w, upper, F.concat(w, F.lit("_"), w), F.concat(upper, F.lit("_"), upper), F.concat(w, F.lit("-"), w), F.concat(w, F.lit("/"), w),
        F.concat(w, first), F.concat(first, first))).alias("value"))


def train_randomness(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each character pair, random against ordinary, from rows (value, random).

    Both models are first-order with add-one smoothing over the characters seen; the table has 128 x 128 entries, whatever
    the sample. Without samples of a class that class is uniform. Characters beyond ASCII are skipped."""
    pairs = (samples.where("value is not null").distinct()
             .select("random", "value", F.explode(F.sequence(F.lit(1), F.greatest(F.length("value") - 1, F.lit(1)))).alias("i"))
             .select("random", F.ascii(F.substr("value", F.col("i"), F.lit(1))).alias("a"),
                     F.ascii(F.substr("value", F.col("i") + 1, F.lit(1))).alias("b"))
             .where(f"a between 1 and {_CODES - 1} and b between 1 and {_CODES - 1}"))
    counts = pairs.groupBy("a", "b").agg(F.sum(F.when(F.col("random"), 1).otherwise(0)).alias("r"),
                                         F.sum(F.when(F.col("random"), 0).otherwise(1)).alias("o")).collect()
    seen = max(2, len({c for row in counts for c in (row["a"], row["b"])}))
    total = {k: [0] * _CODES for k in "ro"}
    table = {k: [0] * (_CODES * _CODES) for k in "ro"}
    for row in counts:
        for k in "ro":
            total[k][row["a"]] += row[k]
            table[k][row["a"] * _CODES + row["b"]] += row[k]
    return [math.log((table["r"][i] + 1) / (total["r"][i // _CODES] + seen)) - math.log((table["o"][i] + 1) / (total["o"][i // _CODES] + seen))
            for i in range(_CODES * _CODES)]


def randomness(value: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio per character pair of an ASCII string."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")

    def step(acc, i):
        a, b = (F.ascii(F.substr(value, i + j, F.lit(1))) for j in (0, 1))
        return acc + F.coalesce(F.get(table, F.least(a, F.lit(_CODES - 1)) * _CODES + F.least(b, F.lit(_CODES - 1))), F.lit(0.0))

    pairs = F.greatest(F.length(value) - 1, F.lit(1))
    return F.aggregate(F.sequence(F.lit(1), pairs), F.lit(0.0), step) / pairs


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Base secrets of every whole text, and further runs of 20 characters or more that look random.

    One pass over the texts, without a shuffle, lists base spans (kinds assign, access, hex), candidate runs outside them and,
    for a hash-chosen sample of about `sample_docs` documents, ordinary words outside any run that could be a candidate. Two
    character Markov models are trained: one from the values of base spans and from generated strings of every alphabet in
    `ALPHABETS` (random), one from the ordinary words, their forms and generated identifiers. A candidate becomes a span of
    kind `random` if its mean log-likelihood ratio is above 0, above that of 99.9 % of the ordinary samples that are as long as
    a candidate must be, and above the middle between that and the value which 99 % of the generated random strings exceed.
    Base spans always stay.

    Null text counts as empty; empty texts have no spans; rows with null or repeated ids stay as they are; other columns are
    ignored. Returns id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    total = max(1, docs.count())
    share = min(1_000_000, math.ceil(1_000_000 * sample_docs / total))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    base = rows.select("id", "text", F.array_sort(F.concat(
        _spans(F.col("text"), ASSIGN, 0, 2, 6), _spans(F.col("text"), ACCESS, 1), _spans(F.col("text"), HEX, 2))).alias("base"))
    sampled = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) < share
    scanned = base.select(
        "id", "base", _spans(F.col("text"), CANDIDATE, 3).alias("candidates"),
        F.when(sampled, F.array_distinct(F.regexp_extract_all(F.regexp_replace("text", CANDIDATE, " "), F.lit(ORDINARY), F.lit(0)))).alias("words"))
    scanned = materialize(scanned, "segredos")
    # access and hex spans lie within one candidate, whose own text shows them; only the others are compared by place
    assigned = F.filter("base", lambda b: b["kind"] == 0)
    free = F.filter("candidates", lambda c: ~c["value"].rlike(f"{ACCESS}|{HEX}") & ~F.exists(
        assigned, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    ordinary = scanned.select(F.explode("words").alias("value")).where(~F.col("value").rlike("^" + HEX + "$"))
    secret = scanned.select(F.explode("base.value").alias("value")).unionAll(generated_secrets(docs.sparkSession).select("value"))
    forms = materialize(ordinary_forms(ordinary.distinct()).unionAll(
        generated_identifiers(docs.sparkSession).select("value")).distinct(), "formas")
    ratios = train_randomness(secret.select("value", F.lit(True).alias("random")).unionAll(
        forms.select("value", F.lit(False).alias("random"))))
    long = forms.where(F.length("value") >= SHORTEST).select("value", F.lit(False).alias("random")).unionAll(
        generated_secrets(docs.sparkSession).select("value", F.lit(True).alias("random")))
    score = randomness(F.col("value"), ratios)
    edges = long.agg(F.percentile_approx(F.when(~F.col("random"), score), 0.999, 10_000).alias("ordinary"),
                     F.percentile_approx(F.when(F.col("random"), score), 0.01, 10_000).alias("random")).first()
    floor = max(0.0, edges["ordinary"], (edges["ordinary"] + edges["random"]) / 2)
    scored = scanned.select("id", "base", F.filter(free, lambda c: randomness(c["value"], ratios) > floor).alias("added"))
    kinds = F.array(*map(F.lit, ["assign", "access", "hex", "random"]))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def many(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return scored.select(
        F.col("id").alias(id_col), many(0).alias("n_assign"), many(1).alias("n_access"), many(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_random"))
