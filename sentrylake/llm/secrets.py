"""Secret scans: fixed patterns, and tokens that a Markov model of random strings explains better than one of identifiers.

Everything runs in DataFrame functions. Both models are first-order over characters. Random strings are labelled by a
rule: the values that the fixed patterns find in the table, and digests written in several alphabets. Ordinary
identifiers are all other long words of the table. Each distinct string counts once, so copies carry no weight.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns that define the base spans, with the group and length that a match must have.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
_ORDINARY = r"[A-Za-z0-9_-]{8,}"
_BLOCK = 512


def running_sums(lengths: Column) -> Column:
    """Sum of all elements before each one, in blocks, so that the cost stays linear for long arrays."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))

    def before(values: Column, start: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        return F.aggregate(
            values, F.struct(start.cast("bigint").alias("sum"), empty.alias("all")),
            lambda acc, v: F.struct((acc["sum"] + v).alias("sum"), F.concat(acc["all"], F.array(acc["sum"])).alias("all")),
            lambda acc: acc["all"])

    totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0).cast("bigint"), lambda acc, v: acc + v))
    return F.flatten(F.zip_with(blocks, before(totals, F.lit(0)), before))


def _with_matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds ``name``: all leftmost non-overlapping matches as structs of start, end and text."""
    df = df.withColumn(f"{name}_found", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    df = df.withColumn(f"{name}_between", F.when(F.size(f"{name}_found") > 0, F.split("text", pattern, -1)))
    gaps = F.transform(F.slice(f"{name}_between", 1, F.size(f"{name}_found")), lambda x: F.length(x).cast("bigint"))
    df = df.withColumn(f"{name}_gaps", gaps)
    steps = F.zip_with(f"{name}_gaps", f"{name}_found", lambda gap, match: gap + F.length(match))
    df = df.withColumn(f"{name}_steps", steps)
    df = df.withColumn(f"{name}_starts", F.zip_with(running_sums(F.col(f"{name}_steps")), f"{name}_gaps",
                                                    lambda before, gap: before + gap))
    spans = F.zip_with(f"{name}_starts", f"{name}_found", lambda start, match: F.struct(
        start.alias("start"), (start + F.length(match)).alias("end"), match.alias("match")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    df = df.withColumn(name, F.when(F.size(f"{name}_found") > 0, spans).otherwise(none))
    return df.drop(*[f"{name}_{x}" for x in ("found", "between", "gaps", "steps", "starts")])


def _kind(column: str, order: int, kind: str) -> Column:
    return F.transform(column, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(order).alias("order"), F.lit(kind).alias("kind")))


def _value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 2)


def base_spans(texts: DataFrame) -> DataFrame:
    """Adds the spans ``assign``, ``access`` and ``hex`` of the column ``text``."""
    texts = _with_matches(texts, "assign", ASSIGN)
    texts = texts.withColumn("assign", F.filter("assign", lambda s: F.length(_value(s["match"])) >= 8))
    return _with_matches(_with_matches(texts, "access", ACCESS), "hex", HEX)


def _pairs(strings: DataFrame) -> DataFrame:
    """Counts of neighbouring characters over distinct ``value``; characters outside the alphabet break a pair."""
    places = F.sequence(F.lit(1), F.greatest(F.length("value") - 1, F.lit(1)))
    pair = strings.distinct().select(F.explode(F.transform(places, lambda i: F.col("value").substr(i, F.lit(2)))).alias("pair"))
    return pair.groupBy("pair").agg(F.count("*").alias("n"))


def random_samples(spark, n: int) -> DataFrame:
    """``n`` labelled random strings for each of five alphabets, made from digests of running numbers."""
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    coded = F.base64(F.unhex(digest))
    letters = F.regexp_replace(coded, "[+/=]", "")
    forms = [digest, F.upper(letters), letters, coded, F.translate(coded, "+/=", "-_")]
    return spark.range(n).select(F.explode(F.array(*forms)).alias("value"))


def train(docs: DataFrame, text_column: str = "text", samples: int = 4000, smoothing: float = 0.5) -> dict[str, float]:
    """Log-likelihood ratio (random over ordinary) of each pair of characters; at most ``len(ALPHABET) ** 2`` entries.

    All texts are read; null texts count as empty, repeated rows each for itself, and without any text the strings made by
    rule remain. ``samples`` bounds only those. Pairs never seen get the smoothed rate.
    """
    texts = docs.select(F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    # The three patterns that label a value as random, without their places in the text.
    assigned = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    found = F.flatten(F.array(F.filter(assigned, lambda v: F.length(v) >= 8),
                              F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
                              F.regexp_extract_all("text", F.lit(HEX), F.lit(0))))
    random = texts.select(F.explode(found).alias("value")).unionByName(random_samples(docs.sparkSession, samples))
    # What a text assigns as a secret is no ordinary string, wherever else in the text it stands.
    secret = F.filter(assigned, lambda v: F.length(v) >= 8)
    ordinary = texts.select(F.explode(F.array_except(F.regexp_extract_all("text", F.lit(_ORDINARY), F.lit(0)), secret))
                            .alias("value")).where(~F.col("value").rlike(f"{HEX}|{ACCESS}"))
    counts = _pairs(random).select("pair", F.lit("random").alias("label"), "n").unionByName(
        _pairs(ordinary).select("pair", F.lit("ordinary").alias("label"), "n"))
    counts = counts.where(F.col("pair").rlike(f"^[{ALPHABET}]{{2}}$".replace("_-", r"_\-")))
    seen = {(r.label, r.pair): r.n for r in counts.collect()}  # at most two alphabets squared
    rate = {}
    for label in ("random", "ordinary"):
        for a in ALPHABET:
            total = sum(seen.get((label, a + b), 0) for b in ALPHABET)
            for b in ALPHABET:
                rate[label, a + b] = math.log(
                    (seen.get((label, a + b), 0) + smoothing) / (total + smoothing * len(ALPHABET)))
    return {a + b: rate["random", a + b] - rate["ordinary", a + b] for a in ALPHABET for b in ALPHABET}


def log_ratio(value: Column, model: dict[str, float]) -> Column:
    """Sum of the model's ratios over all neighbouring characters of ``value``, which holds alphabet characters only."""
    size = len(ALPHABET)
    codes = [-1] * 128
    for i, c in enumerate(ALPHABET):
        codes[ord(c)] = i
    weights = [round(model[a + b], 6) for a in ALPHABET for b in ALPHABET]
    code = F.from_json(F.lit(json.dumps(codes)), "array<int>")
    weight = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    chars = F.transform(F.split(value, ""), lambda c: F.get(code, F.ascii(c)))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(chars, start, lambda acc, c: F.struct(
        c.alias("last"),
        F.when(acc["last"] < 0, acc["sum"]).otherwise(acc["sum"] + F.get(weight, acc["last"] * size + c)).alias("sum")),
        lambda acc: acc["sum"])


def scan(docs: DataFrame, text_column: str = "text", model: dict[str, float] | None = None, min_length: int = 12,
         prior: float = 1e-4, out: str = "secrets") -> DataFrame:
    """Adds the struct column ``out`` (replaced if it exists) with all secrets of each text.

    Fields: ``base`` and ``spans``, arrays of (start, end, order, kind) by start, then kind as listed (assign, access,
    hex, markov). Places are code points, ends exclusive. A ``markov`` span is a run of at least ``min_length``
    alphabet characters, holding both letters and digits and touching no base span, for which random is likelier than
    ordinary although only ``prior`` of all runs are secrets. A null text counts as empty; an empty table gives an empty
    result. Repeated rows are scanned like any other. All other columns pass through.
    """
    model = train(docs, text_column) if model is None else model
    texts = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    texts = _with_matches(base_spans(texts), "run", rf"[A-Za-z0-9+/=_\-]{{{min_length},}}")
    base = F.array_sort(F.concat(_kind("assign", 0, "assign"), _kind("access", 1, "access"), _kind("hex", 2, "hex")),
                        lambda a, b: F.when((a["start"] == b["start"]) & (a["order"] == b["order"]), 0).when(
                            (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["order"] < b["order"])), -1)
                        .otherwise(1))
    texts = texts.withColumn("base", base)
    threshold = math.log((1 - prior) / prior)
    mixed = F.filter("run", lambda s: s["match"].rlike("[0-9]") & s["match"].rlike("[A-Za-z]"))
    texts = texts.withColumn("run", mixed)
    free = F.filter("run", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    texts = texts.withColumn("run", F.when(F.size("run") > 0, free).otherwise(F.col("run")))
    likely = F.filter("run", lambda s: log_ratio(s["match"], model) > threshold)
    texts = texts.withColumn("run", F.when(F.size("run") > 0, likely).otherwise(F.col("run")))
    spans = F.array_sort(F.concat("base", _kind("run", 3, "markov")))
    secrets = F.struct(F.col("base"), F.when(F.size("run") > 0, spans).otherwise(F.col("base")).alias("spans"))
    kept = [c for c in docs.columns if c != out]
    return texts.withColumn("found", secrets).select(*[F.col("row")[c].alias(c) for c in kept], F.col("found").alias(out))


def spans_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each maximal run of overlapping spans replaced by ``mark``; ``spans`` are sorted by start."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("text"))
    piece = lambda acc, s: text.substr(acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
    return F.aggregate(
        spans, start, lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when((s["start"] < acc["at"]) & (acc["at"] > 0), acc["text"])
            .otherwise(F.concat(acc["text"], piece(acc, s), F.lit(mark))).alias("text")),
        lambda acc: F.concat(acc["text"], text.substr(acc["at"].cast("int") + 1, F.length(text))))
