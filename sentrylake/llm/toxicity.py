"""Toxicity by a weighted pattern grammar over clauses.

Insults are stems: whole words or beginnings of words, with the log-odds of a document that holds them. They are learned
from one half of the labelled rows, on top of a short fixed list. The grammar (``grammar.py``) reads each clause, and
decides whether an insult or threat stands alone, hits a person, is negated or only reported. The weights of the
matched kinds are fitted on the other half. A text is scored from its matched clauses alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.common import cut, fold, raw_texts
from sentrylake.llm.grammar import CLASSES, END, INSULT, KINDS, NEGATION, REPORT, SCOPE, TARGET, THREAT, WORD, compose, kind_of

# Small word lists of the grammar, by class.
LISTS = {
    INSULT: "idiot idiots moron morons stupid loser losers scum pathetic worthless disgusting trash clown clowns imbecile "
            "retard bastard asshole dumbass vermin dummkopf idioten arschloch abschaum connard imbécile abruti gilipollas "
            "imbécil basura escoria",
    THREAT: "kill murder hurt strangle töten umbringen tuer matar",
    TARGET: "you your yours yourself u he she they him her them everyone du dich dir ihr euch tu te toi vous tú ti usted "
            "ustedes vosotros",
    NEGATION: "not no never nobody none isn't aren't wasn't don't doesn't nicht kein keine nie niemand pas jamais aucun "
              "nunca nadie",
    REPORT: "said says say told tells called calls wrote writes claimed claims quoted according sagte sagt schrieb nannte "
            "dit disait écrit dijo dice escribió llamó",
}
FIXED_WEIGHT = 4.0
SHORTEST, LONGEST = 3, 8
_EDGES = re.compile(r"^[^\w]+|[^\w]+$")
_TABLE, _STATES = compose()
#: Per state and class: next state, and the kind of match or -1.
_NEXT = [[row[c][0] for c in CLASSES] for row in _TABLE]
_KIND = [[-1 if (k := kind_of(row[c][1])) is None else k for c in CLASSES] for row in _TABLE]
_CLASS = {c: i for i, c in enumerate(CLASSES)}
N_FEATURES = len(KINDS) + 3


@dataclass
class Model:
    """``stems``: insult stem -> weight; a key that ends in a blank is a whole word. ``weights``: bias first."""

    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (-1.5, 1.0, 1.2, 0.2, 0.3, 1.0, 1.2, 0.2, 0.3, 0.0, 0.0, 0.0)


def lexicon_class(token: bytes, model: Model, words: dict[str, str]) -> tuple[int, float, bool] | None:
    """Class, weight and whether a clause ends after the token; None for a plain word inside a clause."""
    text = token.decode("utf-8", "replace")
    ends = text[-1] in ".!?;:"
    word = _EDGES.sub("", text.lower())
    if not word:
        return (_CLASS[WORD], 0.0, True) if ends else None
    found = words.get(word, WORD)
    weight = FIXED_WEIGHT if found in (INSULT, THREAT) else 0.0
    if found in (WORD, INSULT):
        keys = [word + " ", *[word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1)]]
        learned = max((model.stems[k] for k in keys if k in model.stems), default=0.0)
        if learned > weight:
            found, weight = INSULT, learned
    if found == WORD and not ends:
        return None
    return _CLASS[found], weight, ends


class Reader:
    """Reads whole texts. What a token means is remembered for up to 250,000 tokens at a time."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.words = {word: kind for kind, words in LISTS.items() for word in words.split()}

    def _meaning(self, token: bytes) -> tuple[int, float, bool] | None:
        if len(self.known) > 250_000:
            self.known.clear()
        self.known[token] = found = lexicon_class(token, self.model, self.words)
        return found

    def features(self, raw: bytes | None) -> list[float]:
        """Sum of the weights by kind of match, then the largest clause, the number of clauses hit, and the log of hits.

        A token that comes again with the same kind of match counts once: junk that repeats a word says no more.
        """
        out, known = [0.0] * N_FEATURES, self.known
        state, last, clause, largest, clauses, hits = 0, -1, 0.0, 0.0, 0, 0
        counted: set[tuple[bytes, int]] = set()
        word, end, insult, threat = (_CLASS[c] for c in (WORD, END, INSULT, THREAT))
        for at, token in enumerate(raw.replace(b"\n", b" ; ").split() if raw else ()):
            meaning = known[token] if token in known else self._meaning(token)
            if meaning is None:
                continue
            kind, weight, ends = meaning
            for _ in range(min(at - last - 1, SCOPE + 1)):  # the plain words between; more change nothing
                state = _NEXT[state][word]
            last = at
            match = _KIND[state][kind]
            state = _NEXT[state][kind]
            if match >= 0 and (token, match) not in counted:
                counted.add((token, match))
                out[match] += weight if kind in (insult, threat) else FIXED_WEIGHT
                if kind in (insult, threat):
                    hits += 1
                    clause += weight
            if ends:
                largest, clauses, clause = max(largest, clause), clauses + (clause > 0), 0.0
                state = _NEXT[state][end]
        largest, clauses = max(largest, clause), clauses + (clause > 0)
        out[len(KINDS):] = [largest, float(clauses), math.log1p(hits)]
        return out


def _squeezed(features: np.ndarray) -> np.ndarray:
    """Sums grow with the text; their logarithms don't run away."""
    return np.log1p(features)


def probability(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = weights[0] + _squeezed(features) @ weights[1:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(features: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 0.5, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; a constant column comes first. More insults never lower a score."""
    x = np.hstack([np.ones((len(features), 1)), _squeezed(features)])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    free = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (p - label)) + penalty * w
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
            step = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
            w[free] -= step
            if np.abs(step).max() < 1e-8:
                break
        wrong = free & (w < 0)
        wrong[0] = False
        if not wrong.any():
            return w
        free &= ~wrong


def labelled(docs: DataFrame, labels: DataFrame, usable: Column, positives: int, negatives: int, id_column: str = "doc_id",
             text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """At most ``positives`` + ``negatives`` labelled texts for which ``usable`` holds, by the smallest hash of their id.

    Columns: text, label, weight (rows of the class for each row taken), half. An id that is labelled twice counts as
    toxic if one label says so; of texts with the same id one is taken, that with the smallest hash. Null ids and null labels
    are left out. The bounded list of ids is broadcast.
    """
    known = labels.where(usable & F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    known = cut(known.groupBy(F.col(id_column).alias("id")).agg((F.max(label_column) > 0).cast("int").alias("label")),
                "toxic-labels")
    parts = []
    for label, most in ((1, positives), (0, negatives)):
        rows = known.where(F.col("label") == label)
        taken = rows.orderBy(F.xxhash64("id"), "id").limit(most)
        parts.append(taken.withColumn("weight", F.lit(max(1.0, rows.count() / most))))
    ids = parts[0].unionByName(parts[1])
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(ids), "id").groupBy("id", "label", "weight").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return joined.select("text", "label", "weight", (F.pmod(F.xxhash64("text"), F.lit(2)) == 0).alias("half"))


def learn_stems(rows: DataFrame, least: int = 3, least_share: float = 0.002, least_weight: float = 2.5,
                most: int = 20_000) -> dict[str, float]:
    """Stems of labelled texts (text, label) with the log-odds of toxic against other distinct texts that hold them.

    A stem is in at least ``least`` distinct toxic texts and in the share ``least_share`` of them; at most ``most`` stems,
    the widest spread first. A longer stem stays only if it says more than the shorter one it begins with.
    """
    texts = rows.groupBy("text").agg(F.max("label").alias("label"))
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"))
    lengths = F.sequence(F.lit(SHORTEST), F.lit(LONGEST))
    stems = F.flatten(F.transform(F.filter(words, lambda w: F.length(w) >= SHORTEST), lambda w: F.concat(
        F.array(F.concat(w, F.lit(" "))), F.transform(F.filter(lengths, lambda n: n <= F.length(w)), lambda n: w.substr(F.lit(1), n)))))
    held = texts.select("label", F.explode(F.array_distinct(stems)).alias("stem"))
    counts = held.groupBy("stem").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"))
    total = texts.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other")).first()
    if not total.toxic or not total.other:
        return {}
    odds = F.log((F.col("toxic") + 0.1) / (total.toxic + 1.0)) - F.log((F.col("other") + 0.5) / (total.other + 1.0))
    best = counts.where(F.col("toxic") >= max(least, total.toxic * least_share))
    best = best.withColumn("weight", odds).where(F.col("weight") >= least_weight)
    best = best.orderBy(F.desc(F.col("weight") * F.col("toxic")), "stem").limit(most)
    found = {r.stem: round(r.weight, 6) for r in best.collect()}
    kept: dict[str, float] = {}
    for stem in sorted(found, key=lambda s: (len(s), s)):
        shorter = max((kept[stem[:n]] for n in range(SHORTEST, len(stem)) if stem[:n] in kept), default=0.0)
        if found[stem] > shorter + 0.05:
            kept[stem] = found[stem]
    return kept


def _feature_rows(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            found = [reader.features(raw) for raw in raw_texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.float64()))], ["label", "weight", "features"])

    return rows.select("text", "label", "weight").mapInArrow(run, "label int, weight double, features array<double>")


def train(docs: DataFrame, labels: DataFrame, usable: Column, positives: int = 4000, negatives: int = 8000,
          id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Model:
    """Stems from one half of a bounded sample of labelled texts, weights from the other; the fixed model if that fails.

    The halves are told apart by the text's hash, so exact copies never stand in both.
    """
    rows = cut(labelled(docs, labels, usable, positives, negatives, id_column, text_column, label_column), "toxic-sample")
    first = Model(stems=learn_stems(rows.where("half")))
    sample = _feature_rows(rows.where("not half"), first).collect()  # bounded by positives + negatives
    label = np.array([r.label for r in sample], float)
    if len(set(label)) < 2:
        return Model(stems=first.stems)
    features = np.array([r.features for r in sample])
    weights = _fit(features, label, np.array([r.weight for r in sample]))
    # The grammar's weights stand; the stems now come from both halves.
    return Model(stems=learn_stems(rows), weights=tuple(round(float(w), 6) for w in weights))


def score(docs: DataFrame, model: Model, text_column: str = "text", out: str = "toxicity") -> DataFrame:
    """Adds ``out`` (double from 0 to 1, replaced if it exists) to every row.

    A null or empty text scores the model's base rate; all other columns pass through; an empty table stays empty.
    """
    kept = [c for c in docs.columns if c != out]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = Reader(model), np.array(model.weights)
        for batch in batches:
            found = np.array([reader.features(raw) for raw in raw_texts(batch.column(1))]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(probability(found, weights))], ["row", "score"])

    scored = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")
    return scored.select(*[F.col("row")[c].alias(c) for c in kept], F.col("score").alias(out))


def held_out(id_column: str = "doc_id") -> Column:
    """Rows kept out of training."""
    return fold(id_column, 5, 0)
