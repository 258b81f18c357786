"""Toxicity by a weighted lexicon that is learnt from labels and matched by Aho-Corasick.

Text is folded first: case, look-alike letters of other scripts, invisible marks, and digits or signs
that stand for letters. Accents stay, as they tell words apart. A lexicon entry is a folded word or the beginning of
one, with a weight; an exception is a word or pair of words around an entry that only clean documents
use, and a match inside an exception doesn't count. The weights of a text's matches are summed and set against
its length, and a logistic curve that was fitted to the same labelled rows turns both into a score.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapseflow.llm import tokens
from lapseflow.llm.labelled import labelled_sample, remainder
from lapseflow.llm.registry import query, table
from lapseflow.session import stored

#: Labelled documents to learn from at most.
SAMPLE = 20_000
#: Lengths of word beginnings that may become entries, next to whole words of MIN_WORD letters.
BEGINNINGS = range(3, 11)
MIN_WORD = 3
#: An entry is in so many toxic documents of the sample, or this share of them, at least ...
SUPPORT, SUPPORT_SHARE = 3, 0.002
#: ... and so much of the documents with it, each class counted as a share of its own, is toxic.
PRECISION = 0.8
#: What a clean document with a term costs against a toxic one, as shares of their classes.
PENALTY = 2.0
#: A word or pair of words is an exception when so many clean documents and no toxic one have it.
EXCEPTION_SUPPORT = 2
PIECE = 1 << 19

#: Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}


def _folding() -> dict[int, str | None]:
    """Translation of characters: to plain lower-case letters, or to a space if neither letter nor digit."""
    found: dict[int, str | None] = {}
    # All alphabetic scripts, general punctuation and letter-like signs.
    for code in range(0x2200):
        char = chr(code)
        plain = "".join(LOOK_ALIKES.get(c, c) for c in unicodedata.normalize("NFKC", char).lower())
        plain = "".join(c if c.isalnum() else " " for c in plain)
        # Combining marks and what can't be seen between letters go.
        if unicodedata.combining(char) or unicodedata.category(char) == "Cf":
            found[code] = None
        elif plain != char:
            found[code] = plain
    # Enclosed and mathematical letters and digits, ligatures.
    for code in (*range(0x2460, 0x2500), *range(0xFB00, 0xFB07), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)):
        plain = "".join(c for c in unicodedata.normalize("NFKC", chr(code)).lower() if c.isalnum())
        if plain != chr(code):
            found[code] = "".join(found.get(ord(c), c) or "" for c in plain) or " "
    # Full-width forms.
    for code in range(0xFF01, 0xFF5F):
        plain = found.get(code - 0xFEE0, chr(code - 0xFEE0))
        found[code] = plain
    found[0xFEFF] = None
    return found


_FOLD = _folding()


def folded(text: str | None) -> str:
    """Folded words between single spaces, with a space at either end."""
    return " " + " ".join((text or "").translate(_FOLD).split()) + " "


def terms(words: Iterable[str]) -> set[str]:
    """Whole words as ``" word "`` and their beginnings as ``" wor"``."""
    found = set()
    for word in set(words):
        if len(word) >= MIN_WORD:
            found.add(f" {word} ")
            found.update(f" {word[:n]}" for n in BEGINNINGS if n <= len(word))
    return found


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and intercept and slopes of the score."""

    entries: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    curve: tuple[float, float, float] = (-4.0, 1.0, 1.0)

    def automaton(self):
        found = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            # The digit 1 is read as an i, but may stand for an l.
            for written in (entry.replace("l", "i"), entry):
                found.add_word(written, (written, weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (phrase, None))
        if len(found):
            found.make_automaton()
        return found


def weight_of(matcher, text: str) -> float:
    """The summed weights of the words of a folded text that match; a word counts with its heaviest entry."""
    if not len(matcher):
        return 0.0
    hits: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (phrase, weight) in matcher.iter(text):
        start = end - len(phrase) + 1
        if weight is None:
            spared.append((start, end))
        else:
            hits[start] = max(hits.get(start, 0.0), weight)
    spared.sort()
    total, k, reach = 0.0, 0, -1
    for at in sorted(hits):
        while k < len(spared) and spared[k][0] <= at:
            reach = max(reach, spared[k][1])
            k += 1
        # The phrase's last space begins the next word.
        if at >= reach:
            total += hits[at]
    return total


def measures(weight: float, text: str) -> tuple[float, float]:
    """Logarithms of the weight and of the weight for a thousand words."""
    return float(np.log1p(weight)), float(np.log1p(1000 * weight / max(1, text.count(" ") - 1)))


def score_of(lexicon: Lexicon, matcher, text: str | None) -> float:
    plain = folded(text)
    a, b, c = lexicon.curve
    x, y = measures(weight_of(matcher, plain), plain)
    return float(1 / (1 + np.exp(-np.clip(a + b * x + c * y, -50, 50))))


def _pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in tokens.slices(batch.column(text), PIECE):
            yield batch.slice(low, high - low)


def _counted(rows: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(term, n): the documents of (text) with each term, or with each of the wanted ones."""
    sent = rows.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, 0):
            seen: Counter[str] = Counter()
            for text in piece.column(0).to_pylist():
                found = terms(folded(text).split())
                seen.update(found if sent is None else found & sent.value)
            yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    return rows.select("text").mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def _holders(rows: DataFrame, wanted: set[str]) -> DataFrame:
    """(place, terms): which of the wanted terms each text of (place, text) has."""
    sent = rows.sparkSession.sparkContext.broadcast(wanted)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, 1):
            found = [sorted(terms(folded(t).split()) & sent.value) for t in piece.column(1).to_pylist()]
            yield pa.record_batch([piece.column(0), pa.array(found, pa.list_(pa.string()))], names=["place", "terms"])

    return rows.select("place", "text").mapInArrow(find, "place bigint, terms array<string>")


def _cover(holders: dict[str, set[int]], strength: dict[str, float], cost: dict[str, float], support: int) -> dict[str, float]:
    """Entries that explain the toxic documents: each next one explains most that are not yet explained, less its cost.

    Of equals the stronger, then the longer, then the first in the alphabet is taken. That leaves out
    terms that only copies of an explained document share. Each explains ``support`` documents
    that no earlier one does, so there are at most the sample's toxic documents by ``support`` of them.
    """
    left = {t: set(d) for t, d in holders.items()}
    chosen: dict[str, float] = {}
    while left:
        best = min(left, key=lambda t: (cost[t] - len(left[t]), -round(strength[t], 6), -len(t), t))
        if len(left[best]) - cost[best] < support:
            break
        chosen[best] = strength[best]
        done = left.pop(best)
        left = {t: rest for t, d in left.items() if (rest := d - done)}
    return chosen


def _contexts(rows: DataFrame, entries: dict[str, float]) -> DataFrame:
    """(phrase, label, n): documents with each matched word, and with the pairs it stands in."""
    sent = rows.sparkSession.sparkContext.broadcast(entries)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Lexicon(sent.value).automaton()
        for piece in _pieces(batches, 0):
            seen: Counter[tuple[str, int]] = Counter()
            for text, label in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                plain = folded(text)
                around = set()
                for end, (entry, _) in matcher.iter(plain) if len(matcher) else ():
                    start = end - len(entry) + 1
                    stop = plain.index(" ", start + 1)
                    before = plain.rfind(" ", 0, start) if start else start
                    after = plain.find(" ", stop + 1)
                    around |= {plain[start : stop + 1], plain[max(before, 0) : stop + 1], plain[start : (after if after > 0 else stop) + 1]}
                seen.update((phrase, label) for phrase in around)
            yield pa.record_batch(
                [pa.array([p for p, _ in seen], pa.string()), pa.array([x for _, x in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())],
                names=["phrase", "label", "n"],
            )

    found = rows.select("text", "label").mapInArrow(find, "phrase string, label int, n bigint")
    return found.groupBy("phrase").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )


def _measured(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = sent.value.automaton()
        for piece in _pieces(batches, 0):
            plain = [folded(t) for t in piece.column(0).to_pylist()]
            both = [measures(weight_of(matcher, p), p) for p in plain]
            yield pa.record_batch(
                [pa.array([x for x, _ in both], pa.float64()), pa.array([y for _, y in both], pa.float64()), piece.column(1)],
                names=["x", "y", "label"],
            )

    return rows.select("text", "label").mapInArrow(measure, "x double, y double, label int")


def _curve(x: np.ndarray, y: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small ridge on the slopes, which must not be negative."""
    use = [0, 1, 2]
    beta = np.zeros(3)
    rows = np.column_stack([np.ones(len(x)), x, y])
    while True:
        part, b = rows[:, use], np.zeros(len(use))
        ridge = np.diag([1e-3] + [0.5] * (len(use) - 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(part @ b, -30, 30)))
            step = np.linalg.solve(part.T @ (part * (p * (1 - p))[:, None]) + ridge, part.T @ (label - p) - ridge @ b)
            b += step
            if np.abs(step).max() < 1e-6:
                break
        if (b[1:] >= 0).all():
            beta[use] = b
            return tuple(float(v) for v in beta)
        use = [u for u, v in zip(use, b, strict=True) if u == 0 or v >= 0]


def fit(sample: DataFrame, given: dict[str, float] | None = None, exceptions: Iterable[str] = ()) -> Lexicon:
    """A lexicon from (text, label) rows, of which there are ``SAMPLE`` at most.

    ``given``: entries, folded or not, that are kept with their weights beside the learnt ones;
    ``exceptions``: phrases that are always spared. Without a toxic row there are only these.
    """
    rows = stored(sample.select("text", "label"), "toxic")
    sizes = dict(rows.groupBy("label").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    entries: dict[str, float] = {folded(k): w for k, w in (given or {}).items()}
    spared = {folded(x) for x in exceptions}
    if not toxic:
        return Lexicon(entries, spared)
    support = max(SUPPORT, int(SUPPORT_SHARE * toxic))
    marked = rows.where("label = 1").withColumn("place", F.xxhash64("text"))
    frequent = _counted(marked, None).where(F.col("n") >= support)
    # All that the sample's toxic documents share; its rows are bounded, and with them these terms.
    hits = {r["term"]: r["n"] for r in frequent.collect()}
    other = {r["term"]: r["n"] for r in _counted(rows.where("label = 0"), set(hits)).collect()}
    strength, cost = {}, {}
    for term, n in hits.items():
        share, rest = n / toxic, other.get(term, 0) / max(clean, 1)
        if share >= PRECISION * (share + rest):
            odds = (n + 0.5) * (clean - other.get(term, 0) + 0.5) / ((toxic - n + 0.5) * (other.get(term, 0) + 0.5))
            strength[term] = float(np.log(max(odds, 1.5)))
            cost[term] = PENALTY * rest * toxic
    holders: dict[str, set[int]] = defaultdict(set)
    if strength:
        for place, found in _holders(marked, set(strength)).collect():
            for term in found:
                holders[term].add(place)
    # Copies of a text have one place: they are one document here.
    entries = _cover({t: d for t, d in holders.items() if len(d) >= SUPPORT}, strength, cost, SUPPORT) | entries
    around = _contexts(rows, entries).where((F.col("toxic") == 0) & (F.col("clean") >= EXCEPTION_SUPPORT))
    spared |= {r["phrase"] for r in around.collect()}
    lexicon = Lexicon(entries, spared - set(entries))
    # A bounded table: three numbers for each row of the sample.
    found = np.array(_measured(rows, lexicon).collect(), float)
    lexicon.curve = _curve(found[:, 0], found[:, 1], found[:, 2])
    return lexicon


def scored(docs: DataFrame, lexicon: Lexicon, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``, in place of one of that name, from column ``text``.

    Null and empty texts score as texts without a match.
    """
    docs = docs.drop(name)
    at = docs.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = sent.value.automaton()
        for piece in _pieces(batches, at):
            values = [score_of(sent.value, matcher, t) for t in piece.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(values, pa.float64())], names=[*piece.schema.names, name])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; see :func:`scored`.

    Rows without an id are scored as all others and not held out; rows that share an id
    are scored one by one.
    """
    sample = labelled_sample(docs, labels, "toxic", remainder("doc_id", 4) != 2, SAMPLE)
    rows = scored(docs.select("doc_id", "text"), fit(sample))
    return rows.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity, learnt from the labels outside the hold-out."""
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
