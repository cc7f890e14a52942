"""Toxicity: a weighted lexicon, learned from labels and matched by Aho-Corasick.

Texts are folded first: letters that look alike and digits or signs put in place of
letters become plain letters.  Every hit of a lexicon entry that no exception phrase covers
counts with the entry's weight.  The score is a logistic curve over the summed weights, as
they are and normalised by the length of the text.

The lexicon, its exception phrases and the curve are fitted on a bounded sample of labelled
rows (``TRAIN_ROWS``, the smallest by a hash of doc_id); every document is scored whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import written

TRAIN_ROWS = 12_000
STEMS = (3, 4, 5, 6)  # lengths of word beginnings that may become entries
LEAST_SURPRISE = 14.0  # log-likelihood ratio of an entry's counts: rare by chance even among many candidates
LEAST_ODDS = 3.0  # natural logarithm
ENTRIES = 4_000
EXCEPTIONS = 2_000
THRESHOLD = 0.7

# Signs and digits that stand for letters, and letters of other scripts that
# look like Latin ones.
# 1, !, | and l stand for each other and for i, so all become i.
SIGNS = dict(zip("013457@$!|l", "oieastasiii", strict=True))
CYRILLIC = dict(zip("абвгдезіјкмнорстухѕԁԛԝһё", "abbrdezijkmhopctyxsdqwhe", strict=True))
GREEK = dict(zip("αβεικνορτυχωγη", "abeiknoptuxwyn", strict=True))
LATIN = {"ı": "i", "ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d"}


def _folding(accents: bool) -> dict[int, str | None]:
    """Characters to plain ones; with ``accents`` also accented Latin letters lose theirs."""
    blocks = [range(0x1E00, 0x1F00), range(0xFF01, 0xFF5F), range(0x1D400, 0x1D800)]
    if accents:
        blocks.append(range(0xC0, 0x250))
    table: dict[int, str | None] = {}
    for code in (c for block in blocks for c in block):
        parts = unicodedata.normalize("NFKD", chr(code))
        plain = "".join(c for c in parts if not unicodedata.combining(c)).lower()
        if plain and plain != chr(code):
            table[code] = "".join(SIGNS.get(c, c) for c in plain)
    hidden = [*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF]
    table |= {code: None for code in hidden}
    table |= {ord(c): to for c, to in (CYRILLIC | GREEK | SIGNS).items()}
    if accents:
        table |= {ord(c): to for c, to in LATIN.items()}
    return table | {c: " " for c in b"\t\n\r\x0b\x0c.,;:?\"()[]{}<>/\\*#%&+=~^`"}


MARKS = re.compile(r"[!$|@]{2,}|[!|](?=\s|$)")
FOLDING = _folding(accents=False)
NO_ACCENTS = _folding(accents=True)


def fold(text: str | None, accents: bool = False) -> str:
    """Lower-case letters, look-alikes made plain, words parted by spaces.

    Accents tell words of many languages apart, so they stay unless ``accents`` asks for
    plain letters; matching tries both.
    """
    # Signs stand for letters inside words only: runs of them and those at ends are marks.
    plain = MARKS.sub(" ", (text or "").lower())
    return plain.translate(NO_ACCENTS if accents else FOLDING)


@dataclass(frozen=True)
class Model:
    entries: dict[str, float]  # a beginning or, with a space at its end, a whole word
    exceptions: frozenset[str]  # two words, the one next to a hit and the hit
    curve: tuple[float, float, float, float]

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            found.add_word(f" {entry}", (len(entry), weight))
        if not len(found):
            return None
        found.make_automaton()
        return found


def _hits(folded: str, model: Model, automaton) -> tuple[float, float]:
    """Summed weights, for every word the heaviest entry that begins it; the heaviest of all."""
    if automaton is None:
        return 0.0, 0.0
    text = f" {folded} "
    best: dict[int, float] = {}
    for end, (length, weight) in automaton.iter(text):
        start = end - length + 1
        if weight > best.get(start, 0.0):
            best[start] = weight
    if best and model.exceptions:
        for start in list(best):
            stop = text.find(" ", start)
            before = text[:start].rsplit(None, 1)[-1:] if start < 64 else text[start - 64 : start].split()[-1:]
            after = text[stop : stop + 64].split()[:1]
            word = text[start:stop]
            if {f"{w} {word}" for w in before} & model.exceptions or {f"{word} {w}" for w in after} & model.exceptions:
                del best[start]
    return sum(best.values()), max(best.values(), default=0.0)


def _features(text: str | None, model: Model, automaton) -> tuple[float, float, float]:
    folded = fold(text)
    total, most = _hits(folded, model, automaton)
    if not folded.isascii():
        total, most = max((total, most), _hits(fold(text, accents=True), model, automaton))
    words = folded.count(" ") + 1
    return math.log1p(total), math.log1p(1000 * total / (words + 20)), most


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, toxic) of a bounded sample of labelled rows that are not held out."""
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    # At most ``rows`` pairs of numbers: safe to send to every executor.
    return docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")


def _count_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: dict[int, Counter] = {0: Counter(), 1: Counter()}
    totals = [0, 0]
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            words = set(fold(text).split())
            seen = {f"{w} " for w in words}
            for n in STEMS:
                seen |= {w[:n] for w in words if len(w) >= n}
            found[toxic].update(seen)
            totals[toxic] += 1
    found[1][""], found[0][""] = totals[1], totals[0]
    names = list(found[1])
    # What no toxic text of this part holds can only lower a weight: kept if it is frequent.
    names += [w for w, n in found[0].items() if w not in found[1] and n > 1]
    yield pd.DataFrame({
        "entry": names,
        "bad": [found[1][w] for w in names],
        "good": [found[0][w] for w in names],
    })


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn entries, exception phrases and the curve.  Without labels of both kinds nothing scores."""
    train = training_rows(docs, labels, rows).repartition(16, "doc_id")
    counted = train.mapInPandas(_count_entries, "entry string, bad long, good long")
    summed = counted.groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    summed = written(summed, "lexicon")
    totals = summed.where("entry = ''").first()
    bad, good = (totals["bad"], totals["good"]) if totals else (0, 0)
    if not bad or not good:
        return Model({}, frozenset(), (-3.0, 0.0, 0.0, 0.0))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    hits, share = F.col("bad") + F.col("good"), bad / (bad + good)
    surprise = 2 * sum(
        (F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (hits * p))).otherwise(0.0) for c, p in (("bad", share), ("good", 1 - share))),
        F.lit(0.0),
    )
    listed = (
        summed.where("entry <> ''").withColumn("odds", odds)
        .where((surprise >= LEAST_SURPRISE) & (F.col("odds") >= LEAST_ODDS))
        .orderBy(F.desc("odds"), F.desc("bad"), "entry").limit(ENTRIES).collect()
    )
    entries = {r["entry"]: float(r["odds"]) for r in listed}
    bare = Model(entries, frozenset(), (0.0, 0.0, 0.0, 0.0))

    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = bare.automaton()
        for batch in batches:
            found: Counter = Counter()
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = fold(text).split()
                hit = [automaton is not None and _hits(w, bare, automaton)[1] > 0 for w in words] if _hits(" ".join(words), bare, automaton)[1] else []
                for i, is_hit in enumerate(hit):
                    if is_hit:
                        for pair in (words[max(i - 1, 0) : i + 1], words[i : i + 2]):
                            if len(pair) == 2:
                                found[" ".join(pair), toxic] += 1
            yield pd.DataFrame([(p, t, n) for (p, t), n in found.items()], columns=["phrase", "toxic", "n"])

    pairs = train.mapInPandas(phrases, "phrase string, toxic long, n long")
    excepted = (
        pairs.groupBy("phrase").agg(
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        )
        .where("good >= 3 AND good > 10 * bad").orderBy(F.desc("good"), "phrase").limit(EXCEPTIONS).collect()
    )
    model = Model(entries, frozenset(r["phrase"] for r in excepted), (0.0, 0.0, 0.0, 0.0))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = model.automaton()
        for batch in batches:
            found = np.array([_features(t, model, automaton) for t in batch["text"]]).reshape(-1, 3)
            yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1], "c": found[:, 2], "y": batch["toxic"]})

    # Four numbers for each training row.
    rows_of = train.mapInPandas(measure, "a double, b double, c double, y long").collect()
    got = np.array(rows_of, dtype=float)
    got = got[np.lexsort(got.T)]
    return Model(entries, model.exceptions, _logistic(got[:, :3], got[:, 3]))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Penalised logistic regression; features whose slope would be negative are left out."""
    used = list(range(x.shape[1]))
    while True:
        at = _newton(np.c_[np.ones(len(x)), x[:, used]], y)
        if not used or at[1:].min() >= 0:
            break
        del used[int(np.argmin(at[1:]))]
    found = np.zeros(x.shape[1] + 1)
    found[[0, *(u + 1 for u in used)]] = at
    return tuple(float(v) for v in found)


def _newton(design: np.ndarray, y: np.ndarray, penalty: float = 0.2) -> np.ndarray:
    ridge = np.r_[1e-6, np.full(design.shape[1] - 1, penalty)]

    def loss(at: np.ndarray) -> float:
        margin = design @ at
        return float(np.logaddexp(0, margin).sum() - y @ margin + ridge @ at**2 / 2)

    at = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, design.T @ (p - y) + ridge * at)
        size = 1.0
        while loss(at - size * step) > loss(at) and size > 1e-6:
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return at


def _chance(curve: tuple[float, ...], features: tuple[float, ...]) -> float:
    at = curve[0] + sum(w * x for w, x in zip(curve[1:], features))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, at))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column toxicity (0 to 1).  A null text scores like an empty one."""

    @F.pandas_udf("double")
    def toxicity(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = model.automaton()
        curve = model.curve
        for texts in parts:
            found = (_features(t, model, automaton) for t in texts)
            yield pd.Series([_chance(curve, x) for x in found], dtype="float64")

    return docs.withColumn("toxicity", toxicity(F.col("text").cast("string")))


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Labels are learned only from rows that are not held out (crc32 of doc_id as text,
    modulo 3, is 1).  Rows may repeat; a null doc_id is not held out; null and empty texts
    are scored.  Of several labels of a doc_id the worst counts.  Other columns are ignored.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, rows))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns."""
    scored = score(docs.select(F.struct("*").alias("row"), F.col("text").alias("text")), fit(docs, labels, rows))
    return scored.where(F.col("toxicity") < THRESHOLD).select("row.*")
