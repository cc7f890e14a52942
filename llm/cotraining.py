"""Document quality by co-training two views.

One classifier sees the text's content (words, letters, repetition), the other the page's
metadata (language, source, length, layout of lines).  Both start from the same labelled
rows.  In every round each hands the unlabelled rows it is surest of to the other, with its
own verdict.  On labelled rows that neither has learned from, each view's scores are
calibrated and the calibrated views combined; that scores every document.

Fitting uses bounded samples, the smallest rows by a hash of doc_id: ``LABELLED`` labelled
rows and ``POOL`` rows without label.  Every document is scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.toxicity import held_out

LABELLED = 12_000
POOL = 8_000
ROUNDS = 4
SHARE = 0.1  # of the pool, handed over in a round
SURE = 0.9
BINS = 12
SOURCES = 64
LANGS = 16
KEEP = 0.5


def text_features(text: str) -> list[float]:
    """Content: what the words are made of and how they repeat."""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * 11
    counts = Counter(words)
    letters = len(re.sub(r"[\W\d_]+", "", text))
    upper = sum(map(str.isupper, counts)) and sum(c for w, c in counts.items() if w.isupper())
    marked = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,")
    bare = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    again = sum(map(str.__eq__, words, words[1:]))
    stops = sum(c for w, c in counts.items() if w[-1] == ".")
    short = sum(c for w, c in counts.items() if len(w) <= 3)
    pairs = len(set(zip(words, words[1:])))
    return [
        letters / chars, upper / n, marked / n, bare / n, again / n, stops / n, short / n,
        len(counts) / n, pairs / max(n - 1, 1), max(counts.values()) / n, (chars - n + 1) / n,
    ]


def page_features(text: str, n_chars: int | None) -> list[float]:
    """Metadata: stated length and the layout of lines."""
    lines = text.split("\n")
    sizes = np.fromiter(map(len, lines), float, len(lines))
    stated = float(len(text) if n_chars is None else n_chars)
    ends = sum(line[-1:] in (".", "!", "?") for line in lines) / len(lines)
    return [
        np.log1p(max(stated, 0.0)), np.log1p(len(lines)), float(sizes.mean()), float(sizes.max()), float(sizes.min()),
        float(sizes.std()), ends, text.count(" ") / max(len(text), 1),
    ]


def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The two views of rows (text, lang, source, n_chars)."""
    a, b = [], []
    for text, lang, source, n_chars in zip(*(batch.column(i).to_pylist() for i in range(4))):
        text = text or ""
        a.append(text_features(text))
        codes = [zlib.crc32(lang.encode()) % LANGS if lang is not None else LANGS]
        codes.append(zlib.crc32(source.encode()) % SOURCES if source is not None else SOURCES)
        b.append([*page_features(text, n_chars), *map(float, codes)])
    return np.array(a).reshape(-1, 11), np.array(b).reshape(-1, 10)


@dataclass
class View:
    """An additive logistic model over binned numbers and codes."""

    codes: tuple[int, ...] = ()  # how many values the last columns have
    cuts: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def frame(self, x: np.ndarray) -> None:
        numbers = x.shape[1] - len(self.codes)
        at = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(x[:, i], at)) for i in range(numbers)]

    def design(self, x: np.ndarray) -> np.ndarray:
        places, base = [], 1
        for i, cuts in enumerate(self.cuts):
            places.append(base + np.searchsorted(cuts, x[:, i], side="right"))
            base += len(cuts) + 1
        for i, size in enumerate(self.codes):
            places.append(base + x[:, len(self.cuts) + i].astype(int))
            base += size
        out = np.zeros((len(x), base))
        out[:, 0] = 1
        for p in places:
            out[np.arange(len(x)), p] = 1
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.weights = logistic(self.design(x), y, 1.0)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.weights


def logistic(design: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Penalised logistic regression by Newton's method; the first column is the constant."""
    at = np.zeros(design.shape[1])
    ridge = np.r_[1e-6, np.full(len(at) - 1, penalty)]
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        slope = design.T @ (p - y) + ridge * at
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        at -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-7:
            break
    return at


@dataclass
class Model:
    text: View
    page: View
    scales: np.ndarray  # (view, constant and slope): calibration of each
    mix: np.ndarray  # constant, text, page

    def scores(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        views = [
            scale[0] + scale[1] * view.logit(x)
            for scale, view, x in zip(self.scales, (self.text, self.page), (a, b))
        ]
        both = self.mix[0] + self.mix[1] * views[0] + self.mix[2] * views[1]
        return tuple(1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (*views, both))


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, share: float = SHARE, sure: float = SURE) -> Model:
    """``y``: 0, 1, or -1 for rows of the pool.  Every fourth labelled row calibrates."""
    known = np.flatnonzero(y >= 0)
    held = known[3::4]
    learn = np.setdiff1d(known, held)
    views = (View(), View(codes=(LANGS + 1, SOURCES + 1)))
    data = (a, b)
    if len(np.unique(y[learn])) < 2 or len(np.unique(y[held])) < 2:
        constant = float(y[known].mean()) if len(known) else 0.5
        at = np.log((constant + 1e-3) / (1 - constant + 1e-3))
        for view, x in zip(views, data):
            view.frame(x if len(x) else np.zeros((1, x.shape[1])))
            view.weights = np.zeros(view.design(x[:1] if len(x) else np.zeros((1, x.shape[1]))).shape[1])
        return Model(*views, np.array([[at, 0.0], [at, 0.0]]), np.array([at, 0.0, 0.0]))
    taught = [{int(i): int(y[i]) for i in learn} for _ in views]
    pool = np.flatnonzero(y < 0)
    for view, x in zip(views, data):
        view.frame(x)
    for turn in range(rounds + 1):
        for view, x, own in zip(views, data, taught):
            rows = np.fromiter(own, int, len(own))
            view.fit(x[rows], np.fromiter(own.values(), float, len(own)))
        if turn == rounds or not len(pool):
            break
        for me, other in ((0, 1), (1, 0)):
            free = np.array([i for i in pool if int(i) not in taught[other]], dtype=int)
            if not len(free):
                continue
            chance = 1 / (1 + np.exp(-np.clip(views[me].logit(data[me][free]), -30, 30)))
            most = max(1, int(share * len(pool)))
            for verdict, confidence in ((1, chance), (0, 1 - chance)):
                # Both verdicts in the proportion that the labels have.
                room = max(1, int(most * (y[learn] == verdict).mean()))
                best = np.argsort(-confidence, kind="stable")[:room]
                taught[other].update((int(free[i]), verdict) for i in best if confidence[i] >= sure)
    one = np.ones(len(held))
    scales = np.array([logistic(np.c_[one, v.logit(x[held])], y[held], 0.1) for v, x in zip(views, data)])
    calibrated = [s[0] + s[1] * v.logit(x[held]) for s, v, x in zip(scales, views, data)]
    return Model(*views, scales, logistic(np.c_[one, calibrated[0], calibrated[1]], y[held], 0.1))


INPUT = ("text", "lang", "source", "n_chars")


def _inputs() -> list:
    kinds = {"n_chars": "long"}
    return [F.col(c).cast(kinds.get(c, "string")).alias(c) for c in INPUT]


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> Model:
    """Learn from bounded samples of rows that are not held out."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.min("y").alias("y"))
    )
    open_ = marked.where(~held_out(F.col("doc_id")))
    first = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    unmarked = ids.join(marked.hint("merge"), "doc_id", "left_anti").where(~held_out(F.col("doc_id"))).distinct()
    chosen = open_.orderBy(*first).limit(labelled).unionByName(
        unmarked.orderBy(*first).limit(pool).withColumn("y", F.lit(-1))
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = features(batch)
            rows = np.c_[a, b]
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(4), batch.column(5), flat], names=["doc_id", "y", "x"])

    # At most ``labelled`` + ``pool`` pairs of numbers are broadcast, and as many rows of 21 numbers collected.
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_inputs()).join(F.broadcast(chosen), "doc_id")
    got = sample.select(*INPUT, "doc_id", "y").mapInArrow(measure, "doc_id long, y int, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=float).reshape(-1, 21)
    y, ids_ = np.asarray(got.column("y")), np.asarray(got.column("doc_id"))
    order = np.lexsort((*x.T, ids_ * 2654435761 % (1 << 31)))
    x, y = x[order], y[order]
    return co_train(x[:, :11], x[:, 11:], y)


def quality_scores(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> DataFrame:
    """doc_id, held_out, text_score, page_score, score (0 to 1, higher: better), predicted, kept.

    Every row of ``docs`` is scored: null and empty texts by their metadata and an empty
    text, null lang, source and n_chars as values of their own.  Rows may repeat.  Of
    several labels of a doc_id the worst counts; without labels of both kinds every score
    is the labels' mean (0.5 without any).  Labels of held-out rows (crc32 of doc_id as
    text, modulo 3, is 1) are never learned.  Other columns are ignored.
    """
    model = fit(docs, labels, labelled, pool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                text, page, both = model.scores(*features(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column(4), pa.array(text), pa.array(page), pa.array(both)],
                    names=["doc_id", "text_score", "page_score", "score"],
                )

    scored = docs.select(*_inputs(), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        run, "doc_id long, text_score double, page_score double, score double"
    )
    kept = F.col("score") >= KEEP
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text_score", "page_score", "score",
        kept.cast("int").alias("predicted"), kept.alias("kept"),
    )
