"""Quality classifier by co-training.

Two views of a document are learned apart: its text content (repetition, symbols, case, word shapes)
and its page metadata (language, source, length, layout of lines). Both start from the same labelled
rows. In each round a view labels unlabelled documents it is confident of, as many good and bad ones
as their share in the labels, and hands them to the other view. At the end each view is calibrated on
labelled rows kept aside, and a logistic combination of both, fitted there too, scores all documents.

Every language and source in the sample is a feature of its own, whatever their number: they are kept as
their numbers, not as columns, and a fit with many features solves its steps by conjugate gradients.

Features are computed where documents are read. The driver gets those of a bounded sample only: at most
``LABELLED`` labelled and ``UNLABELLED`` unlabelled documents, drawn by a hash of their id from the ids that
are there. An id counts once: of its rows one goes into each sample, the same in every run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, slices

LABELLED = 12_000
UNLABELLED = 12_000
ROUNDS = 4
CONFIDENT = 0.95
PER_ROUND = 0.05  # of the unlabelled sample
KEEP = 0.5
BINS = 8
DIRECT = 1_000  # features up to which a step is solved directly: changes the time, not the result

TEXT_VIEW = (
    "same_as_before", "distinct_words", "upper", "symbols", "bars", "symbol_ends", "digits",
    "word_length", "sentence_ends",
)
META_NUMBERS = ("chars", "lines", "line_length", "repeated_lines", "blank_lines")

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122) | (_BYTE >= 128)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_SPACE = (_BYTE == 32) | (_BYTE >= 9) & (_BYTE <= 13)
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _SPACE) & ~np.isin(_BYTE, list(b".,;:?'\"()-"))
_SYMBOL_END = re.compile(r"[^\w\s.,;:?'\"()-](?=\s|$)")


def describe(text: str | None, n_chars: int | None) -> list[float]:
    """The numbers of both views, of the whole text; null is empty."""
    text = text or ""
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    words, lines = text.split(), text.split("\n")
    n, w = max(1, int(raw.sum())), max(1, len(words))
    letters = max(1, int(raw[_UPPER | _LOWER].sum()))
    distinct = set(words)
    filled = [line for line in lines if line.strip()]
    return [
        sum(map(str.__eq__, words, words[1:])) / w,
        len(distinct) / w,
        raw[_UPPER].sum() / letters,
        raw[_SYMBOL].sum() / n,
        raw[ord("|")] / w,
        len(_SYMBOL_END.findall(text)) / w,
        raw[_DIGIT].sum() / n,
        letters / w,
        raw[ord(".")] / w,
        float(np.log1p(len(text) if n_chars is None else max(0, n_chars))),
        float(np.log1p(len(lines))),
        len(text) / len(lines),
        1 - len(set(filled)) / max(1, len(filled)),
        1 - len(filled) / len(lines),
    ]


def _rows(docs: DataFrame, *more) -> DataFrame:
    """doc_id, text, n_chars, lang, source and ``more``; a missing metadata column is null."""
    names = {"n_chars": "bigint", "lang": "string", "source": "string"}
    meta = [
        (F.col(f"`{n}`") if n in docs.columns else F.lit(None)).cast(t).alias(n) for n, t in names.items()
    ]
    return docs.select("doc_id", "text", *meta, *more)


def _described(rows: DataFrame) -> DataFrame:
    """Rows of ``_rows`` (with a label or without) as doc_id, lang, source, numbers, label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            numbers = [describe(t, n) for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(3), b.column(4), pa.array(numbers, pa.list_(pa.float64())), b.column(5)],
                ["doc_id", "lang", "source", "numbers", "label"],
            )

    return rows.mapInArrow(run, "doc_id bigint, lang string, source string, numbers array<double>, label int")


@dataclass
class Named:
    """Rows of columns followed by ``n`` features that are one where a row has that name, else zero."""

    columns: np.ndarray
    places: np.ndarray  # of each row's names among the features; ``n`` if it has none
    n: int

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.columns), self.columns.shape[1] + self.n

    def __len__(self) -> int:
        return len(self.columns)

    def __getitem__(self, rows) -> Named:
        return Named(self.columns[rows], self.places[rows], self.n)

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        k = self.columns.shape[1]
        return self.columns @ w[:k] + np.append(w[k:], 0.0)[self.places].sum(axis=1)

    def back(self, v: np.ndarray) -> np.ndarray:
        """The transpose times ``v``."""
        sums = np.bincount(self.places.ravel(), np.repeat(v, self.places.shape[1]), self.n + 1)
        return np.append(self.columns.T @ v, sums[: self.n])

    def squares(self, v: np.ndarray) -> np.ndarray:
        """The transpose of the squared features times ``v``."""
        return Named(self.columns**2, self.places, self.n).back(v)

    def dense(self) -> np.ndarray:
        one = np.zeros((len(self), self.n + 1))
        np.put_along_axis(one, self.places, 1.0, axis=1)
        return np.hstack([self.columns, one[:, : self.n]])


def _stacked(a, b):
    if isinstance(a, Named):
        return Named(np.vstack([a.columns, b.columns]), np.vstack([a.places, b.places]), a.n)
    return np.vstack([a, b])


@dataclass
class Encoding:
    """Numbers by their bin, names by their value; what training never saw has no feature."""

    edges: np.ndarray  # number x inner edge
    names: dict[tuple[int, str], int]

    @classmethod
    def of(cls, numbers: np.ndarray, names: Sequence[Sequence[str | None]]) -> Encoding:
        points = np.linspace(0, 1, BINS + 1)[1:-1]
        low = np.quantile(numbers, points, axis=0).T
        high = np.quantile(numbers, [0.95, 0.98, 0.99], axis=0).T
        seen = sorted({(k, v) for row in names for k, v in enumerate(row) if v is not None})
        return cls(np.hstack([low, high]), {key: i for i, key in enumerate(seen)})

    def views(self, numbers: np.ndarray, names) -> tuple[np.ndarray, Named]:
        """Text view and metadata view, a row per document. A number counts the edges it is beyond."""
        beyond = (numbers[:, :, None] > self.edges[None]).astype(np.float64)
        k, n = len(TEXT_VIEW), len(self.names)
        places = [[self.names.get(key, n) for key in enumerate(row)] for row in names]
        meta = Named(beyond[:, k:].reshape(len(numbers), -1), np.array(places, np.int64).reshape(len(numbers), -1), n)
        return beyond[:, :k].reshape(len(numbers), -1), meta


def _sigmoid(f):
    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def fit_logistic(x: np.ndarray | Named, y: np.ndarray, l2: float = 1.0, steps: int = 25) -> np.ndarray:
    """Newton steps on the penalised log loss; the last weight is the intercept."""
    if isinstance(x, Named):
        if x.shape[1] > DIRECT:
            return _fit_many(x, y, l2, steps)
        x = x.dense()
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fit_many(x: Named, y: np.ndarray, l2: float, steps: int) -> np.ndarray:
    """As ``fit_logistic``, without a matrix of all features: each step by conjugate gradients, with the
    diagonal as preconditioner."""
    x = Named(np.hstack([x.columns, np.ones((len(x), 1))]), x.places, x.n)  # the intercept before the names
    at = x.columns.shape[1] - 1
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), l2)
    ridge[at] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.back(p - y) + ridge * w
        weight = p * (1 - p)
        scale = x.squares(weight) + ridge + 1e-9
        step, left = np.zeros(len(w)), grad.copy()
        along = scaled = left / scale
        size = left @ scaled
        enough = 1e-20 * size
        for _ in range(len(w)):
            if size <= enough:
                break
            curve = x.back(weight * (x @ along)) + (ridge + 1e-9) * along
            by = size / (along @ curve)
            step, left = step + by * along, left - by * curve
            scaled = left / scale
            size, before = left @ scaled, size
            along = scaled + size / before * along
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return np.append(np.delete(w, at), w[at])


def _log_odds(x: np.ndarray | Named, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


@dataclass
class QualityModel:
    encoding: Encoding | None
    weights: tuple[np.ndarray, np.ndarray]
    calibration: tuple[np.ndarray, np.ndarray]
    combination: np.ndarray
    constant: float = 0.5

    def score(self, numbers: Sequence[Sequence[float]], names) -> np.ndarray:
        if self.encoding is None:
            return np.full(len(numbers), self.constant)
        if not len(numbers):
            return np.zeros(0)
        views = self.encoding.views(np.array(numbers, np.float64), names)
        odds = [
            _log_odds(_log_odds(view, w)[:, None], c)
            for view, w, c in zip(views, self.weights, self.calibration, strict=True)
        ]
        return _sigmoid(_log_odds(np.stack(odds, axis=1), self.combination))


def co_train(
    labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS
) -> list[np.ndarray]:
    """Weights of both views after exchanging confident labels for ``rounds`` rounds."""
    own = [(labelled[v], y) for v in (0, 1)]
    free = np.ones((2, len(pool[0])), bool)  # not yet handed to view v
    weights = [fit_logistic(*own[v]) for v in (0, 1)]
    for _ in range(rounds):
        given = []
        for teacher, pupil in ((0, 1), (1, 0)):
            p = _sigmoid(_log_odds(pool[teacher], weights[teacher]))
            picked, label = [], []
            for value, sure, share in ((1, p, y.mean()), (0, 1 - p, 1 - y.mean())):
                order = np.argsort(-sure, kind="stable")
                order = order[(sure[order] >= CONFIDENT) & free[pupil][order]]
                order = order[: int(np.ceil(PER_ROUND * share * len(p)))]
                picked.append(order)
                label.append(np.full(len(order), value))
            given.append((pupil, np.concatenate(picked), np.concatenate(label)))
        for pupil, rows, label in given:
            free[pupil][rows] = False
            own[pupil] = (_stacked(own[pupil][0], pool[pupil][rows]), np.append(own[pupil][1], label))
        if not any(len(rows) for _, rows, _ in given):
            break
        weights = [fit_logistic(*own[v]) for v in (0, 1)]
    return weights


def train_quality(
    docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED
) -> QualityModel:
    """Labels of held-out rows are never looked at. Without labels of both kinds every score is the
    share of good labels, or one half."""
    order = F.xxhash64("doc_id")
    known = labels.filter(~held_out() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    there = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    ids = known.join(there, "doc_id", "left_semi").orderBy(order, "doc_id").limit(labelled)
    others = there.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(unlabelled)
    others = others.select("doc_id", F.lit(None).cast("int").alias("label"))
    ids = ids.unionByName(others)
    # Both samples are bounded by their parameters, one row for each id.
    sample = _described(_rows(docs).join(F.broadcast(ids), "doc_id").select(
        "doc_id", "text", "n_chars", "lang", "source", "label"
    ))
    view = ("numbers", "lang", "source")
    sample = sample.groupBy("doc_id", "label").agg(F.min_by(F.struct(*view), F.xxhash64(*view)).alias("view"))
    sample = sample.select("doc_id", "label", "view.*")
    rows = sample.withColumn("kept", F.crc32(F.concat(F.lit("c"), "doc_id").cast("binary")) % 4 == 0).collect()
    rows.sort(key=lambda r: (r.doc_id, r.label is None, r.numbers))
    with_label = [r for r in rows if r.label is not None]
    y = np.array([r.label for r in with_label], np.float64)
    kept = np.array([bool(r.kept) for r in with_label])
    if not len(y) or any(len(set(part)) < 2 for part in (y[kept], y[~kept])):
        share = float(y.mean()) if len(y) else 0.5
        return QualityModel(None, (), (), np.zeros(0), share)
    numbers = np.array([r.numbers for r in rows])
    encoding = Encoding.of(numbers, [(r.lang, r.source) for r in rows])

    def views(some):
        return encoding.views(np.array([r.numbers for r in some]), [(r.lang, r.source) for r in some])

    x, pool = views(with_label), [r for r in rows if r.label is None]
    pool = views(pool) if pool else tuple(v[:0] for v in x)
    weights = co_train(tuple(v[~kept] for v in x), y[~kept], pool)
    odds = [_log_odds(v[kept], w) for v, w in zip(x, weights, strict=True)]
    calibration = [fit_logistic(o[:, None], y[kept], l2=0.1) for o in odds]
    both = np.stack([_log_odds(o[:, None], c) for o, c in zip(odds, calibration, strict=True)], axis=1)
    return QualityModel(encoding, tuple(weights), tuple(calibration), fit_logistic(both, y[kept], l2=0.1))


def score_quality(docs: DataFrame, model: QualityModel, keep: float = KEEP) -> DataFrame:
    """Returns doc_id, held_out, score and keep of every row; null text and metadata are empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            scores = _scores(sent.value, *(b.column(i).to_pylist() for i in (1, 2, 3, 4)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(5), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"]
            )

    scored = _rows(docs, held_out().alias("held_out")).mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("keep", F.col("score") >= keep)


def _scores(model: QualityModel, texts, n_chars, langs, sources) -> np.ndarray:
    out = [np.zeros(0)]
    for i in range(0, len(texts), 1000):
        part = slice(i, i + 1000)
        numbers = [describe(t, n) for t, n in zip(texts[part], n_chars[part], strict=True)]
        out.append(model.score(numbers, list(zip(langs[part], sources[part], strict=True))))
    return np.concatenate(out)


def keep_good(docs: DataFrame, model: QualityModel, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that score at least ``keep``, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    def column(batch: pa.RecordBatch, name: str, kind) -> list:
        if name not in names:
            return [None] * batch.num_rows
        return batch.column(names.index(name)).cast(kind).to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            kinds = {"text": pa.string(), "n_chars": pa.int64(), "lang": pa.string(), "source": pa.string()}
            scores = _scores(sent.value, *(column(b, n, t) for n, t in kinds.items()))
            yield b.filter(pa.array(scores >= keep))

    return docs.mapInArrow(run, docs.schema)
