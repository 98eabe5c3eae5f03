"""Quality classifier by co-training of two views.

The *text view* sees what is written (shape statistics of the whole text), the
*metadata view* only the row's other columns (language, source, length).  Each
is a logistic regression.  In every round each view's confident verdicts on
unlabelled documents become training labels for the *other* view; what is confident
goes by the view's own scores too, so that a weak view teaches as well.  At the end a
small logistic regression on held-out labels calibrates and combines the views'
logits, and all documents are scored.

Each Newton step is one Spark job over the feature table: tasks add up gradient
and Hessian of both views, so that all labelled rows and all pseudo-labelled
rows count, and only matrices of the number of features reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import materialise

FLOATS = pa.list_(pa.float32())
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_DIGIT, _SPACE = b"0123456789", b" \t\n\r\x0b\x0c"
_END, _PAUSE = b".?!", b",;:'\"()-"
_MARK = bytes(b for b in range(33, 127) if b not in _UPPER + _LOWER + _DIGIT + _END + _PAUSE)
TEXT_FEATURES = 18
#: Hash slots of the metadata view's categories (language, source).
SLOTS = 32
META_FEATURES = 3 + SLOTS
HELD_OUT = 5  # one labelled row in so many, by hash, is kept for calibration
#: Steps of a view's logit in -LOGITS..LOGITS in the histogram of its verdicts.
LOGITS, PER_LOGIT = 16, 256
LOGIT_BINS = 2 * LOGITS * PER_LOGIT


def _compressed(b: bytes, piece: int = 1 << 20) -> int:
    """Length of all of ``b`` compressed as one stream, piece by piece: only the output
    of one piece is held at a time."""
    z, view = zlib.compressobj(1), memoryview(b)
    return sum(len(z.compress(view[i:i + piece])) for i in range(0, len(b), piece)) + len(z.flush())


def text_features(text: str | None) -> list[float]:
    """Shares and means over the whole text; all zero but the first for an empty one."""
    b = (text or "").encode("utf-8", "surrogatepass")
    words = b.split()
    if not words:
        return [1.0] + [0.0] * (TEXT_FEATURES - 1)
    n, k = len(b), len(words)

    def share(chars: bytes) -> float:
        return (n - len(b.translate(None, chars))) / n

    lengths = np.fromiter(map(len, words), np.int64, k)
    distinct = len(set(words))
    lines = [x for x in b.split(b"\n") if x.strip()]
    bare = sum(1 for w in words if not w.strip(_MARK))
    marked = sum(1 for w in words if w[-1] in _MARK)
    pairs = len(set(zip(words, words[1:])))
    packed = _compressed(b) / n if n > 64 else 0.6
    return [0.0, share(_UPPER), share(_LOWER), share(_DIGIT), share(_SPACE), share(_END),
            share(_PAUSE), share(_MARK), float(lengths.mean()) / 10, float(lengths.std()) / 10,
            float(lengths.max() > 60), distinct / k, pairs / max(1, k - 1),
            len(set(lines)) / max(1, len(lines)), bare / k, marked / k,
            sum(1 for w in words if w.isupper()) / k, packed]


def meta_features(lang, source, n_chars) -> list[float]:
    """Length and hashed categories; nulls are a category of their own."""
    slots = [0.0] * SLOTS
    for kind, value in (("lang", lang), ("source", source)):
        slots[zlib.crc32(f"{kind}={value}".encode("utf-8", "surrogatepass")) % SLOTS] += 1.0
    n = 0.0 if n_chars is None or n_chars != n_chars else max(0.0, float(n_chars))
    return [float(n == 0), np.log1p(n) / 10, (np.log1p(n) / 10) ** 2, *slots]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             meta_cols: tuple[str, str, str] = ("lang", "source", "n_chars")) -> DataFrame:
    """``(doc_id, ft, fm)``; a metadata column that ``docs`` lacks counts as null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, text, *meta = b.columns
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([text_features(t) for t in text.to_pylist()], FLOATS),
                 pa.array([meta_features(*m) for m in zip(*(c.to_pylist() for c in meta))], FLOATS)],
                names=["doc_id", "ft", "fm"])

    metas = [(F.col(c) if c in docs.columns else F.lit(None)).cast(kind).alias(name)
             for c, name, kind in zip(meta_cols, ("lang", "source", "n_chars"),
                                      ("string", "string", "double"))]
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.col(text_col).alias("text"), *metas)
            .mapInArrow(run, "doc_id bigint, ft array<float>, fm array<float>"))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class CoTrained:
    """Weights of the two views (bias first) and of their combination."""
    text: np.ndarray
    meta: np.ndarray
    combine: np.ndarray  # bias, text logit, metadata logit
    threshold: float = 0.5
    #: Pseudo-labels given: (round, view, good, bad), view by view.
    given: list[tuple[int, str, int, int]] = field(default_factory=list)

    def logits(self, ft: np.ndarray, fm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return ft @ self.text[1:] + self.text[0], fm @ self.meta[1:] + self.meta[0]

    def score(self, ft: np.ndarray, fm: np.ndarray) -> np.ndarray:
        zt, zm = (np.clip(z, -12, 12) for z in self.logits(ft, fm))
        return _sigmoid(self.combine[0] + self.combine[1] * zt + self.combine[2] * zm)


def _arrays(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return (np.array(b["ft"].tolist(), np.float64).reshape(len(b), -1),
            np.array(b["fm"].tolist(), np.float64).reshape(len(b), -1))


def _sum_arrays(df: DataFrame, step, size: int) -> np.ndarray:
    """Sums over all partitions of the vectors that ``step`` makes of a batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for b in batches:
            if len(b):
                total += step(b)
        yield pd.DataFrame({"v": [total]})

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for b in batches:
            for v in b["v"]:
                total += v
        yield pd.DataFrame({"v": [total]})

    parts = df.mapInPandas(run, "v array<double>")
    # partial sums, a row a task, are folded in tasks, so few vectors reach the driver; they
    # are shuffled for it, as a narrow step would leave the sums themselves to 16 tasks
    rows = parts.repartition(16).mapInPandas(fold, "v array<double>").collect()
    return np.sum([np.array(r.v) for r in rows] or [np.zeros(size)], axis=0)


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    p = _sigmoid(x @ w)
    h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
    return np.concatenate([(x.T @ (weight * (y - p))), h.ravel()])


def _solve(sums: np.ndarray, w: np.ndarray, ridge: float) -> np.ndarray:
    d = len(w)
    penalty = np.full(d, ridge)
    penalty[0] = 1e-6
    g, h = sums[:d] - penalty * w, sums[d:].reshape(d, d) + np.diag(penalty)
    step = np.linalg.solve(h, g)
    return w + step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))


def _bin(z: np.ndarray) -> np.ndarray:
    return np.clip((z + LOGITS) * PER_LOGIT, 0, LOGIT_BINS - 1).astype(int)


def _cuts(counts: np.ndarray, good: float, extreme: float, confident: float) -> tuple[int, ...]:
    """Bins of a view's logits that bound its confident verdicts: (low, high, surely bad,
    surely good).  ``counts`` has all unlabelled rows; ``low`` and ``high`` enclose what
    is not among the ``extreme`` share of them, of which ``good`` is to be good.  Rows of
    one bin go together; scores too much alike for both ends give no low and high."""
    total, sure = counts.sum(), int(_bin(np.log(confident / (1 - confident))))
    low = int(np.searchsorted(np.cumsum(counts), max(1.0, extreme * total * (1 - good))))
    high = LOGIT_BINS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), max(1.0, extreme * total * good)))
    if low >= high:
        low, high = -1, LOGIT_BINS
    return low, high, LOGIT_BINS - 1 - sure, sure


def _verdicts(at: np.ndarray, cuts: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are confidently good, and which bad."""
    low, high, bad, good = cuts
    return (at >= high) | ((at >= good) & (at > low)), (at <= low) | ((at <= bad) & (at < high))


def co_train(feats: DataFrame, labels: DataFrame, rounds: int = 3, steps: int = 4,
             confident: float = 0.97, pseudo_weight: float = 0.5, keep_good: float = 0.995,
             extreme: float = 0.05,
             ridge: float = 1.0, id_col: str = "doc_id", label_col: str = "quality") -> CoTrained:
    """Fits both views on ``labels`` (1 good, 0 bad; one label per document: the
    lowest of repeated ones; nulls ignored), exchanging pseudo-labels in ``rounds``.

    A view's verdict on an unlabelled document is confident when its probability is
    ``confident`` or more, for either class, or its score is among the view's most
    extreme: a share ``extreme`` of all unlabelled documents, dealt to the classes as
    the labels are.  The pseudo-labels of a view weigh, class by class,
    ``pseudo_weight`` times the true ones at most.  Without labels, or with one class
    only, the model scores everything alike and rejects nothing.
    """
    label = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("bigint").alias("_id"))
             .agg(F.min(F.col(label_col)).cast("double").alias("y")))
    rows = materialise(feats.join(label, F.col("doc_id") == F.col("_id"), "left")
                       .select("ft", "fm", "y", (F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0)
                               .alias("held")), "quality-features")
    dt, dm = TEXT_FEATURES + 1, META_FEATURES + 1
    model = CoTrained(np.zeros(dt), np.zeros(dm), np.array([0.0, 1.0, 1.0]))
    nt, nm = dt + dt * dt, dm + dm * dm
    seen = rows.where("y is not null").groupBy((F.col("y") > 0).alias("g")).count().collect()
    if len(seen) < 2:
        return CoTrained(model.text, model.meta, np.zeros(3), threshold=0.0)

    given = []
    for r in range(rounds + 1):
        teacher, cuts = CoTrained(model.text, model.meta, model.combine), None
        scale = np.zeros((2, 2))  # of the pseudo-labels for each view: good, bad
        if r > 0:
            def count(b: pd.DataFrame, teacher=teacher) -> np.ndarray:
                y = b["y"].to_numpy(np.float64)
                mine = y[~b["held"].to_numpy(bool)]
                return np.concatenate([[(mine > 0).sum(), (mine <= 0).sum()], *[
                    np.bincount(_bin(z[np.isnan(y)]), minlength=LOGIT_BINS)
                    for z in teacher.logits(*_arrays(b))]]).astype(float)

            sums = _sum_arrays(rows, count, 2 + 2 * LOGIT_BINS)
            true, counts = sums[:2], sums[2:].reshape(2, LOGIT_BINS)
            cuts = [_cuts(c, true[0] / max(1.0, true.sum()), extreme, confident) for c in counts]
            gave = np.array([[c[v].sum() for v in _verdicts(np.arange(LOGIT_BINS), k)]
                             for c, k in zip(counts, cuts)])
            given += [(r, view, int(g), int(b)) for view, (g, b) in zip(("text", "meta"), gave)]
            scale = np.minimum(1.0, pseudo_weight * true / np.maximum(1.0, gave[::-1]))

        def weighted(b: pd.DataFrame, teacher=teacher, cuts=cuts, scale=scale):
            """Labels and weights, true or pseudo, for the text and the metadata view."""
            ft, fm = _arrays(b)
            y = b["y"].to_numpy(np.float64)
            true = ~np.isnan(y) & ~b["held"].to_numpy(bool)
            out = [(np.nan_to_num(y), true.astype(float)) for _ in range(2)]
            if cuts:
                out = []
                # the other view's verdicts
                for z, c, s in zip(reversed(teacher.logits(ft, fm)), reversed(cuts), scale):
                    good, bad = (v & np.isnan(y) for v in _verdicts(_bin(z), c))
                    out.append((np.where(true, np.nan_to_num(y), good),
                                np.where(true, 1.0, s[0] * good + s[1] * bad)))
            return ft, fm, out

        for _ in range(steps + 2 * (r == 0)):
            wt, wm = model.text, model.meta

            def gradient(b: pd.DataFrame, wt=wt, wm=wm, weighted=weighted) -> np.ndarray:
                ft, fm, views = weighted(b)
                out = []
                for x, w, (y, weight) in zip((ft, fm), (wt, wm), views):
                    use = weight > 0
                    out.append(_newton(x[use], y[use].astype(float), weight[use], w))
                return np.concatenate(out)

            sums = _sum_arrays(rows, gradient, nt + nm)
            model = CoTrained(_solve(sums[:nt], wt, ridge), _solve(sums[nt:], wm, ridge),
                              model.combine)

    held = rows.where("held and y is not null")
    combine = np.array([0.0, 1.0, 0.0])
    for _ in range(steps + 2):
        def calibrate(b: pd.DataFrame, model=model, combine=combine) -> np.ndarray:
            zt, zm = (np.clip(z, -12, 12) for z in model.logits(*_arrays(b)))
            return _newton(np.column_stack([zt, zm]), b["y"].to_numpy(float), np.ones(len(b)), combine)

        combine = _solve(_sum_arrays(held, calibrate, 3 + 9), combine, 0.1)
    model = CoTrained(model.text, model.meta, combine, given=given)

    # the threshold: where the most bad held-out rows go while ``keep_good`` of the good stay
    bins = 1000

    def histogram(b: pd.DataFrame) -> np.ndarray:
        at = np.minimum((model.score(*_arrays(b)) * bins).astype(int), bins - 1)
        good = b["y"].to_numpy(float) > 0
        return np.concatenate([np.bincount(at[good], minlength=bins),
                               np.bincount(at[~good], minlength=bins)]).astype(float)

    h = _sum_arrays(held, histogram, 2 * bins)
    lost = np.concatenate([[0.0], np.cumsum(h[:bins])]) / max(1.0, h[:bins].sum())
    caught = np.concatenate([[0.0], np.cumsum(h[bins:])]) / max(1.0, h[bins:].sum())
    allowed = np.nonzero(lost <= 1 - keep_good)[0]
    # of equally good cuts the middle one, so that neither class lies at the edge
    best = allowed[caught[allowed] - lost[allowed] >= (caught[allowed] - lost[allowed]).max() - 1e-12]
    model.threshold = float(min(0.5, np.median(best) / bins))
    return model


def score(feats: DataFrame, model: CoTrained) -> DataFrame:
    """``(doc_id, p_text, p_meta, quality_score, keep)`` for every row of ``feats``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ft, fm = (np.array(c.to_pylist(), float) for c in b.columns[1:])
                p = model.score(ft, fm)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *(pa.array(_sigmoid(z)) for z in model.logits(ft, fm)),
                     pa.array(p), pa.array(p >= model.threshold)],
                    names=["doc_id", "p_text", "p_meta", "quality_score", "keep"])

    return feats.select("doc_id", "ft", "fm").mapInArrow(
        run, "doc_id bigint, p_text double, p_meta double, quality_score double, keep boolean")


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Co-trains on ``labels`` and scores every row of ``docs`` (see ``score``): one
    row per input row, null and repeated ids included.  Null and empty texts have
    features of their own and are scored like any other.  Further columns of
    ``docs`` are not looked at; an empty table gives an empty table."""
    feats = materialise(features(docs), "quality-rows")
    return score(feats, co_train(feats, labels, **options))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that the classifier keeps, all columns as they are.  The
    features are made twice, once to fit and once to score: cheaper than moving
    the texts to meet their scores."""
    model = co_train(features(docs), labels, **options)
    at = {c: i for i, c in enumerate(docs.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            def col(name: str) -> list:
                return b.column(at[name]).to_pylist() if name in at else [None] * b.num_rows

            if b.num_rows:
                ft = np.array([text_features(t) for t in col("text")], np.float32)
                fm = np.array([meta_features(*m) for m in
                               zip(col("lang"), col("source"), col("n_chars"))], np.float32)
                kept = model.score(ft.astype(float), fm.astype(float)) >= model.threshold
                yield b.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
