"""Quality classifier: random Fourier features over document statistics, ridge regression from
partition-summed normal equations, isotonic calibration of out-of-fold scores.

Statistics are taken from whole texts in one pass and written (16 numbers a document). The labelled
rows become sums of outer products per partition and fold; a fold's scores come from the weights
fitted on the other folds, and their isotonic regression on the labels maps scores to [0, 1].
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.frames import Staged, text_marks
from shelfcast.llm.tokens import arrow_texts

STATISTICS = (
    "log_words", "log_bytes", "word_length", "distinct_words", "top_word", "repeated_neighbour",
    "upper", "digits", "stops", "bars", "marks", "not_ascii", "lines", "repeated_lines",
    "short_words", "long_words",
)
FEATURES = 256
FOLDS = 4
SUMMING_PARTITIONS = 16
MAX_LABELLED = 2_000_000
RIDGE = 1e-3
BINS = 2048


def _class(characters: bytes) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(characters)] = 1
    return mask


_CLASSES = np.stack([
    _class(bytes(range(65, 91))),
    _class(b"0123456789"),
    _class(b".,;:?"),
    _class(b"|"),
    _class(b"!#$%&*+<=>@^_~{}[]\\/"),
    _class(bytes(range(128, 256))),
])


def statistics(text: str) -> list[float]:
    """The numbers of STATISTICS for one whole text; all are finite, also for an empty text."""
    raw = text.encode()
    words, lines = raw.split(), raw.splitlines()
    n, size = max(1, len(words)), max(1, len(raw))
    shares = _CLASSES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / size
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    same = sum(map(bytes.__eq__, words[1:], words[:-1]))
    return [
        np.log1p(len(words)),
        np.log1p(len(raw)),
        np.log1p(lengths.sum() / n),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        same / n,
        *shares.tolist(),
        np.log1p(len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        float((lengths <= 3).sum()) / n,
        float((lengths > 12).sum()) / n,
    ]


def document_statistics(documents: DataFrame, key: str, text: str, marks: Sequence[Column] = ()) -> DataFrame:
    named = [f"h{i}" for i in range(len(marks))]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in arrow_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64())), *batch.columns[2:]],
                ["doc_id", "stats", *named],
            )

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *marks)
    return rows.mapInArrow(measure, ", ".join(["doc_id long, stats array<double>", *(f"{c} long" for c in named)]))


def remainder(key: str) -> Column:
    """crc32 of the key as text, modulo 5; 0 (never learned from) for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5, F.lit(0))


@dataclass(frozen=True)
class Model:
    """Everything a score needs: a few arrays of fixed size."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray  # of the model on all folds
    knots: np.ndarray  # raw scores, rising
    values: np.ndarray  # calibrated, not falling

    def expand(self, stats: np.ndarray) -> np.ndarray:
        z = (stats - self.mean) / self.scale
        waves = np.cos(np.clip(z, -6, 6) @ self.directions + self.phases)
        return np.hstack([waves * np.sqrt(2 / FEATURES), np.ones((len(z), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.expand(stats) @ self.weights
        return np.clip(np.interp(raw, self.knots, self.values), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def _normal_sums(labelled: DataFrame, model: Model) -> dict[int, np.ndarray]:
    """fold -> [Z'Z | Z'y]; every partition adds up its own rows, at most SUMMING_PARTITIONS times
    FOLDS matrices of fixed size reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = FEATURES + 1
        sums = {}
        for batch in batches:
            z = model.expand(_matrix(batch.column("stats")))
            y = batch.column("y").to_numpy()
            fold = batch.column("fold").to_numpy()
            for f in np.unique(fold):
                own = z[fold == f]
                total = sums.setdefault(int(f), np.zeros((width, width + 1)))
                total += own.T @ np.column_stack([own, y[fold == f]])
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()])],
                ["fold", "sums"],
            )

    totals: dict[int, np.ndarray] = {}
    for fold, blob in labelled.mapInArrow(add, "fold int, sums binary").toLocalIterator():
        total = np.frombuffer(blob).reshape(FEATURES + 1, FEATURES + 2)
        totals[fold] = totals.get(fold, 0) + total
    return totals


def _solve(sums: np.ndarray) -> np.ndarray:
    gram, right = sums[:, :-1], sums[:, -1]
    rows = max(1.0, gram[-1, -1])
    penalty = np.full(len(gram), RIDGE * rows)
    penalty[-1] = 1e-9 * rows
    return np.linalg.solve(gram + np.diag(penalty), right)


def pool_adjacent(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic least squares over points in rising ``x``: block means of x and of y."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x, y, weight, strict=True):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    means = np.array(blocks)
    return means[:, 0] / means[:, 2], means[:, 1] / means[:, 2]


def _calibrate(labelled: DataFrame, model: Model, by_fold: dict[int, np.ndarray]) -> Model:
    """Isotonic regression of the labels on out-of-fold scores, over at most BINS score bins."""

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = model.expand(_matrix(batch.column("stats")))
            fold = batch.column("fold").to_numpy()
            raw = np.zeros(len(fold))
            for f, weights in by_fold.items():
                raw[fold == f] = z[fold == f] @ weights
            bins = np.floor(np.clip(raw + 0.5, 0, 2 - 1e-9) * (BINS / 2)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins), pa.array(raw), batch.column("y")], ["bin", "raw", "y"]
            )

    bins = (
        labelled.mapInArrow(held_out, "bin int, raw double, y double")
        .groupBy("bin")
        .agg(F.sum("raw").alias("raw"), F.sum("y").alias("y"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    table = np.array(sorted((r.raw / r.n, r.y / r.n, float(r.n)) for r in bins))
    knots, values = pool_adjacent(*table.T)
    return Model(model.mean, model.scale, model.directions, model.phases, model.weights, knots, values)


def fit(labelled: DataFrame, seed: int = 11) -> Model:
    """Model from (stats, y in [0, 1], fold in 1..FOLDS). Without rows every score is 0.5."""
    width = len(STATISTICS)
    source = np.random.default_rng(seed)
    directions = source.normal(size=(width, FEATURES)) / np.sqrt(width)
    phases = source.uniform(0, 2 * np.pi, FEATURES)
    moments = labelled.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(width)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(width)],
    ).first()
    if not moments["n"]:
        zero = np.zeros(width)
        return Model(
            zero, zero + 1, directions, phases, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5)
        )
    mean = np.array([moments[f"m{i}"] for i in range(width)])
    scale = np.array([max(moments[f"s{i}"], 1e-3) for i in range(width)])
    model = Model(mean, scale, directions, phases, np.zeros(1), np.zeros(1), np.zeros(1))
    sums = _normal_sums(labelled, model)
    total = sum(sums.values())
    others = {f: _solve(total - s) if len(sums) > 1 else _solve(total) for f, s in sums.items()}
    model = Model(mean, scale, directions, phases, _solve(total), np.zeros(1), np.zeros(1))
    return _calibrate(labelled, model, others)


def quality_scores(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_labelled: int = MAX_LABELLED,
    marked: bool = False,
) -> DataFrame:
    """(key, held_out, score) of every row of ``documents``; ``marked`` adds its text marks h0 and h1.

    Labels are learned only from rows whose crc32(key as text) mod 5 is not 0; ``held_out`` marks
    the others, and rows with a null key. Beyond ``max_labelled`` learned rows the fit takes a hashed
    sample of about that size. Several labels of one key are averaged, null labels and keys are left
    out. A null text counts as empty and is scored like any other. Without labels all scores are
    0.5. Repeated rows are scored each; other columns are not read.
    """
    marks = text_marks(text) if marked else []
    measured = Staged(document_statistics(documents, key, text, marks), "statistics")
    carried = [c for c in ("h0", "h1") if marked]
    known_labels = (
        labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
        .where("doc_id is not null and y is not null")
        .groupBy("doc_id")
        .agg(F.avg("y").alias("y"))
        .withColumn("fold", remainder("doc_id").cast("int"))
        .where("fold > 0")
    )
    known = Staged(measured.rows.join(known_labels, "doc_id").select("doc_id", "stats", "y", "fold"), "labelled")
    n = known.rows.count()
    sample = known.rows
    if n > max_labelled:
        share = int(max_labelled / n * (1 << 20))
        sample = sample.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)
    model = fit(sample.repartition(SUMMING_PARTITIONS, F.xxhash64("doc_id")).select("stats", "y", "fold"))
    known.drop()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_matrix(batch.column("stats")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), *(batch.column(c) for c in carried)],
                ["doc_id", "score", *carried],
            )

    kind = ", ".join(["doc_id long, score double", *(f"{c} long" for c in carried)])
    scored = measured.rows.mapInArrow(score, kind)
    return scored.select(
        F.col("doc_id").alias(key), (remainder("doc_id") == 0).alias("held_out"), "score", *carried
    )
