"""The global boosted-tree model: regularised trees on quantile-binned columns.

Every column is cut at its quantiles over all rows, so a row is a few bytes. The rows of a model are dealt by key to
members of bounded size; a member is one boosted fit in one task (``functions.histograms``), and the model's
forecast is the mean of its members. A model that fits into one member is a single boosted fit.
Members share nothing while they train: a round needs no exchange, a lost executor costs the members it
was fitting, and any number of models, such as those of all folds, train in the same job.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.constants import CV_SPLITS, PANEL_KEY, TARGET, TREE_SETTINGS
from shelfcast.functions.histograms import Forest, Settings, boost, tree_outputs
from shelfcast.functions.labels import absolute_percentage_error
from shelfcast.functions.shipping import ship_by_value
from shelfcast.operators.design import existing, fold_starts, with_test_fold
from shelfcast.schemas import IMPORTANCE
from shelfcast.sources.staging import stage

ship_by_value(__name__)

MEMBER_ROWS = 100_000  # a model of more rows has more members
MEMBERS = 64  # most of a model; beyond, members grow
LARGEST_MEMBER = 4_000_000  # rows; a model is fitted on at most MEMBERS times as many, chosen by key
FIT_TASKS = 64
SCORED = 4096
#: A forest's arrays in bytes, in the order of its fields.
KINDS = {"feature": "<i2", "cut": "u1", "value": "<f8", "gain": "<f8"}
MEMBER = "model int, member int, base double, feature binary, cut binary, value binary, gain binary"


@dataclass(frozen=True)
class Model:
    """Members of one model, with the names and cuts of their columns."""

    columns: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    settings: Settings
    forests: tuple[Forest, ...]

    def binned(self, values: np.ndarray) -> np.ndarray:
        """Bins (columns x rows) of raw inputs (columns x rows); a missing one counts as 0."""
        return _binned(values, self.edges)

    def outputs(self, binned: np.ndarray) -> Iterator[np.ndarray]:
        """The forecast after no round, one round, two rounds ... of the members' mean."""
        total = np.full(binned.shape[1], np.mean([f.base for f in self.forests]))
        yield total
        for turn in range(self.settings.rounds):
            for forest in self.forests:
                step = tree_outputs(
                    binned, forest.feature[turn], forest.cut[turn], forest.value[turn], self.settings.depth
                )
                total = total + step / len(self.forests)
            yield total

    def forecast(self, binned: np.ndarray) -> np.ndarray:
        for total in self.outputs(binned):
            pass
        return total

    def save(self, spark: SparkSession, path: str) -> None:
        """Three small tables: settings, inputs with their cuts, members with their trees."""
        told = {
            "settings": ([(json.dumps(asdict(self.settings)),)], "settings string"),
            "inputs": (
                [(i, c, e.tolist()) for i, (c, e) in enumerate(zip(self.columns, self.edges))],
                "place int, name string, edges array<double>",
            ),
            "members": ([(0, i, *_content(f)) for i, f in enumerate(self.forests)], MEMBER),
        }
        for name, (rows, schema) in told.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}")


def _content(forest: Forest) -> tuple:
    return forest.base, *(getattr(forest, n).astype(kind).tobytes() for n, kind in KINDS.items())


def _forest(row) -> Forest:
    parts = {n: np.frombuffer(row[n], kind) for n, kind in KINDS.items()}
    nodes = (2 << row["depth"]) - 1
    return Forest(row["base"], *(part.reshape(-1, nodes) for part in parts.values()))


def load_trees(spark: SparkSession, path: str) -> Model:
    """A model written by ``save``; at most MEMBERS rows."""
    settings = Settings(**json.loads(spark.read.parquet(f"{path}/settings").first()["settings"]))
    inputs = sorted(spark.read.parquet(f"{path}/inputs").collect(), key=lambda r: r["place"])
    members = sorted(spark.read.parquet(f"{path}/members").collect(), key=lambda r: r["member"])
    return Model(
        tuple(r["name"] for r in inputs), tuple(np.array(r["edges"], float) for r in inputs), settings,
        tuple(_forest(r.asDict() | {"depth": settings.depth}) for r in members),
    )


def _binned(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    filled = np.nan_to_num(values, nan=0.0, posinf=np.inf, neginf=-np.inf)
    return np.stack([np.searchsorted(e, row).astype(np.uint8) for e, row in zip(edges, filled, strict=True)])


def _inputs(columns: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"in_{c}") for c in columns]


def column_edges(matrix: DataFrame, columns: Sequence[str], bins: int) -> tuple[np.ndarray, ...]:
    """Cuts between the bins of each column: its distinct approximate quantiles, from one mergeable sketch per column."""
    shares = [i / bins for i in range(1, bins)]
    row = matrix.select(*_inputs(columns)).agg(
        *[F.percentile_approx(f"in_{c}", shares, 100 * bins).alias(f"q_{i}") for i, c in enumerate(columns)]
    ).first()
    return tuple(np.unique(np.array(row[f"q_{i}"] or [], float)) for i in range(len(columns)))


def _key(rows: DataFrame) -> Column:
    return F.xxhash64(F.lit(TREE_SETTINGS["seed"]), *[c for c in PANEL_KEY if c in rows.columns], TARGET)


def train_models(
    matrix: DataFrame, columns: Sequence[str], models: Mapping[str, Column], **overrides
) -> dict[str, Model]:
    """Fit several models at once, each on the rows its condition selects.

    ``matrix`` must hold no NULL inputs (see training_matrix). The bins are cut over all of its rows. Rows are
    dealt to members by a hash of their key, and sorted by it there, so a model depends on neither
    the layout of the table nor the number of tasks.
    """
    settings = Settings(**{**TREE_SETTINGS, **overrides})
    kept = matrix.select(
        *_inputs(existing(matrix, columns)), F.col(TARGET).cast("double").alias("_actual"), _key(matrix).alias("_key"),
        *[F.coalesce(condition, F.lit(False)).alias(f"_model_{i}") for i, condition in enumerate(models.values())],
    )
    edges = column_edges(matrix, columns, settings.bins)
    counted = kept.agg(*[F.count_if(f"_model_{i}").alias(f"n_{i}") for i in range(len(models))]).first()
    shape = {}
    for i in range(len(models)):
        members = min(MEMBERS, max(1, -(-counted[f"n_{i}"] // MEMBER_ROWS)))
        shape[i] = (members, min(1.0, members * LARGEST_MEMBER / max(1, counted[f"n_{i}"])))
    inside = len(columns)
    names = [field.split()[0] for field in MEMBER.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(model, member, key, actual, bins) of every row of every model."""
        for batch in batches:
            values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(inside)])
            content = np.ascontiguousarray(_binned(values, edges).T)
            key = batch.column(inside + 1).to_numpy()
            unsigned = key.view(np.uint64)
            for i, (members, share) in shape.items():
                own = batch.column(inside + 2 + i).to_numpy(zero_copy_only=False).astype(bool)
                if share < 1:
                    own &= (unsigned >> np.uint64(32)) < np.uint64(share * 2**32)
                rows = np.flatnonzero(own)
                bins = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(inside), len(rows), [None, pa.py_buffer(content[rows].tobytes())]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), i, np.int32)),
                        pa.array((unsigned[rows] % np.uint64(members)).astype(np.int32)),
                        pa.array(key[rows]), batch.column(inside).take(pa.array(rows)), bins,
                    ],
                    ["model", "member", "key", "actual", "bins"],
                )

    def fit(rows: pa.Table) -> pa.Table:
        order = np.lexsort((rows["actual"].to_numpy(), rows["key"].to_numpy()))
        raw = np.frombuffer(b"".join(rows["bins"].to_pylist()), np.uint8).reshape(len(rows), inside)
        model, member = rows["model"][0].as_py(), rows["member"][0].as_py()
        forest = boost(np.ascontiguousarray(raw[order].T), rows["actual"].to_numpy()[order], settings, member)
        told = (pa.array([model], pa.int32()), pa.array([member], pa.int32()), *([x] for x in _content(forest)))
        return pa.table(dict(zip(names, told, strict=True)))

    packed = kept.mapInArrow(pack, "model int, member int, key long, actual double, bins binary")
    # Dealt by number, as adaptive execution would put small members behind each other in one task.
    tasks = packed.repartition(FIT_TASKS, "model", "member").groupBy("model", "member")
    fitted = tasks.applyInArrow(fit, MEMBER)
    found: dict[int, dict[int, Forest]] = {}
    for row in stage(fitted, "members").collect():  # at most MEMBERS per model
        forest = _forest(row.asDict() | {"depth": settings.depth})
        found.setdefault(row["model"], {})[row["member"]] = forest
    nothing = boost(np.zeros((inside, 0), np.uint8), np.zeros(0), settings)
    return {
        name: Model(
            tuple(columns), edges, settings, tuple(f for _, f in sorted(found.get(i, {0: nothing}).items()))
        )
        for i, name in enumerate(models)
    }


def train_trees(matrix: DataFrame, columns: Sequence[str], **overrides) -> Model:
    """Fit one model on every row of ``matrix``."""
    return train_models(matrix, columns, {"all": F.lit(True)}, **overrides)["all"]


def predict(df: DataFrame, model: Model, out: str = "xgb_forecast") -> DataFrame:
    """Forecast of every row, clipped at zero; NULL inputs count as 0. The model, at most MEMBERS forests of about a
    megabyte each, travels with the task."""
    @F.pandas_udf("double")
    def forecast(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            values = np.stack([c.to_numpy(float) for c in columns])
            parts = [
                model.forecast(model.binned(values[:, low : low + SCORED])) for low in range(0, values.shape[1], SCORED)
            ]
            yield pd.Series(np.maximum(np.concatenate([*parts, np.empty(0)]), 0.0))

    return df.withColumn(out, forecast(*_inputs(model.columns)))


def feature_importance(spark: SparkSession, model: Model) -> DataFrame:
    """Mean gain of each input's cuts over all trees, as shares that add up to 1, most important first."""
    gain, cuts = np.zeros(len(model.columns)), np.zeros(len(model.columns))
    for forest in model.forests:
        inner = forest.feature >= 0
        np.add.at(gain, forest.feature[inner], forest.gain[inner])
        np.add.at(cuts, forest.feature[inner], 1)
    mean = gain / np.maximum(cuts, 1)
    shares = mean / mean.sum() if mean.sum() else mean
    table = spark.createDataFrame(list(zip(model.columns, shares.tolist())), IMPORTANCE)
    return table.orderBy(F.desc("importance"), "feature")


def fold_scores(
    matrix: DataFrame, columns: Sequence[str], n_splits: int = CV_SPLITS, **overrides
) -> DataFrame:
    """(fold, rounds, mape, n_rows): the error on each expanding-window test fold after every round.

    All folds train in one job on rows binned once; fold i is fitted on the rows of earlier folds. The test
    rows are then scored tree by tree, and a task adds up the errors of a round. ``mape`` is NULL where a
    fold has no positive actual.
    """
    folded = with_test_fold(matrix, fold_starts(matrix, n_splits))
    fold = F.col("test_fold")
    models = train_models(folded, columns, {str(i): fold < i for i in range(1, n_splits + 1)}, **overrides)
    rounds = Settings(**{**TREE_SETTINGS, **overrides}).rounds

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {i: np.zeros(rounds + 1) for i in range(1, n_splits + 1)}
        counts = dict.fromkeys(sums, 0)
        for batch in batches:
            held = batch.column(0).to_numpy()
            actual = batch.column(1).to_numpy()
            values = np.stack([batch.column(2 + c).to_numpy() for c in range(len(columns))])
            for i in sums:
                rows = np.flatnonzero((held == i) & (actual > 0))
                model, counts[i] = models[str(i)], counts[i] + len(rows)
                for turn, total in enumerate(model.outputs(model.binned(values[:, rows]))):
                    sums[i][turn] += (np.abs(actual[rows] - np.maximum(total, 0.0)) / actual[rows]).sum()
        for i, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rounds + 1, i, np.int32)), pa.array(np.arange(rounds + 1, dtype=np.int32)),
                    pa.array(total), pa.array(np.full(rounds + 1, counts[i])),
                ],
                ["fold", "rounds", "error", "n"],
            )

    tested = folded.where(fold > 0).select(
        fold.cast("int").alias("fold"), F.col(TARGET).cast("double").alias("actual"), *_inputs(columns)
    )
    told = tested.mapInArrow(errors, "fold int, rounds int, error double, n long").groupBy("fold", "rounds")
    summed = told.agg(F.sum("error").alias("_error"), F.sum("n").alias("n_rows"))
    return summed.where("rounds > 0").select(
        "fold", "rounds", F.expr("_error / nullif(n_rows, 0)").alias("mape"), "n_rows"
    )


def cross_validate(
    matrix: DataFrame, columns: Sequence[str], n_splits: int = CV_SPLITS, **overrides
) -> list[float | None]:
    """MAPE of each expanding-window fold; None where a fold has no positive actual."""
    scores = fold_scores(matrix, columns, n_splits, **overrides)
    last = scores.groupBy("fold").agg(F.max_by("mape", "rounds").alias("mape")).collect()
    return [row["mape"] for row in sorted(last, key=lambda row: row["fold"])]


def mean_score(scores: Sequence[float | None]) -> float | None:
    known = [s for s in scores if s is not None]
    return sum(known) / len(known) if known else None


def stumps(matrix: DataFrame, columns: Sequence[str], **overrides) -> DataFrame:
    """(feature, cut, gain, left_weight, right_weight, n_left, n_right): the best single cut of every input with few
    distinct values, as a boosted fit would choose it for its first node; rows up to ``cut`` go left. An
    input without an allowed cut has no row.

    Histograms of gradient sums and counts per value, added up by Spark over all rows; ties go to the smaller cut.
    """
    own = Settings(**{**TREE_SETTINGS, **overrides})
    mean = matrix.agg(F.avg(F.col(TARGET).cast("double"))).scalar()
    inputs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("cut")) for c in columns])
    )
    values = matrix.select((mean - F.col(TARGET)).alias("g"), inputs.alias("i")).select("g", "i.*")
    bins = values.groupBy("feature", "cut").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy("feature").orderBy("cut")
    sides = bins.select(
        "feature", "cut",
        F.sum("g").over(up_to).alias("gl"), F.sum("n").over(up_to).alias("n_left"),
        F.sum("g").over(Window.partitionBy("feature")).alias("ga"),
        F.sum("n").over(Window.partitionBy("feature")).alias("na"),
    ).withColumns({"gr": F.col("ga") - F.col("gl"), "n_right": F.col("na") - F.col("n_left")})

    def soft(g: str) -> Column:
        return F.signum(g) * F.greatest(F.abs(g) - own.l1, F.lit(0.0))

    def gain(g: str, n: str) -> Column:
        return F.pow(soft(g), 2) / (F.col(n) + own.l2)

    cuts = sides.withColumn("gain", gain("gl", "n_left") + gain("gr", "n_right") - gain("ga", "na")).where(
        (F.col("n_left") >= own.least_weight) & (F.col("n_right") >= own.least_weight)
    )
    best = Window.partitionBy("feature").orderBy(F.desc(F.round("gain", 6)), "cut")
    return cuts.withColumn("_place", F.row_number().over(best)).where("_place = 1").select(
        "feature", "cut", "gain",
        (-soft("gl") / (F.col("n_left") + own.l2)).alias("left_weight"),
        (-soft("gr") / (F.col("n_right") + own.l2)).alias("right_weight"),
        "n_left", "n_right",
    )
