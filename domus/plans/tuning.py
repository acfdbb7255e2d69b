"""K10 tune: search of the boosting space by cross-validated MAE, with trial and time limits.

A trial is a depth and a learning rate. The number of trees is no coordinate of its own: an ensemble of T trees holds
all smaller ones as its beginnings, so one fit on a fold scores every tree count up to T in a single pass
(``evaluateEachIteration``). Trials are run in rungs of trees: all with the fewest trees, then the best third with
twice as many, and so on up to the most. Rows are never dropped. The last trial climbs on as long as the newest half
of its trees lowers the error by ``min_gain``; with a smaller gain the count of trees is settled.

Two thirds of the trials are drawn from the whole space, one from each of as many slices of the learning rate's
logarithm, the rest around the best of them (one step of depth up or down, the learning rate within a factor of two). Folds are
exact; imputer and encoders are fitted on each fold's training rows once, and the encoded rows are written, so that lost
executors cost no refit of them. Errors are rounded to 1e-4 before they are compared: the order in which partial sums
meet decides nothing.

The fits of a rung, one for each trial and fold, don't wait for each other. Up to ``TASK_ROWS`` rows a fit is one task
that holds its rows as codes (``operators.boosting``): all fits of a rung are one job, and go on from the trees of the rung before. Beyond, each
fit is one of Spark ML over all executors, ``parallelism`` of them at once, from the first tree.
"""

from __future__ import annotations

import math
import pickle
import random
import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus import constants as C
from domus.errors import TrainingError
from domus.operators.boosting import Layout, Tree, boost, thresholds
from domus.operators.features import ListingImputer, one_hot_stages
from domus.operators.guards import LEAST_ANY, require_rows
from domus.operators.model import build_estimator
from domus.operators.split import default_key, key_columns, kfold_assign
from domus.session import materialize

# FIXED VALUES: the space that is searched
TREES = tuple(range(50, 401, 50))
DEPTHS = tuple(range(2, 9))
RATES = (1e-3, 0.3)

#: A rung keeps one in ``ETA`` trials; rows of one task of a fit; digits of an error.
ETA = 3
ROWS_PER_TASK = 200_000
DIGITS = 4

#: Rows that one task holds as codes, some 200 bytes each while it makes them; rows of a block of codes.
TASK_ROWS = 3_000_000
BLOCK_ROWS = 65_536

TRIALS_SCHEMA = "trial long, n_estimators long, max_depth long, learning_rate double, cv_mae double"


def propose(rng: random.Random, depths: tuple[int, ...] = DEPTHS, around: dict[str, Any] | None = None,
            slot: tuple[int, int] = (0, 1)) -> dict[str, Any]:
    """One point of the space: depth, and learning rate log-uniform in slice ``slot`` of ``RATES``; or one beside
    ``around``."""
    low, high = map(math.log, RATES)
    if around is None:
        share = (slot[0] + rng.random()) / slot[1]
        return {"max_depth": rng.choice(depths), "learning_rate": math.exp(low + share * (high - low))}
    at = depths.index(around["max_depth"]) + rng.choice((-1, 0, 1))
    rate = math.log(around["learning_rate"]) + rng.uniform(-math.log(2), math.log(2))
    return {"max_depth": depths[min(max(at, 0), len(depths) - 1)], "learning_rate": math.exp(min(max(rate, low), high))}


def rungs(trees: tuple[int, ...]) -> list[int]:
    """Tree counts that are fitted: the fewest, then twice as many each, up to the most (all of the grid)."""
    grid, out = sorted(set(trees)), []
    want = grid[0]
    while want < grid[-1]:
        out.append(max(t for t in grid if t <= want))
        want *= 2
    return [*out, grid[-1]]


def spread(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows in tasks of ``ROWS_PER_TASK`` at most, dealt out anew if they come in fewer."""
    parts = max(1, math.ceil(n / ROWS_PER_TASK))
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df


def fold_vectors(train: DataFrame, key: str | tuple[str, ...], k: int, n: int, seed: int) -> list[tuple[DataFrame, DataFrame]]:
    """(training, validation) vectors with their label of each fold, written, in partitions of ``ROWS_PER_TASK`` rows."""
    # the key was checked by the split that made the training rows, or is checked here, once
    folds = materialize(kfold_assign(train, key, k, seed).withColumn("label", F.col(C.TARGET).cast("double")))
    out = []
    for f in range(k):
        rest = folds.filter(F.col("fold") != f)
        feats = Pipeline(stages=[ListingImputer(keepCols=["label"]), *one_hot_stages()]).fit(rest)
        both = []
        for part, rows in ((rest, n - n // k), (folds.filter(F.col("fold") == f), n // k)):
            both.append(materialize(feats.transform(part).select("features", "label")).coalesce(
                max(1, math.ceil(rows / ROWS_PER_TASK))))
        out.append((both[0], both[1]))
    return out


def prefix_errors(fold: tuple[DataFrame, DataFrame], estimator: str, params: dict[str, Any], n_trees: int, seed: int) -> list[float]:
    """Validation MAE of the first 1, 2, ... ``n_trees`` trees of one fit."""
    model = build_estimator(estimator, {**params, "n_estimators": n_trees, "seed": seed}).fit(fold[0])
    return model.evaluateEachIteration(fold[1], "absolute")


def _encoded(widths: dict[int, list[int]]):
    """Blocks of codes and labels of each fold's rows, in the order of their keys' hashes: categories as their index, numbers as
    their bin among the training rows. ``widths``: of each fold's one-hot blocks, with one more for the unseen."""
    numbers = [*C.NUMERIC_FEATURES, *C.BOOL_FEATURES]
    names = ["fold", "out", "at", "codes", "label", "layout"]

    def blocks(fold: int, columns: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        take = lambda c: np.concatenate(columns.pop(c))
        order = np.lexsort((label := take("label"), take("_order")))
        label, out = label[order], take("_out")[order]
        if not np.isfinite(label).all():
            raise TrainingError("labels must be numbers")
        codes = [take(f"{c}__idx")[order] for c in C.CATEGORICAL_FEATURES]
        for c in numbers:
            values = take(c)[order]
            if np.isnan(values).any():
                raise TrainingError(f"column {c!r} holds values that are no numbers")
            codes.append(np.searchsorted(cuts := thresholds(values[~out]), values))
            codes[-1] = codes[-1].astype(np.uint8)
            widths[fold].append(len(cuts) + 1)
        layout = pickle.dumps((widths[fold], len(C.CATEGORICAL_FEATURES)))
        kind = np.min_scalar_type(max(widths[fold]))
        codes = np.stack([c.astype(kind) for c in codes])
        for side in (False, True):
            mine = np.flatnonzero(out == side)
            for k, lo in enumerate(range(0, len(mine), BLOCK_ROWS)):
                rows = mine[lo:lo + BLOCK_ROWS]
                yield pa.RecordBatch.from_pylist([dict(zip(names, (
                    fold, side, k, codes[:, rows].tobytes(), label[rows].tobytes(), layout), strict=True))], pa.schema(
                    list(zip(names, (pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, dict[str, list[np.ndarray]]] = {}
        for batch in batches:
            table = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            folds = table.pop("_fold")
            for f in np.unique(folds).tolist():
                for c, values in table.items():
                    found.setdefault(f, {}).setdefault(c, []).append(values[folds == f])
        for f in sorted(found):
            yield from blocks(f, found.pop(f))
    return run


def fold_codes(train: DataFrame, key: str | tuple[str, ...], k: int, seed: int, parallelism: int = 8) -> DataFrame:
    """The rows of each fold's training and validation part as written blocks of codes, one task a fold."""
    folds = materialize(kfold_assign(train, key, k, seed).select(
        *C.FEATURE_COLUMNS, C.TARGET, F.col(C.TARGET).cast("double").alias("label"), F.col("fold").alias("_fold"),
        F.xxhash64(*key_columns(key)).alias("_order")))
    widths: dict[int, list[int]] = {}

    def encoded(f: int) -> DataFrame:
        feats = Pipeline(stages=[ListingImputer(keepCols=["label", "_out", "_order"]), *one_hot_stages()]).fit(
            folds.filter(F.col("_fold") != f))
        imputer, indexer = feats.stages[:2]
        widths[f] = [len(labels) + 1 for labels in indexer.labelsArray]
        rows = indexer.transform(imputer.transform(folds.withColumn("_out", F.col("_fold") == f)))
        return rows.select(
            F.lit(f).alias("_fold"), "_out", "_order", "label", *(F.col(f"{c}__idx").cast("int") for c in C.CATEGORICAL_FEATURES),
            *(F.col(c).cast("double") for c in (*C.NUMERIC_FEATURES, *C.BOOL_FEATURES)))

    with ThreadPoolExecutor(max(1, min(k, parallelism))) as pool:
        frames = list(pool.map(encoded, range(k)))
    rows = frames[0]
    for more in frames[1:]:
        rows = rows.unionByName(more)
    return materialize(rows.repartitionByRange(k, "_fold").mapInArrow(
        _encoded(widths), "fold int, out boolean, at int, codes binary, label binary, layout binary"))


def _fits(trials: list[dict[str, Any]], grown: dict[tuple[int, int], list[Tree]], n_trees: int):
    """One fit for each run of blocks with one trial and fold."""
    def fitted(trial: int, fold: int, parts: list) -> pa.RecordBatch:
        widths, n_hot = pickle.loads(parts[0][3])
        layout = Layout(np.array(widths), np.arange(len(widths)) < n_hot)
        kind = np.min_scalar_type(max(widths))
        sides = []
        for side in (False, True):
            own = [p for p in parts if p[0] == side]
            codes = [np.frombuffer(p[1], kind).reshape(len(widths), -1) for p in own]
            sides += [np.concatenate([np.zeros((len(widths), 0), kind), *codes], 1),
                      np.concatenate([np.zeros(0), *(np.frombuffer(p[2]) for p in own)])]
        parts.clear()
        errors, trees = boost(*sides, layout, trials[trial]["max_depth"], trials[trial]["learning_rate"], n_trees,
                              grown.get((trial, fold), []))
        return pa.RecordBatch.from_arrays([pa.array([trial], pa.int32()), pa.array([fold], pa.int32()),
                                           pa.array([errors], pa.list_(pa.float64())), pa.array([pickle.dumps(trees)], pa.binary())],
                                          names=["trial", "fold", "errors", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        for batch in batches:  # sorted by trial, fold, side and place
            for r in batch.to_pylist():
                if at is not None and at != (r["trial"], r["fold"]):
                    yield fitted(*at, parts)
                at = r["trial"], r["fold"]
                parts.append((r["out"], r["codes"], r["label"], r["layout"]))
        if parts:
            yield fitted(*at, parts)
    return run


def code_errors(codes: DataFrame, k: int, trials: list[dict[str, Any]], wanted: list[int], n_trees: int,
                grown: dict[tuple[int, int], list[Tree]]) -> dict[tuple[int, int], list[float]]:
    """Validation MAE of the first 1, 2, ... ``n_trees`` trees of each (trial, fold); ``grown`` gets their trees."""
    fits = codes.sparkSession.createDataFrame([(t,) for t in wanted], "trial int")
    blocks = codes.join(F.broadcast(fits)).repartitionByRange(len(wanted) * k, "trial", "fold").sortWithinPartitions(
        "trial", "fold", "out", "at")
    out = {}
    for r in blocks.mapInArrow(_fits(trials, grown, n_trees), "trial int, fold int, errors array<double>, trees binary").collect():
        out[r["trial"], r["fold"]] = r["errors"]
        grown[r["trial"], r["fold"]] = pickle.loads(r["trees"])
    return out


def tune(train: DataFrame, n_trials: int = 5, timeout_seconds: float = 1800.0,
         estimator: str = "gbt", cv_folds: int = 5, seed: int = C.SEED, key: str | tuple[str, ...] | None = None,
         trees: tuple[int, ...] = TREES, depths: tuple[int, ...] = DEPTHS, parallelism: int = 8,
         min_gain: float = 0.03) -> tuple[dict[str, Any], DataFrame]:
    """Minimise cross-validated MAE. Returns (best params, one row for each trial with its best tree count).

    Same seed -> same proposals -> same result. Runs ``n_trials`` trials; once ``timeout_seconds`` are spent no new
    trial or rung begins (the first trial always runs). ``trees`` and ``depths`` are the space that is searched.
    """
    key = key or default_key(train)
    n = require_rows(train.count(), LEAST_ANY, "a search", TrainingError)
    build_estimator(estimator, {"n_estimators": 1, "max_depth": 1, "learning_rate": 1.0})  # one that takes these
    k, grown = min(cv_folds, n), {}
    one_task = n <= TASK_ROWS
    folds = fold_codes(train, key, k, seed, parallelism) if one_task else fold_vectors(train, key, k, n, seed)
    rng, start = random.Random(seed), time.monotonic()
    trials: list[dict[str, Any]] = []
    scores: dict[int, dict[int, float]] = {}  # trial -> tree count -> mean error over the folds
    ladder = rungs(trees)

    def left() -> bool:
        return time.monotonic() - start <= timeout_seconds

    def run(wanted: list[int], n_trees: int) -> None:
        pairs = [(t, f) for t in wanted for f in range(k)]
        if one_task:
            found = code_errors(folds, k, trials, wanted, n_trees, grown)
            errors = [found[p] for p in pairs]
        else:
            with ThreadPoolExecutor(max(1, parallelism)) as pool:
                errors = list(pool.map(lambda p: prefix_errors(folds[p[1]], estimator, trials[p[0]], n_trees, seed), pairs))
        for t in wanted:
            mine = [e for (u, _), e in zip(pairs, errors, strict=True) if u == t]
            scores[t] = {c: round(sum(e[c - 1] for e in mine) / len(mine), DIGITS) for c in sorted(set(trees)) if c <= n_trees}

    def best(t: int) -> tuple[float, int, int]:
        return min((error, count, t) for count, error in scores[t].items())

    def add(around: dict[str, Any] | None) -> bool:
        """Draw one more trial and its first rung, if there is time."""
        if trials and not left():
            return False
        trials.append(propose(rng, depths, around, slots[len(trials) % drawn]))
        return True

    drawn = max(1, n_trials - n_trials // 3)
    slots = rng.sample([(k, drawn) for k in range(drawn)], drawn)
    # trials of one round run side by side where no time limit could fall between them
    at_once = drawn if math.isinf(timeout_seconds) else 1
    while len(trials) < drawn:
        before = len(trials)
        if not all([add(None) for _ in range(min(at_once, drawn - before))]) and len(trials) == before:
            break
        run(list(range(before, len(trials))), ladder[0])
    centre = trials[min(map(best, range(len(trials))))[2]]
    before = len(trials)
    while len(trials) < n_trials and add(centre):
        pass
    if len(trials) > before:
        run(list(range(before, len(trials))), ladder[0])

    alive = sorted(range(len(trials)), key=best)
    for below, n_trees in zip(ladder, ladder[1:], strict=False):
        alive = sorted(alive, key=best)[:math.ceil(len(alive) / ETA)]
        if not left():
            break
        run(alive, n_trees)
        if len(alive) == 1:
            errors = scores[alive[0]]
            if min(errors.values()) > (1.0 - min_gain) * min(e for c, e in errors.items() if c <= below):
                break
    results = [(t, best(t)[1], trials[t]["max_depth"], float(trials[t]["learning_rate"]), best(t)[0]) for t in range(len(trials))]
    top = min(results, key=lambda r: (r[4], r[0]))
    frame = train.sparkSession.createDataFrame(results, TRIALS_SCHEMA)
    return {"n_estimators": top[1], "max_depth": top[2], "learning_rate": top[3]}, frame
