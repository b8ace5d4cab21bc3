"""Forward selection of features by cross-validated AUC, fitted from sums over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.operators.scaling import Standardizer
from marlstone.session import stable

#: Bytes of Newton sums that one task may hold; candidates beyond them take a pass of their own.
SUM_BYTES = 64 << 20

#: Models and rows whose chances are taken at once, so that they stay in a core's cache.
_TOGETHER = 64
_ROWS = 512

#: In place of a candidate: the sums that all candidates of a fold share.
_SHARED = -1

#: (candidate, fold): one model of a step.
Model = tuple[int, int]


def forward_select(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    k: int | None = None,
    folds: int = 5,
    key: str | None = None,
    c: float = 1.0,
    bins: int = 4096,
    rounds: int = 25,
) -> list[tuple[str, float]]:
    """Greedy forward selection by cross-validated AUC: (feature, AUC so far).

    Half of the features by default. Each candidate is judged, on all rows, by a
    class-balanced logistic regression with inverse penalty strength ``c`` on standardised
    columns; nulls count as the column's mean, rows without a label are left out. All
    candidates and folds of a step are fitted together: a Newton round is one pass that sums
    X'Wr and X'WX in every task, adds the tasks' sums per model and solves there; at most
    ``rounds`` of them, each model starting from that of the step before. Only coefficients and
    scores, whose number follows from features and folds alone, reach the driver. The AUC
    is that of the held-out chances in ``bins`` equal steps; chances in one step tie. Folds
    of one class are left out, and ties go to the earlier feature.
    """
    k = len(features) // 2 if k is None else k
    seed = [F.col(key)] if key else [F.col(x) for x in df.columns]
    labelled = df.where(F.col(label).isNotNull())
    scaled = Standardizer.fit(labelled, features).transform(labelled)
    values = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, f in enumerate(features)]
    fold = F.pmod(F.xxhash64(*seed), F.lit(folds)).cast("int").alias("fold")
    rows = stable(scaled.select(F.col(label).cast("double").alias("y"), fold, *values))
    weights = _class_weights(rows, folds)
    picked: list[tuple[int, float]] = []
    left = list(range(len(features)))
    start = {(f, at): np.zeros(2) for f in left for at in weights}
    base = {at: np.zeros(1) for at in weights}
    while left and len(picked) < k:
        chosen = [f for f, _ in picked]
        width = len(chosen) + 2
        block = max(1, SUM_BYTES // (8 * width * (width + 1) * max(len(weights), 1)))
        scores: dict[int, float] = {}
        betas: dict[Model, np.ndarray] = {}
        for low in range(0, len(left), block):
            fitted = _fit(rows, chosen, left[low : low + block], weights, start, base, c, rounds)
            betas |= fitted
            scores |= _held_out_auc(rows, chosen, left[low : low + block], fitted, bins)
        best = max(left, key=lambda f: (scores[f], -f))
        picked.append((best, scores[best]))
        left.remove(best)
        # The model of a candidate starts from its last one, with the picked feature's coefficient.
        start = {
            (f, at): np.insert(betas[f, at], width - 2, betas[best, at][width - 2])
            for f, at in betas
            if f != best
        }
        base = {at: betas[best, at] for at in weights}
    return [(features[f], score) for f, score in picked]


def _class_weights(rows: DataFrame, folds: int) -> dict[int, tuple[float, float]]:
    """fold: weights of the classes 0 and 1 in the other folds, where both parts have both classes."""
    counts = np.zeros((folds, 2))
    for r in rows.groupBy("fold", (F.col("y") == 1).cast("int").alias("y")).count().collect():
        counts[r["fold"], r["y"]] = r["count"]
    train = counts.sum(axis=0) - counts
    return {
        at: tuple(float(train[at].sum() / (2 * n)) for n in train[at])
        for at in range(folds)
        if counts[at].all() and train[at].all()
    }


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Labels, folds and feature columns by number."""
    found = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}
    return found["y"], found["fold"], {int(n[1:]): v for n, v in found.items() if n[0] == "x"}


def _rows(columns: tuple, some: slice) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    y, part, x = columns
    return y[some], part[some], {f: v[some] for f, v in x.items()}


def _chances(left: np.ndarray, right: np.ndarray, more: np.ndarray | float = 0.0) -> np.ndarray:
    p = left @ right
    p += more
    np.clip(p, -30, 30, out=p)
    np.exp(np.negative(p, out=p), out=p)
    p += 1
    return np.reciprocal(p, out=p)


def _filled(x: dict[int, np.ndarray], chosen: list[int], inside: np.ndarray) -> np.ndarray:
    """Chosen columns, room for the candidate's, and the intercept's ones."""
    full = np.ones((int(inside.sum()), len(chosen) + 2))
    for i, f in enumerate(chosen):
        full[:, i] = x[f][inside]
    return full


def _by_fold(models: Sequence[Model]) -> dict[int, list[int]]:
    """fold: candidates, so that a fold's rows are taken out once."""
    found: dict[int, list[int]] = {}
    for f, at in models:
        found.setdefault(at, []).append(f)
    return found


def _fit(
    rows: DataFrame,
    chosen: list[int],
    candidates: list[int],
    weights: dict[int, tuple[float, float]],
    start: dict[Model, np.ndarray],
    base: dict[int, np.ndarray],
    c: float,
    rounds: int,
) -> dict[Model, np.ndarray]:
    """Coefficients (chosen, candidate, intercept) of every candidate in every fold."""
    betas = {(f, at): start[f, at] for f in candidates for at in weights}
    table = rows.select("y", "fold", *[f"x{f}" for f in [*chosen, *candidates]])
    curves: dict[Model, np.ndarray] = {}
    changes: dict[Model, float] = {}
    active, slow = list(betas), set()
    for turn in range(rounds):
        if not active:
            break
        now = {model: betas[model] for model in active}
        sums = table.mapInArrow(
            _newton_sums(chosen, now, slow, {} if turn else base, weights),
            "candidate int, fold int, task int, sums array<double>",
        )
        # By task, so that a sum repeats to the last digit.
        sums = sums.repartition("candidate", "fold").sortWithinPartitions("candidate", "fold", "task")
        added = sums.mapInArrow(_added, "candidate int, fold int, sums array<double>")
        # One line per model.
        totals = {(r["candidate"], r["fold"]): np.array(r["sums"]) for r in added.collect()}
        if not turn:
            curves = {
                (f, at): curve
                for at in weights
                for f, curve in zip(candidates, _shared_curves(totals[_SHARED, at], len(chosen) + 1), strict=True)
            }
        active, steep, slow = [], slow, set()
        for model in now:
            width = len(betas[model])
            if totals[model].size > width:
                curves[model] = totals[model][width:].reshape(width, width)
            betas[model], change = _newton_step(betas[model], totals[model][:width], curves[model], c)
            rate = change / changes.get(model, change) if change else 0.0
            changes[model] = change
            # What is left is far below a bin: about the square of the change by a model's own
            # curvature, and about the change times its rate by the shared one.
            own = model in steep
            if change > 1e-3 if own else change * rate > 1e-5:
                active.append(model)
                if own or turn and rate > 0.1:
                    slow.add(model)
    return betas


def _newton_sums(
    chosen: list[int],
    betas: dict[Model, np.ndarray],
    slow: set[Model],
    base: dict[int, np.ndarray],
    weights: dict[int, tuple[float, float]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """X'Wr of every model, X'WX of the slow ones; and, for the folds of ``base``, the parts of
    X'WX that the fold's candidates share, at the chances of the chosen columns alone."""
    s = len(chosen)
    groups = [
        (at, some[low : low + _TOGETHER])
        for at, some in _by_fold(list(betas)).items()
        for low in range(0, len(some), _TOGETHER)
    ]
    coefficients = [np.array([betas[f, at] for f in some]) for at, some in groups]
    others, owns = [np.delete(b, s, axis=1) for b in coefficients], [b[:, s, None] for b in coefficients]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slopes = [np.zeros((len(some), s + 2)) for _, some in groups]
        curves = {model: np.zeros((s + 2, s + 2)) for model in slow}
        common = {at: np.zeros((s + 1, s + 1)) for at in base}
        mixed = [np.zeros((len(some), s + 2)) if at in base else None for at, some in groups]
        seen = False
        for batch in batches:
            seen = seen or batch.num_rows > 0
            columns = _columns(batch)
            for low in range(0, batch.num_rows, _ROWS):
                y, part, x = _rows(columns, slice(low, low + _ROWS))
                held = np.stack([*[x[f] for f in chosen], np.ones(len(y))])
                weight, bent = {}, {}
                for at in {at for at, _ in groups}:
                    weight[at] = np.where(y == 1, weights[at][1], weights[at][0]) * (part != at)
                    if at in base:
                        p = _chances(base[at], held)
                        bent[at] = weight[at] * p * (1 - p)
                        common[at] += (held * bent[at]) @ held.T
                for i, (at, some) in enumerate(groups):
                    own = np.stack([x[f] for f in some])
                    p = _chances(others[i], held, owns[i] * own)
                    rest = p - y
                    rest *= weight[at]
                    slopes[i] += _products(held, own, rest)
                    if at in base:
                        mixed[i] += _products(held, own, bent[at] * own)
                    for j, f in enumerate(some):
                        if (f, at) in slow:
                            full = np.insert(held, s, own[j], axis=0)
                            curves[f, at] += (full * (weight[at] * p[j] * (1 - p[j]))) @ full.T
        if not seen:
            return
        task = TaskContext.get().partitionId()
        lines, shared = [], {at: [common[at].ravel()] for at in base}
        for i, (at, some) in enumerate(groups):
            for j, f in enumerate(some):
                more = [curves[f, at].ravel()] if (f, at) in slow else []
                lines.append((f, at, task, np.concatenate([slopes[i][j], *more])))
            if at in base:
                shared[at].append(mixed[i].ravel())
        lines += [(_SHARED, at, task, np.concatenate(parts)) for at, parts in shared.items()]
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame(lines, columns=["candidate", "fold", "task", "sums"]).astype(
                {"candidate": "int32", "fold": "int32", "task": "int32"}
            ),
            preserve_index=False,
        )

    return run


def _products(held: np.ndarray, own: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A line per model: its values times the chosen columns, its own column and the ones."""
    sums = values @ held.T
    return np.insert(sums, sums.shape[1] - 1, np.einsum("ij,ij->i", own, values), axis=1)


def _shared_curves(total: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """X'WX of every candidate, from what all share and its own row."""
    common = total[: size * size].reshape(size, size)
    for mine in total[size * size :].reshape(-1, size + 1):
        curve = np.insert(np.insert(common, size - 1, 0.0, axis=0), size - 1, 0.0, axis=1)
        curve[size - 1, :] = curve[:, size - 1] = mine
        yield curve


def _newton_step(beta: np.ndarray, slope: np.ndarray, curve: np.ndarray, c: float) -> tuple[np.ndarray, float]:
    """One ridge-penalised step, at most 4 in any coefficient; the intercept isn't penalised."""
    penalty = np.full(len(beta), 1.0 / c)
    penalty[-1] = 1e-9
    step = np.linalg.solve(curve + np.diag(penalty), slope + penalty * beta)
    change = float(np.abs(step).max())
    return beta - step * min(1.0, 4.0 / max(change, 1e-300)), change


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of every model's lines, which follow each other; one sum is held at a time."""

    def line(model: Model, total: np.ndarray) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.float64())]
        columns = [pa.array([v], kind) for v, kind in zip([*model, total], kinds, strict=True)]
        return pa.record_batch(columns, names=["candidate", "fold", "sums"])

    current, total = None, None
    for batch in batches:
        candidates, folds = batch["candidate"].to_pylist(), batch["fold"].to_pylist()
        sums = batch["sums"]
        for i, model in enumerate(zip(candidates, folds, strict=True)):
            mine = sums[i].values.to_numpy()
            if model == current:
                total = total + mine
                continue
            if current is not None:
                yield line(current, total)
            current, total = model, mine
    if current is not None:
        yield line(current, total)


def _held_out_auc(
    rows: DataFrame, chosen: list[int], candidates: list[int], betas: dict[Model, np.ndarray], bins: int
) -> dict[int, float]:
    """candidate: mean AUC over the folds, each on its own rows; 0.5 without any fold."""
    if not betas:
        return dict.fromkeys(candidates, 0.5)
    table = rows.select("y", "fold", *[f"x{f}" for f in [*chosen, *candidates]])
    counted = table.mapInArrow(
        _histograms(chosen, betas, bins), "candidate int, fold int, bin int, negatives long, positives long"
    )
    totals = counted.groupBy("candidate", "fold", "bin").agg(
        F.sum("negatives").alias("n"), F.sum("positives").alias("p")
    )
    # At most ``bins`` lines per model.
    before = Window.partitionBy("candidate", "fold").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("n").over(before), F.lit(0)) + F.col("n") / 2
    wins = totals.withColumn("wins", F.col("p") * below)
    aucs = wins.groupBy("candidate", "fold").agg((F.sum("wins") / (F.sum("n") * F.sum("p"))).alias("auc"))
    found: dict[int, list[float]] = {f: [] for f in candidates}
    for r in sorted(aucs.collect()):
        found[r["candidate"]].append(r["auc"])
    return {f: float(np.mean(scores)) for f, scores in found.items()}


def _histograms(
    chosen: list[int], betas: dict[Model, np.ndarray], bins: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    s = len(chosen)
    models = list(betas)
    folds = _by_fold(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {model: np.zeros((2, bins), dtype=np.int64) for model in models}
        for batch in batches:
            y, part, x = _columns(batch)
            for at, candidates in folds.items():
                inside = part == at
                full, positive = _filled(x, chosen, inside), y[inside] == 1
                for f in candidates:
                    full[:, s] = x[f][inside]
                    place = np.minimum((_chances(full, betas[f, at]) * bins).astype(int), bins - 1)
                    counts[f, at][0] += np.bincount(place[~positive], minlength=bins)
                    counts[f, at][1] += np.bincount(place[positive], minlength=bins)
        for (f, at), held in counts.items():
            some = np.flatnonzero(held.any(axis=0))
            if some.size:
                yield pa.RecordBatch.from_pydict(
                    {
                        "candidate": np.full(some.size, f, dtype=np.int32),
                        "fold": np.full(some.size, at, dtype=np.int32),
                        "bin": some.astype(np.int32),
                        "negatives": held[0, some],
                        "positives": held[1, some],
                    }
                )

    return run
