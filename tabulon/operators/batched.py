"""Many logistic models fitted together: one pass over the rows per step serves every fold, feature set and seed.

An experiment fits the same kind of model dozens of times on nearly the same rows. Here all of them advance side by side by Newton's
method: a task adds up the loss, gradient and curvature of every model over its rows, the sums of tasks are added up by
position, and the driver solves one small system per model. The number of passes is that of the slowest model, not the sum over models.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import durable
from . import aggregate as A


@dataclass(frozen=True)
class Problem:
    """One model: trained on the rows whose ``fold`` column differs from ``held``, on these columns."""

    name: str
    numerics: tuple[str, ...]
    categories: tuple[str, ...]
    fold: str
    held: int


class Design:
    """The matrix that a batch of rows becomes for the training rows of one fold.

    Nulls of a number take its median, a category takes a column per level of the training rows and one for any other
    value, and every column is divided by its standard deviation; all of this is learned from the training rows of the fold alone.
    """

    def __init__(self, numerics: list[str], categories: list[str], levels: dict[str, list[str]], folds: list[tuple[str, int]]):
        self.numerics, self.categories, self.levels, self.folds = numerics, categories, levels, folds
        self.places, at = {n: [i] for i, n in enumerate(numerics)}, len(numerics)
        for c in categories:
            self.places[c] = list(range(at, at + len(levels[c]) + 1))
            at += len(levels[c]) + 1
        self.width = at
        self.medians = {f: np.zeros(len(numerics)) for f in folds}
        self.scale = {f: np.ones(at) for f in folds}
        self.present = {f: np.ones(at, bool) for f in folds}

    def raw(self, batch: pa.RecordBatch) -> np.ndarray:
        """Numbers as they are (null: not a number) and a 0/1 column per level."""
        out = np.zeros((batch.num_rows, self.width))
        for i, n in enumerate(self.numerics):
            out[:, i] = batch[n].to_numpy(zero_copy_only=False).astype(float)
        for c in self.categories:
            found = batch[c].dictionary_encode()
            slot = {v: p for v, p in zip(self.levels[c], self.places[c])}
            into = np.array([slot.get(v, -1) for v in found.dictionary.to_pylist()] + [-1])
            code = into[np.nan_to_num(found.indices.to_numpy(zero_copy_only=False).astype(float), nan=-1).astype(int)]
            out[np.flatnonzero(code >= 0), code[code >= 0]] = 1.0
        return out

    def filled(self, raw: np.ndarray, fold) -> np.ndarray:
        x = raw * self.present[fold]
        n = len(self.numerics)
        x[:, :n] = np.where(np.isnan(raw[:, :n]), self.medians[fold], raw[:, :n])
        for c in self.categories:
            *known, other = self.places[c]
            x[:, other] = 1.0 - x[:, known].sum(axis=1)
        return x

    def matrix(self, raw: np.ndarray, fold) -> np.ndarray:
        """Scaled columns and a one for the intercept."""
        return np.column_stack([self.filled(raw, fold) * self.scale[fold], np.ones(len(raw))])

    def columns(self, problem: Problem) -> np.ndarray:
        return np.array([p for n in (*problem.numerics, *problem.categories) for p in self.places[n]] + [self.width])


def _added(df: DataFrame, sums, width: int) -> np.ndarray:
    """``sums(batch)`` (an array of ``width`` numbers) added up over all batches of all tasks."""

    def work(batches):
        total = np.zeros(width)
        for batch in batches:
            total += sums(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["v"])

    rows = df.mapInArrow(work, "v array<double>").select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width)
    for r in rows:
        out[r.at] = r.v
    return out


def learn_design(df: DataFrame, problems: list[Problem], label: str) -> tuple[Design, dict]:
    """The design of every fold and the weights of its two classes, from three passes over the rows."""
    numerics = list(dict.fromkeys(n for p in problems for n in p.numerics))
    categories = list(dict.fromkeys(c for p in problems for c in p.categories))
    folds = list(dict.fromkeys((p.fold, p.held) for p in problems))
    design = Design(numerics, categories, A.levels(df, categories), folds)
    asked = [F.percentile_approx(F.when(F.col(f) != h, F.col(n).cast("double")), 0.5, 10_000).alias(f"m{i}_{j}") for i, (f, h) in enumerate(folds) for j, n in enumerate(numerics)]
    asked += [F.count_if((F.col(f) != h) & (F.col(label) == y)).alias(f"n{i}_{y}") for i, (f, h) in enumerate(folds) for y in (0, 1)]
    row = df.agg(*asked).head()
    sizes = {}
    for i, fold in enumerate(folds):
        design.medians[fold] = np.array([row[f"m{i}_{j}"] or 0.0 for j in range(len(numerics))])
        n = [row[f"n{i}_{y}"] for y in (0, 1)]
        sizes[fold] = [sum(n) / (2 * max(c, 1)) for c in n]
    counts = {fold: row[f"n{i}_0"] + row[f"n{i}_1"] for i, fold in enumerate(folds)}
    d = design.width

    def moments(batch, about):
        raw, out = design.raw(batch), []
        for fold in folds:
            on = batch[fold[0]].to_numpy(zero_copy_only=False) != fold[1]
            x = design.filled(raw[on], fold) - about[fold]
            out += [x.sum(axis=0), (x * x).sum(axis=0)]
        return np.concatenate(out)

    about = {f: np.zeros(d) for f in folds}
    for again in (False, True):  # the second time about the mean, so large numbers lose no digits
        center = dict(about)
        total = _added(df, lambda b: moments(b, center), 2 * d * len(folds)).reshape(len(folds), 2, d)  # noqa: B023
        for i, fold in enumerate(folds):
            n = max(counts[fold], 1)
            if not again:
                about[fold] = total[i, 0] / n
                for c in categories:  # a level that the training rows do not have counts as any other value
                    known = design.places[c][:-1]
                    design.present[fold][known] = total[i, 0][known] > 0
            else:
                std = np.sqrt(np.maximum(total[i, 1] - total[i, 0] ** 2 / n, 0) / max(n - 1, 1))
                design.scale[fold] = np.where(std > 0, 1 / np.where(std > 0, std, 1), 0.0)
    return design, sizes


def fit_logistics(df: DataFrame, problems: list[Problem], label: str, reg: float = 0.01, rounds: int = 50, tolerance: float = 1e-10):
    """(design, coefficients): for every problem the weights of its scaled columns and, last, the intercept.

    Minimises the mean weighted log loss, classes balanced, plus ``reg / 2`` times the squared weights. Meant for up to a few hundred columns: a task sends
    a square of numbers per problem.
    """
    design, sizes = learn_design(df, problems, label)
    at = [design.columns(p) for p in problems]
    dims = [len(a) for a in at]
    offsets = np.cumsum([0] + [1 + k + k * k for k in dims])

    def measured(betas):
        def sums(batch):
            raw, y = design.raw(batch), batch[label].to_numpy(zero_copy_only=False).astype(float)
            sign, out, made = np.where(y > 0, 1.0, -1.0), [], {}
            for p, cols, beta in zip(problems, at, betas):
                fold = (p.fold, p.held)
                if fold not in made:
                    made[fold] = design.matrix(raw, fold)
                on = batch[p.fold].to_numpy(zero_copy_only=False) != p.held
                x = made[fold][on][:, cols]
                w = np.where(y[on] > 0, sizes[fold][1], sizes[fold][0])
                margin = sign[on] * (x @ beta)
                miss = 1 / (1 + np.exp(np.clip(margin, -700, 700)))
                bend = w * miss * (1 - miss)
                out += [[np.sum(w * np.logaddexp(0, -margin))], -(x.T @ (w * sign[on] * miss)), ((x * bend[:, None]).T @ x).ravel()]
            return np.concatenate(out)

        return _added(df, sums, offsets[-1])

    counts = [max(sum(df_size), 1) for df_size in _training_rows(df, problems)]
    betas, best, steps = [np.zeros(k) for k in dims], [None] * len(problems), [None] * len(problems)
    done = [False] * len(problems)
    for _ in range(rounds):
        found = measured(betas)
        for i, k in enumerate(dims):
            if done[i]:
                continue
            part, ridge = found[offsets[i] : offsets[i + 1]] / counts[i], np.append(np.full(k - 1, reg), 0.0)
            loss = part[0] + 0.5 * np.sum(ridge * betas[i] ** 2)
            if best[i] is not None and loss > best[i][0] + 1e-13:  # too far: half the way from the last point
                steps[i] = steps[i] / 2
                if np.abs(steps[i]).max() < tolerance:
                    betas[i], done[i] = best[i][1], True
                else:
                    betas[i] = best[i][1] + steps[i]
                continue
            gradient = part[1 : 1 + k] + ridge * betas[i]
            curve = part[1 + k :].reshape(k, k) + np.diag(ridge)
            best[i] = (loss, betas[i])
            steps[i] = -np.linalg.lstsq(curve, gradient, rcond=1e-12)[0]
            if np.abs(steps[i]).max() < tolerance:
                done[i] = True
            else:
                betas[i] = betas[i] + steps[i]
        if all(done):
            break
    return design, [b[1] if b else beta for b, beta in zip(best, betas)]


def _training_rows(df: DataFrame, problems: list[Problem]) -> list[list[int]]:
    folds = list(dict.fromkeys((p.fold, p.held) for p in problems))
    row = df.agg(*[F.count_if(F.col(f) != h).alias(f"n{i}") for i, (f, h) in enumerate(folds)]).head()
    count = {fold: row[f"n{i}"] for i, fold in enumerate(folds)}
    return [[count[p.fold, p.held]] for p in problems]


def cross_scores(df: DataFrame, key: str, label: str, problems: list[Problem], reg: float = 0.01) -> DataFrame:
    """(model, fold_by, key, label, fold, score): every row scored by the models that did not learn from it; one pass for all, written once."""
    names = [key, label, *dict.fromkeys(x for p in problems for x in (*p.numerics, *p.categories, p.fold))]
    rows = durable(df.select(*names))
    design, betas = fit_logistics(rows, problems, label, reg)
    at = [design.columns(p) for p in problems]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def work(batches):
        for batch in batches:
            raw, made, parts = design.raw(batch), {}, []
            for p, cols, beta in zip(problems, at, betas):
                fold = (p.fold, p.held)
                on = np.flatnonzero(batch[p.fold].to_numpy(zero_copy_only=False) == p.held)
                if fold not in made:
                    made[fold] = design.matrix(raw[on], fold)
                score = 1 / (1 + np.exp(np.clip(-(made[fold][:, cols] @ beta), -700, 700)))
                took = batch.take(pa.array(on))
                n = len(on)
                parts.append(pa.table([pa.array([p.name] * n, pa.string()), pa.array([p.fold] * n, pa.string()), took[key], took[label], pa.array([p.held] * n, pa.int32()), pa.array(score)],
                                      names=["model", "fold_by", key, label, "fold", "score"]))
            yield from pa.concat_tables(parts).combine_chunks().to_batches()

    return durable(rows.mapInArrow(work, f"model string, fold_by string, `{key}` {kinds[key]}, `{label}` {kinds[label]}, fold int, score double"))


def fold_problems(sets: dict[str, tuple[list[str], list[str]]], fold: str, k: int) -> list[Problem]:
    """Every feature set on every fold."""
    return [Problem(n, tuple(a), tuple(b), fold, i) for n, (a, b) in sets.items() for i in range(k)]
