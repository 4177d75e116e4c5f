"""Quality by a sparse ensemble of rules.

Small trees are boosted on statistics of labelled documents, every path in them
becomes a rule (a conjunction of thresholds), and a lasso logistic regression
keeps the few rules that matter. The model is then a Spark column expression over
the statistics, so scoring is a projection of the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import crc_mod, stored

# Bounds of the training: labelled documents, chosen by a hash of their ids; only
# their statistics come to the driver.
TRAIN_DOCS = 20_000
TREES, DEPTH, BINS, LEARNING_RATE = 40, 3, 48, 0.3
LASSO, MAX_RULES = 2e-3, 400


def _ratio(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def statistics(text: Column) -> tuple[list[Column], dict[str, Column]]:
    """(columns to compute first, statistics by name over them); a null text counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    first = [
        F.length(text).alias("_chars"),
        F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+")).alias("_words"),
        F.split(text, "\n").alias("_lines"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).alias("_upper"),
        F.length(F.regexp_replace(text, r"[^\p{L}]+", "")).alias("_letters"),
        F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s.,]+", "")).alias("_marks"),
        F.length(F.regexp_replace(text, r"[^0-9]+", "")).alias("_digits"),
        F.length(F.regexp_replace(text, r"[^!?]+", "")).alias("_shouts"),
        F.length(F.regexp_replace(text, r"[^.,]+", "")).alias("_stops"),
    ]
    n_words, n_lines = F.size("_words"), F.size("_lines")
    places = F.when(n_words > 1, F.sequence(F.lit(0), n_words - 2)).otherwise(F.array().cast("array<int>"))
    doubled = F.size(F.filter(places, lambda k: F.get("_words", k) == F.get("_words", k + 1)))
    named = {
        "chars": F.col("_chars").cast("double"),
        "words": n_words.cast("double"),
        "word_length": _ratio(F.col("_chars"), n_words),
        "line_words": _ratio(n_words, n_lines),
        "upper": _ratio(F.col("_upper"), F.col("_letters")),
        "letters": _ratio(F.col("_letters"), F.col("_chars")),
        "marks": _ratio(F.col("_marks"), F.col("_chars")),
        "digits": _ratio(F.col("_digits"), F.col("_chars")),
        "shouts": _ratio(F.col("_shouts"), n_words),
        "stops": _ratio(F.col("_stops"), n_words),
        "doubled": _ratio(doubled, n_words),
        "new_words": _ratio(F.size(F.array_distinct("_words")), n_words),
        "new_lines": _ratio(F.size(F.array_distinct("_lines")), n_lines),
    }
    return first, named


def with_statistics(rows: DataFrame, keep: list[Column], text: Column) -> DataFrame:
    """``keep`` and every statistic as a column s_<name>."""
    first, named = statistics(text)
    kept = [f"_keep{k}" for k in range(len(keep))]
    inner = rows.select(*[c.alias(k) for c, k in zip(keep, kept, strict=True)], *first)
    return inner.select(*kept, *[c.alias(f"s_{name}") for name, c in named.items()])


@dataclass(frozen=True)
class Rule:
    """Bounds of statistics: above the first (or None), up to the second (or None)."""

    bounds: tuple[tuple[int, float | None, float | None], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        good = np.ones(len(x), bool)
        for k, low, high in self.bounds:
            good &= (x[:, k] > low) if low is not None else True
            good &= (x[:, k] <= high) if high is not None else True
        return good

    def column(self, names: list[str]) -> Column:
        parts = []
        for k, low, high in self.bounds:
            column = F.col(f"s_{names[k]}")
            parts += [column > F.lit(low)] if low is not None else []
            parts += [column <= F.lit(high)] if high is not None else []
        whole = parts[0]
        for part in parts[1:]:
            whole = whole & part
        return whole


def _narrowed(bounds: dict, k: int, low: float | None, high: float | None) -> dict:
    old_low, old_high = bounds.get(k, (None, None))
    low = old_low if low is None else low if old_low is None else max(low, old_low)
    high = old_high if high is None else high if old_high is None else min(high, old_high)
    return bounds | {k: (low, high)}


def grow(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Rules of all nodes of boosted trees over quantile bins, in the order they appear."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    # A statistic that is nearly always the same still gets a cut above that value.
    cuts = [np.unique(np.append(c, np.unique(col)[:1])) for c, col in zip(cuts, x.T, strict=True)]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    margin, found = np.full(len(y), np.log(share / (1 - share))), {}
    least = max(5, len(y) // 2000)

    def split(rows: np.ndarray, bounds: dict, depth: int, gradient: np.ndarray, hessian: np.ndarray) -> None:
        g, h = gradient[rows], hessian[rows]
        best = (1e-9, None, None)
        if depth < DEPTH and len(rows) >= 2 * least:
            for k in range(x.shape[1]):
                size = len(cuts[k]) + 1
                gs = np.cumsum(np.bincount(binned[rows, k], g, size))[:-1]
                hs = np.cumsum(np.bincount(binned[rows, k], h, size))[:-1]
                ns = np.cumsum(np.bincount(binned[rows, k], minlength=size))[:-1]
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1)
                gain[(ns < least) | (len(rows) - ns < least)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = (float(gain.max()), k, int(gain.argmax()))
        if best[1] is None:
            margin[rows] += LEARNING_RATE * g.sum() / (h.sum() + 1)
            return
        _, k, at = best
        cut = float(cuts[k][at])
        left = binned[rows, k] <= at
        for some, low, high in ((rows[left], None, cut), (rows[~left], cut, None)):
            inner = _narrowed(bounds, k, low, high)
            found.setdefault(Rule(tuple((f, *inner[f]) for f in sorted(inner))))
            split(some, inner, depth + 1, gradient, hessian)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        split(np.arange(len(y)), {}, 0, y - p, p * (1 - p))
    return list(found)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L1-penalised logistic regression, by accelerated proximal steps."""
    n, k = z.shape
    z1 = np.hstack([z, np.ones((n, 1))])
    v = np.ones(k + 1)
    for _ in range(30):
        v = z1.T @ (z1 @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / float(v @ (z1.T @ (z1 @ v)))
    w = last = np.zeros(k + 1)
    t = 1.0
    for _ in range(800):
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = w + (t - 1) / t_next * (w - last)
        gradient = z1.T @ (1 / (1 + np.exp(-np.clip(z1 @ ahead, -30, 30))) - y) / n
        last, t = w, t_next
        w = ahead - step * gradient
        w[:-1] = np.sign(w[:-1]) * np.maximum(abs(w[:-1]) - step * penalty, 0)
        if abs(w - last).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


@dataclass(frozen=True)
class RuleModel:
    names: list[str]
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def column(self) -> Column:
        """The score as an expression over the s_ columns."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + F.when(rule.column(self.names), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> RuleModel:
    """Learn from labels outside the held-out third.

    Without labels the score is one half, with one class only the softened share of that class.
    """
    usable = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    usable = usable.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (crc_mod(F.col("id"), 3) != 1))
    usable = usable.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64(F.lit(11), "id"), "id").limit(TRAIN_DOCS)
    chosen = stored(usable, "quality-docs").withColumnRenamed("id", "_id").withColumnRenamed("label", "_label")
    rows = documents.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    names = list(statistics(F.lit(""))[1])
    data = with_statistics(rows, [F.col("_id"), F.col("_label")], F.col("_text")).toPandas()
    # In one order, whatever order the rows came in.
    data = data.sort_values(["_keep0", "s_chars", "s_words", "s_letters"], kind="stable")
    y, x = data["_keep1"].to_numpy(float), data[[f"s_{n}" for n in names]].to_numpy(float)
    ones = y.sum()
    if not 0 < ones < len(y):
        share = (ones + 1) / (len(y) + 2)
        return RuleModel(names, [], [], float(np.log(share / (1 - share))))
    rules = grow(x, y)[:MAX_RULES]
    held = np.stack([rule.holds(x) for rule in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    weights, intercept = lasso(held, y, LASSO)
    kept = [k for k in range(len(rules)) if weights[k] != 0]
    return RuleModel(names, [rules[k] for k in kept], [float(weights[k]) for k in kept], intercept)


def score(documents: DataFrame, model: RuleModel, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row: one projection, no shuffle, no Python.

    Null and empty texts have zero for every statistic and a score like any
    other. Null ids and repeated rows pass through (a null id counts as empty
    text in ``held_out``), an empty table gives no rows, other columns are not read.
    """
    keep = [F.col(doc_id), crc_mod(F.col(doc_id), 3) == 1]
    scored = with_statistics(documents, keep, F.col(text)).select("_keep0", "_keep1", model.column().alias("score"))
    return scored.select(
        F.col("_keep0").alias("doc_id"),
        F.col("_keep1").alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def accepted(documents: DataFrame, model: RuleModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``documents`` that score ``threshold`` or more, with their own columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    scored = with_statistics(documents, [whole], F.col(f"`{text}`"))
    # A filter would be pushed below the statistics and compute each of them once for every rule that
    # reads it; it is not pushed past a column that is not deterministic, though this one always is the score.
    settled_score = F.when(F.monotonically_increasing_id() >= 0, model.column()).alias("score")
    return scored.select("_keep0", settled_score).where(F.col("score") >= threshold).select("_keep0.*")
