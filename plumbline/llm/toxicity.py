"""Toxicity by a subsequence string kernel.

The kernel of two words counts the three-letter subsequences they share, each
weighted down by the letters it spans, up to five, so a gap or an inserted letter
weakens a match and does not break it. Case, accents, look-alike digits and
marks between letters are folded away first, and letters spelled out one by one
are put together. A support vector machine over Nyström landmarks learns from
the words of labelled documents. Landmark weights then collapse into one weight
for each subsequence, which scores every word of every text by table look-ups.
A document is as toxic as its worst word; of a word beyond 32 symbols, overlapping
windows of 32 count as words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import crc_mod, stored

# Bounds of what is learned from: labelled documents of each class, chosen by a
# hash of their ids, and words of each kind. Nothing else depends on them.
TOXIC_DOCS, CLEAN_DOCS = 4_000, 16_000
TOXIC_WORDS, CLEAN_WORDS, LANDMARKS = 400, 6_000, 400
COST = 20.0
EVIDENCE, PURITY = 20.0, 0.8

SYMBOLS, BLANK, SPAN, DECAY, LONGEST = 64, 63, 5, 0.6, 32
# Windows of a longer word begin so many symbols apart: one of them holds all of any 25 in a row.
STRIDE = 8
FOLDED = 0x3000
GAPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]
# Digits and signs that stand for letters: fixed values.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Symbol of each code point below ``FOLDED``: 0 to leave out, 1 to 26 letters, others by remainder."""
    table = np.zeros(FOLDED, np.uint8)
    for point in range(FOLDED):
        char = chr(point)
        if char.isspace():
            table[point] = BLANK
            continue
        base = unicodedata.normalize("NFKD", LOOK_ALIKE.get(char, char))[0].lower()
        if "a" <= base <= "z":
            table[point] = ord(base) - ord("a") + 1
        elif char.isalpha():
            table[point] = 27 + point % 36
    return table


@lru_cache(maxsize=1)
def _norms() -> np.ndarray:
    """Norm of a word by its length."""
    total = np.zeros(LONGEST + 1)
    for a, b in GAPS:
        for length in range(a + b + 1, LONGEST + 1):
            total[length] += (length - a - b) * DECAY ** (2 * (a + b + 1))
    return np.sqrt(np.maximum(total, DECAY**6))


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all windows, start and length of each window in them, text of each window)."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), "<u4")
    symbols = _fold()[np.minimum(points, FOLDED - 1)]
    beyond = points >= FOLDED
    symbols[beyond] = (27 + points[beyond] % 36).astype(np.uint8)
    blank = symbols == BLANK
    word = np.cumsum(blank, dtype=np.int64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(lengths + 1) - lengths - 1
    first_word = np.concatenate([[0], word[begins[1:] - 1]]) if len(texts) > 1 else np.zeros(1, np.int64)
    keep = (symbols != 0) & ~blank
    symbols, word = symbols[keep], word[keep]
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    sizes = np.diff(starts, append=len(word))
    owner = np.searchsorted(first_word, word[starts], side="right") - 1
    spelled = np.zeros(len(starts), bool)
    spelled[1:] = (sizes[1:] == 1) & (sizes[:-1] == 1) & (owner[1:] == owner[:-1])
    starts, owner = starts[~spelled], owner[~spelled]
    sizes = np.diff(starts, append=len(word))
    pieces = 1 + -(-np.maximum(sizes - LONGEST, 0) // STRIDE)
    if len(pieces) and pieces.max() > 1:
        offset = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        # The last window of a word ends with it.
        last = np.repeat(np.maximum(sizes - LONGEST, 0), pieces)
        begin = np.repeat(starts, pieces) + np.minimum(STRIDE * offset, last)
        owner, sizes = np.repeat(owner, pieces), np.repeat(np.minimum(sizes, LONGEST), pieces)
        starts = np.cumsum(sizes) - sizes
        symbols = symbols[np.arange(sizes.sum()) + np.repeat(begin - starts, sizes)]
    return symbols, starts, sizes, owner


def _subsequences(symbols: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(where it begins, its code, its weight) of the subsequences, one gap pattern after the other."""
    window = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    high, middle, low = symbols.astype(np.int32) << 12, symbols.astype(np.int32) << 6, symbols.astype(np.int32)
    for a, b in GAPS:
        n = len(symbols) - a - b
        if n > 0:
            at = np.flatnonzero(window[:n] == window[a + b :])
            yield at, high[at] | middle[at + a] | low[at + a + b], DECAY ** (a + b + 1)


class Kernel:
    """Kernel values of words (bytes of symbols) against landmarks."""

    def __init__(self, landmarks: list[bytes]):
        self.landmarks = landmarks
        codes, owners, weights = self._triplets(landmarks)
        self.codes, self.at = np.unique(codes, return_inverse=True)
        self.matrix = np.zeros((len(self.codes), len(landmarks)))
        np.add.at(self.matrix, (self.at, owners), weights)

    @staticmethod
    def _triplets(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        symbols, owner = np.frombuffer(b"".join(found), np.uint8), np.repeat(np.arange(len(found)), sizes)
        norm = _norms()[sizes]
        parts = [(code, owner[at], weight / norm[owner[at]]) for at, code, weight in _subsequences(symbols, sizes)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def values(self, found: list[bytes]) -> np.ndarray:
        out = np.zeros((len(found), len(self.landmarks)))
        for at in range(0, len(found), 400):
            codes, owners, weights = self._triplets(found[at : at + 400])
            place = np.minimum(np.searchsorted(self.codes, codes), max(0, len(self.codes) - 1))
            known = self.codes[place] == codes if len(self.codes) else np.zeros(len(codes), bool)
            np.add.at(out, owners[known] + at, self.matrix[place[known]] * weights[known, None])
        return out

    def collapsed(self, alpha: np.ndarray) -> np.ndarray:
        """One weight for each subsequence: what the landmarks together give it."""
        table = np.zeros(SYMBOLS**3, np.float32)
        table[self.codes] = self.matrix @ alpha
        return table


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine, solved by Newton steps over its support vectors."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    keep = np.eye(x1.shape[1])
    keep[-1, -1] = 1e-3
    w = np.zeros(x1.shape[1])
    support = np.ones(len(x1), bool)
    for _ in range(30):
        xs, cs = x1[support], cost[support]
        w = np.linalg.solve(keep + (xs * cs[:, None]).T @ xs, (xs * cs[:, None]).T @ y[support])
        now = y * (x1 @ w) < 1
        if (now == support).all():
            break
        support = now
    return w[:-1], float(w[-1])


def _trained(toxic: list[bytes], clean: list[bytes]) -> tuple[np.ndarray, float]:
    """Subsequence weights and bias."""
    half = LANDMARKS // 2
    kernel = Kernel(toxic[:half] + clean[:half])
    values, vectors = np.linalg.eigh(kernel.values(kernel.landmarks))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    x = kernel.values(toxic + clean) @ whiten
    y = np.concatenate([np.ones(len(toxic)), -np.ones(len(clean))])
    w, bias = _svm(x, y, np.where(y > 0, COST * len(clean) / len(toxic), COST))
    return kernel.collapsed(whiten @ w), bias


SLICE = 1 << 20


def _slices(text: str) -> list[str]:
    """Pieces of a very long text, cut at white space after a word of several characters."""
    parts, at = [], 0
    while len(text) - at > SLICE:
        cut = at + SLICE
        while cut < len(text) and not (text[cut].isspace() and not text[cut - 1].isspace() and not text[cut - 2].isspace()):
            cut += 1
        parts.append(text[at:cut])
        at = cut
    return [*parts, text[at:]]


def worst_words(texts: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """The highest machine value of any word of each text; the bias for a text without words."""
    pieces, owners = [], []
    for k, text in enumerate(texts):
        for piece in _slices(text) if len(text) > SLICE else [text]:
            pieces.append(piece)
            owners.append(k)
    found, at = np.full(len(texts), bias), 0
    while at < len(pieces):
        upto, held = at, 0
        while upto < len(pieces) and (upto == at or held + len(pieces[upto]) <= SLICE):
            held += len(pieces[upto]) + 1
            upto += 1
        symbols, starts, sizes, owner = windows(pieces[at:upto])
        if len(starts):
            sums = np.zeros(len(symbols), np.float64)
            for begin, code, weight in _subsequences(symbols, sizes):
                sums[begin] += weight * table[code]
            value = np.add.reduceat(sums, starts) / _norms()[sizes] + bias
            np.maximum.at(found, np.array(owners[at:upto])[owner], value)
        at = upto
    return found


# Odd multipliers that give a shingle's hash four independent orders.
ORDERS = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def family_keys(text: str) -> list[int]:
    """The smallest five-word shingle by each of four orders; near copies agree in most of them."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    runs = [" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))]
    hashes = np.fromiter((xxh64_intdigest(run) for run in runs), np.uint64, len(runs))
    return [int((hashes * order).min() >> np.uint64(1)) for order in ORDERS]


def _sample(documents: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str) -> DataFrame:
    """(text, label) of the bounded set of labelled training documents, one of each family of copies.

    Copies say the same thing again and again, and would make telling words of all words they have.
    """
    usable = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    usable = usable.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (crc_mod(F.col("id"), 4) != 2))
    usable = usable.groupBy("id").agg(F.max("label").alias("label"))
    order = F.xxhash64(F.lit(3), "id"), F.col("id")
    chosen = stored(usable.where("label = 1").orderBy(*order).limit(TOXIC_DOCS), "toxic-docs").union(
        stored(usable.where("label = 0").orderBy(*order).limit(CLEAN_DOCS), "clean-docs")
    )
    docs = documents.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sample = stored(docs.join(F.broadcast(chosen), "id").select("id", "text", "label"), "toxicity-sample")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [family_keys(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(len(ORDERS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "k0", "k1", "k2", "k3"])

    kind = sample.schema["id"].dataType.simpleString()
    families = sample.mapInArrow(keys, f"id {kind}, k0 long, k1 long, k2 long, k3 long").toPandas().sort_values("id")
    for key in ("k0", "k1", "k2", "k3"):
        families = families.drop_duplicates(key)
    if families.empty:
        return sample.select("text", "label")
    kept = sample.sparkSession.createDataFrame([(k,) for k in families["id"].tolist()], f"id {kind}")
    return sample.join(F.broadcast(kept), "id").select("text", "label")


class Model:
    """Weights of subsequences, bias, and the line that turns a machine value into a probability."""

    def __init__(self, table: np.ndarray | None, bias: float, slope: float, offset: float):
        self.table, self.bias, self.slope, self.offset = table, bias, slope, offset

    def scores(self, texts: list[str]) -> np.ndarray:
        value = np.zeros(len(texts)) if self.table is None else worst_words(texts, self.table, self.bias)
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.offset, -30, 30)))


def _raw(sample: DataFrame, table: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = worst_words(batch.column(0).to_pylist(), table, bias)
            yield pa.RecordBatch.from_arrays([pa.array(value), batch.column(1)], names=["value", "label"])

    rows = sample.mapInArrow(run, "value double, label int").toPandas()
    return rows["value"].to_numpy(float), rows["label"].to_numpy(float)


def _probability_line(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the label by the value, with Platt's softened targets."""
    ones, zeros = label.sum(), len(label) - label.sum()
    target = np.where(label > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x, w = np.stack([value, np.ones(len(value))], axis=1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-6 * w)
        step *= min(1.0, 5.0 / max(1e-9, abs(step).max()))
        w -= step
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> Model:
    """Learn from the labels outside the held-out quarter. Without both classes the score is the labels' share."""
    sample = _sample(documents, labels, label, doc_id, text)
    counts = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)

    def constant() -> Model:
        share = (n_toxic + 1) / (n_toxic + n_clean + 2) if n_toxic else 0.0
        return Model(None, 0.0, 0.0, float(np.log(share / (1 - share))) if share else -30.0)

    if not n_toxic or not n_clean:
        return constant()

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, marks = [], []
            for value, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for piece in _slices(value):
                    symbols, starts, sizes, _ = windows([piece])
                    raw = symbols.tobytes()
                    mine = {raw[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True) if n >= 3}
                    words += mine
                    marks += [mark] * len(mine)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(marks, pa.int32())], names=["word", "mark"])

    seen = sample.mapInArrow(distinct_words, "word binary, mark int").groupBy("word")
    seen = seen.agg(F.sum("mark").alias("toxic"), F.sum(1 - F.col("mark")).alias("clean"))
    share = n_toxic / (n_toxic + n_clean)
    n, t, c = F.col("toxic") + F.col("clean"), F.col("toxic"), F.col("clean")
    # How far the word's share of toxic documents is from what chance would give.
    surprise = 2 * (
        t * F.log(F.greatest(t, F.lit(1)) / (n * F.lit(share))) + c * F.log(F.greatest(c, F.lit(1)) / (n * F.lit(1 - share)))
    )
    seen = stored(seen.withColumn("surprise", surprise), "toxicity-words")
    telling = (t / n >= PURITY) & (F.col("surprise") >= EVIDENCE)
    toxic = [bytes(r["word"]) for r in seen.where(telling).orderBy(F.desc("surprise"), "word").limit(TOXIC_WORDS).collect()]
    harmless = seen.where(~telling & (c > 0) & (t / n <= F.lit(2 * share)))
    order = F.xxhash64(F.lit(5), "word")
    clean = [bytes(r["word"]) for r in harmless.orderBy(order, "word").limit(CLEAN_WORDS).collect()]
    if not toxic or not clean:
        return constant()
    table, bias = _trained(toxic, clean)
    for _ in range(2):
        # Harmless words that the machine takes for toxic join what it learns from.
        def value_of(batches: Iterator[pa.RecordBatch], table=table, bias=bias) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = batch.column(0).to_pylist()
                codes, owners, weights = Kernel._triplets(words)
                value = np.bincount(owners, weights * table[codes], len(words)) + bias
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["word", "value"])

        hard = harmless.select("word").mapInArrow(value_of, "word binary, value double").where("value > -1")
        more = [bytes(r["word"]) for r in hard.orderBy(F.desc("value"), "word").limit(CLEAN_WORDS // 2).collect()]
        clean = list(dict.fromkeys(clean + more))
        table, bias = _trained(toxic, clean)
    return Model(table, bias, *_probability_line(*_raw(sample, table, bias)))


def score(documents: DataFrame, model: Model, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row; no shuffle.

    Null and empty texts score as texts without words. Null ids and repeated rows
    pass through (a null id counts as empty text in ``held_out``), an empty table
    gives no rows, other columns are not read.
    """
    known = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = known.value.scores([t or "" for t in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = documents.select(
        F.col(doc_id).alias("doc_id"), (crc_mod(F.col(doc_id), 4) == 2).alias("held_out"), F.col(text).cast("string").alias("text")
    )
    kind = documents.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
