"""Languages of a text as a mixture, by expectation-maximisation.

Every language is a distribution over letter trigrams, counted over all labelled
training texts. A text is a mixture of them: its shares are those under which its
trigrams are likeliest, and the set of languages is cut back as long as what is
lost in log-likelihood is less than the penalty for a language (after Lui, Lau and
Baldwin, "Automatic Detection and Language Identification of Multilingual
Documents", 2014). Trigrams fall into a fixed number of slots by hash, so the size
of the model is bounded by the number of languages alone, whatever the corpus.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import stored

# Slots for trigrams, halved as often as it takes to keep slots x languages below MODEL_CELLS.
SLOTS, MODEL_CELLS = 1 << 16, 1 << 22
# A label column with more values than this is no list of languages.
MOST_LANGUAGES = 1 << 12
# Log-likelihood a further language must bring, in units of the logarithm of the number of trigrams.
PENALTY = 3.0
ROUNDS = 30
# Shares below this are dropped together in one step.
NEGLIGIBLE = 1e-3
# Trigrams times languages that are held at once.
CELLS_AT_ONCE = 1 << 22
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _folding() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter or mark, 0 for anything else; and whether it is a letter."""
    fold, letter = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            fold[code], letter[code] = ord(low) if len(low) == 1 else code, True
        elif code > 0x2FF and unicodedata.category(char)[0] == "M":
            fold[code] = code
    return fold, letter


def _slots(text: str, slots: int) -> np.ndarray:
    """Slot of every trigram of the letters of ``text``; whatever lies between letters is one gap."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    fold, letter = _folding()
    if not letter[codes].any():
        return np.zeros(0, np.int64)
    low = np.concatenate([[0], fold[codes], [0]]).astype(np.uint64)
    low = low[np.concatenate([[True], (low[1:] != 0) | (low[:-1] != 0)])]
    mixed = (low[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (low[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (low[2:] * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    # A trigram with the gap in its middle holds no word.
    return (mixed[low[1:-1] != 0] >> np.uint64(40)).astype(np.int64) & (slots - 1)


def _pieces(text: str, size: int) -> Iterator[str]:
    """A long text in pieces of ``size`` characters, each overlapping the one before by two."""
    for start in range(0, max(len(text) - 2, 1), size):
        yield text[start : start + size + 2]


def gram_counts(text: str, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots that occur, how often), both empty for a text without letters."""
    if len(text) <= CELLS_AT_ONCE:
        found = _slots(text, slots)
        if len(found) * 8 < slots:
            at, n = np.unique(found, return_counts=True)
            return at, n.astype(np.float64)
        whole = np.bincount(found, minlength=slots)
    else:
        whole = sum(np.bincount(_slots(piece, slots), minlength=slots) for piece in _pieces(text, CELLS_AT_ONCE))
    at = np.flatnonzero(whole)
    return at, whole[at].astype(np.float64)


@dataclass(frozen=True)
class Languages:
    """Names in code-point order, and the probability of a slot (row) in each of them."""

    names: tuple[str, ...]
    probability: np.ndarray

    @property
    def slots(self) -> int:
        return len(self.probability)


def train(documents: DataFrame, where: Column | None = None, text: str = "text", lang: str = "lang") -> Languages:
    """The languages of ``lang``, each from the trigrams of all rows with that label.

    Rows without a label or without letters teach nothing; repeated rows count as
    often as they occur; an empty table gives a model without languages. Tasks
    count before the shuffle, so a language with a third of all rows is no hot key.
    """
    rows = documents if where is None else documents.where(where)
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    found = rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"{lang} has more than {MOST_LANGUAGES} values")
    names = tuple(sorted(row.lang for row in found))
    slots = SLOTS
    while slots * len(names) > MODEL_CELLS:
        slots //= 2
    number = {name: k for k, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for label, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, n = gram_counts(one, slots)
                totals.setdefault(number[label], np.zeros(slots))[at] += n
        for k, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))],
                names=["number", "slot", "n"],
            )

    counted = rows.mapInArrow(count, "number int, slot int, n long").groupBy("number", "slot").agg(F.sum("n").alias("n"))
    seen = counted.toPandas()
    counts = np.zeros((slots, len(names)))
    counts[seen["slot"].to_numpy(np.int64), seen["number"].to_numpy(np.int64)] = seen["n"].to_numpy(np.float64)
    taught = counts.any(axis=0)
    names, counts = tuple(name for name, k in zip(names, taught, strict=True) if k), counts[:, taught]
    # What was not met weighs as much as there were different trigrams (Witten and Bell, 1991), so a
    # language of a few sentences keeps most of its weight on what it was taught.
    unmet = (counts > 0).sum(axis=0)
    return Languages(names, (counts + unmet / slots) / (counts.sum(axis=0) + unmet))


def _fitted(p: np.ndarray, n: np.ndarray, starts: np.ndarray, owner: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares, log-likelihood) of every text within its ``active`` languages, by expectation-maximisation."""
    shares = active / active.sum(axis=1, keepdims=True)
    total = np.add.reduceat(n, starts)[:, None]
    for _ in range(ROUNDS):
        joint = p * shares[owner]
        joint *= (n / joint.sum(axis=1))[:, None]
        shares = np.add.reduceat(joint, starts) / total
    return shares, np.add.reduceat(n * np.log((p * shares[owner]).sum(axis=1)), starts)


def mixtures(model: Languages, counted: list[tuple[np.ndarray, np.ndarray]], penalty: float = PENALTY) -> np.ndarray:
    """Shares (a row a text) of the languages chosen by penalised likelihood; every text has at least one trigram."""
    sizes = np.array([len(at) for at, _ in counted])
    slots, n = np.concatenate([at for at, _ in counted]), np.concatenate([n for _, n in counted])
    p, starts, owner = model.probability[slots], np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(sizes)), sizes)
    price = penalty * np.log(np.add.reduceat(n, starts) + 1)
    alone = np.add.reduceat(n[:, None] * np.log(p), starts)
    shares = np.zeros((len(sizes), len(model.names)))
    shares[np.arange(len(sizes)), alone.argmax(axis=1)] = 1.0
    # All languages together bound what any set of them reaches: most texts end here with one.
    mixed, likely = _fitted(p, n, starts, owner, np.ones_like(shares))
    todo = np.flatnonzero(likely - alone.max(axis=1) > price)
    if not len(todo):
        return shares
    keep = np.isin(owner, todo)
    p, n, sizes = p[keep], n[keep], sizes[todo]
    starts, owner = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(todo)), sizes)
    mixed, likely, price = mixed[todo], likely[todo], price[todo]
    active, moving = np.ones_like(mixed, dtype=bool), np.ones(len(todo), bool)
    while moving.any():
        # The smallest share goes, or all negligible ones at once.
        ranked = np.where(active, mixed, np.inf)
        least = ranked.min(axis=1)
        drop = active & (ranked <= np.maximum(least, np.where(least < NEGLIGIBLE, NEGLIGIBLE, 0))[:, None])
        moving &= (active & ~drop).any(axis=1)
        trial = np.where(moving[:, None], active & ~drop, active)
        fewer, less = _fitted(p, n, starts, owner, trial)
        good = moving & (likely - less < price * (active.sum(axis=1) - trial.sum(axis=1)))
        active[good], mixed[good], likely[good] = trial[good], fewer[good], less[good]
        moving = good & (active.sum(axis=1) > 1)
    one = active.sum(axis=1) == 1
    shares[todo[~one]] = mixed[~one]
    return shares


def identify(
    documents: DataFrame,
    model: Languages,
    penalty: float = PENALTY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, lang, score and languages (lang, share; largest first) of every row, from whole texts, without a shuffle.

    ``lang`` is the language with the largest share, the first in code-point order on
    a tie, and ``score`` its share. A text that is null or has no letter is
    ``und`` with a score of 0 and no languages, and so is every text if the model has
    none. Null ids, repeated rows and an empty table pass through; other columns are not read.
    """
    known = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        names = np.array(model.names, dtype=object)
        room = CELLS_AT_ONCE // max(len(names), 1)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            best, score, parts = [UNDETERMINED] * len(texts), [0.0] * len(texts), [[] for _ in texts]

            def settle(rows: list[int], counted: list[tuple[np.ndarray, np.ndarray]]) -> None:
                for row, shares in zip(rows, mixtures(model, counted, penalty), strict=True):
                    order = [k for k in np.argsort(-shares, kind="stable") if shares[k] > 0]
                    best[row], score[row] = names[order[0]], min(float(shares[order[0]]), 1.0)
                    parts[row] = [{"lang": names[k], "share": float(shares[k])} for k in order]

            rows, counted, held = [], [], 0
            for row, one in enumerate(texts if len(names) else ()):
                at, n = gram_counts(one or "", model.slots)
                if len(at):
                    rows.append(row)
                    counted.append((at, n))
                    held += len(at)
                if held > room:
                    settle(rows, counted)
                    rows, counted, held = [], [], 0
            if rows:
                settle(rows, counted)
            shape = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(parts, shape)],
                names=[doc_id, "lang", "score", "languages"],
            )

    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id), F.col(text).cast("string"))
    return rows.mapInArrow(run, f"{doc_id} {kind}, lang string, score double, languages array<struct<lang:string,share:double>>")
