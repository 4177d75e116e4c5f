"""Token counts and ids through the tokenizers library, one piece at a time.

A byte-level tokenizer of this family cuts a text into pre-tokens first and
merges inside each alone. A single space between two other characters always
begins a pre-token, so a text without runs or edges of white space can be cut at
its spaces, and each word with its space can be looked up. What a worker has
looked up it remembers within bounds, from task to task. Ids are looked up for
the words of many texts at once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entries of each of two generations of a worker's memory of words; bounds its size.
REMEMBERED_WORDS = 250_000
# A longer word is not kept, so that the memory is bounded in bytes as well.
LONGEST_KEPT = 64


class Remembered:
    """A bounded memory: what was not asked for during a whole generation goes."""

    def __init__(self, limit: int = REMEMBERED_WORDS):
        self.limit, self.new, self.old = limit, {}, {}

    def fill(self, keys: set, compute: Callable[[list], list]) -> dict:
        """Values of ``keys``, all of them absent from ``new``."""
        values, missing = {}, []
        for key in keys:
            value = self.old.get(key)
            if value is None:
                missing.append(key)
            else:
                values[key] = value
        if missing:
            values.update(zip(missing, compute(missing), strict=True))
        for key, value in values.items():
            if len(key) <= LONGEST_KEPT:
                self.new[key] = value
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        return values


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, loaded once in a process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def cuttable(text: str) -> bool:
    """Whether ``text`` can be cut at its spaces.

    Not where that may not be exact: unless every space stands
    alone between two printable characters, and no white space but line feeds occurs.
    """
    if text == "":
        return True
    flat = text.replace("\n", "x")
    return not (
        "  " in text or not flat.isprintable() or text[0] in " \n" or text[-1] in " \n" or " \n" in text or "\n " in text
    )


def safe_words(text: str) -> list[str] | None:
    """The words of ``text``, between its spaces; None where it is not :func:`cuttable`."""
    if text == "":
        return []
    return text.split(" ") if cuttable(text) else None


# Before a piece that has no space before it; no text that is cut holds this character.
BARE = "\t"
# Pieces that go through the library in one string.
JOINED = 64
# A pre-token surely ends between a letter of the plain alphabets and one final mark.
FINAL_MARK = r"[A-Za-zÀ-ÖØ-öø-ɏ][.,;:!?]$"


def lines_apart(text: str) -> str:
    """A :func:`cuttable` text, marked so that its spaces alone cut it: a lone line feed is a pre-token of its own."""
    if "\n\n" in text:
        return BARE + re.sub(r"(?<!\n)\n(?!\n)", f" {BARE}\n {BARE}", text)
    return BARE + text.replace("\n", f" {BARE}\n {BARE}")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, as the library gives them.

    Texts that hold no added token's string are cut into words, lone line feeds and
    final marks, told apart as an Arrow column, so each is looked up once a call.
    What was not met before goes through the library joined by spaces (by line
    feeds what had no space before it): where as many tokens begin
    with one as were joined, the ids are cut there, else each goes through alone.
    What is remembered lies in Arrow columns as well, some 40 bytes a piece; at
    ``limit`` pieces those not asked for again since the last time go.
    """

    def __init__(self, path: str, limit: int = 400_000):
        self.known, self.limit = tokenizer(path), limit
        tokens = [self.known.id_to_token(i) or "" for i in range(self.known.get_vocab_size())]
        # The library writes a space as U+0120 and a line feed as U+010A.
        self.begins = {" ": np.array([t.startswith("\u0120") for t in tokens]), "\n": np.array([t == "\u010a" for t in tokens])}
        self.added = [token.content for token in self.known.get_added_tokens_decoder().values()]
        self.pieces, self.lists = pa.array([], pa.string()), pa.array([], pa.list_(pa.uint32()))
        self.asked = np.zeros(0, bool)

    def encoded(self, items: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.known.encode_batch_fast(items, add_special_tokens=False)]

    def _joined(self, pieces: pa.Array, mark: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids of groups of pieces, the number of ids of each piece); a space belongs to its piece, a line feed does not."""
        n, found, lengths = len(pieces), [], []
        ends = pa.array(np.append(np.arange(0, n, JOINED), n).astype(np.int32))
        groups = pc.binary_join(pa.ListArray.from_arrays(ends, pieces), mark).to_pylist()
        for at in range(0, len(groups), JOINED):
            some = groups[at : at + JOINED]
            for k, ids in enumerate(self.encoded([mark + group for group in some]), at):
                size = min(JOINED, n - k * JOINED)
                marked = self.begins[mark][ids]
                begins = np.flatnonzero(marked)
                if len(begins) != size or begins[0] != 0:
                    alone = self.encoded([" " * (mark == " ") + piece for piece in pieces.slice(k * JOINED, size).to_pylist()])
                    found.append(np.concatenate(alone))
                    lengths.append(np.array([len(one) for one in alone]))
                else:
                    found.append(ids if mark == " " else ids[~marked])
                    lengths.append(np.diff(begins, append=len(ids)) - (mark != " "))
        return found, lengths

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces not met before, a list each."""
        bare = pc.starts_with(pieces, BARE).to_numpy(zero_copy_only=False)
        found, lengths = self._joined(pieces.filter(pa.array(~bare)), " ")
        cut = self._joined(pc.utf8_slice_codeunits(pieces.filter(pa.array(bare)), len(BARE)), "\n")
        found, lengths = [*found, *cut[0]], [*lengths, *cut[1]]
        offsets = pa.array(np.cumsum(np.concatenate([[0], *lengths])).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found).astype(np.uint32)))
        return lists.take(pa.array(np.argsort(np.argsort(bare, kind="stable"))))

    def _remember(self, pieces: pa.Array, lists: pa.Array) -> None:
        short = pc.less_equal(pc.utf8_length(pieces), LONGEST_KEPT)
        pieces, lists = pieces.filter(short), lists.filter(short)
        if len(self.pieces) + len(pieces) > self.limit:
            kept = pa.array(np.flatnonzero(self.asked)[: self.limit // 2])
            self.pieces, self.lists, self.asked = self.pieces.take(kept), self.lists.take(kept), np.zeros(len(kept), bool)
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.lists = pa.concat_arrays([self.lists, lists])
        self.asked = np.append(self.asked, np.zeros(len(pieces), bool))

    def _of_pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of different pieces, a list each."""
        if 0 < JOINED * len(pieces) < len(self.pieces):  # looking up reads all that is remembered
            return self._learn(pieces)
        at = pc.index_in(pieces, value_set=self.pieces)
        missing = at.is_null()
        new = missing.to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy(zero_copy_only=False).copy()
        self.asked[at[~new]] = True
        if not new.any():
            return self.lists.take(pa.array(at))
        fresh = pieces.filter(missing)
        learned = self._learn(fresh)
        at[new] = len(self.lists) + np.arange(len(fresh))
        lists = pa.concat_arrays([self.lists, learned]).take(pa.array(at))
        self._remember(fresh, learned)
        return lists

    def _of_words(self, words: pa.Array) -> pa.Array:
        """Ids of different words, a list each; a final mark is a piece of its own."""
        marked = pc.match_substring_regex(words, FINAL_MARK)
        ending = words.filter(marked)
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words)
        finals = pc.binary_join_element_wise(pa.scalar(BARE), pc.utf8_slice_codeunits(ending, -1), "")
        told = pa.concat_arrays([stems, finals]).dictionary_encode()
        pieces, places = self._of_pieces(told.dictionary), told.indices.to_numpy()
        sizes = 1 + marked.to_numpy(zero_copy_only=False).astype(np.int32)
        ends = np.cumsum(sizes)
        order = np.empty(len(places), np.int32)
        order[ends - sizes] = places[: len(words)]
        order[ends[sizes == 2] - 1] = places[len(words) :]
        lists = pieces.take(pa.array(order))
        offsets = lists.offsets.to_numpy()[np.append(0, ends)]
        return pa.ListArray.from_arrays(pa.array(offsets), lists.values)

    def ids(self, texts: list[str]) -> list[bytes]:
        cut = [cuttable(text) and not any(a in text for a in self.added) for text in texts]
        wholes = iter(self.encoded([text for text, plain in zip(texts, cut, strict=True) if not plain]))
        marked = pa.array([lines_apart(text) for text, plain in zip(texts, cut, strict=True) if plain and text], pa.string())
        words = pc.split_pattern(marked, " ")
        ends, told = words.offsets.to_numpy(), words.flatten().dictionary_encode()
        del marked, words
        stream = self._of_words(told.dictionary).take(told.indices)
        ends = stream.offsets.to_numpy()[ends].tolist()
        raw = memoryview(stream.values.to_numpy().astype("<u4", copy=False)).cast("B")
        parts = (bytes(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:]))
        return [(next(parts) if text else b"") if plain else next(wholes).tobytes() for text, plain in zip(texts, cut, strict=True)]


# The library's own pre-token pattern: a fixed value.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def proven_whole(path: str) -> tuple[frozenset[str], frozenset[str]]:
    """(strings proven to encode alone as one token, added tokens' strings).

    Each string of the vocabulary goes through the whole library alone. It
    counts as proven if it comes back as one id and is one pre-token; nothing is
    assumed from the order of merges. The vocabulary's size bounds the result.
    """
    import regex

    known = tokenizer(path)
    pattern = regex.compile(PRE_TOKEN)
    added = frozenset(token.content for token in known.get_added_tokens_decoder().values())
    strings = [s for s in known.decode_batch([[i] for i in range(known.get_vocab_size(False))], skip_special_tokens=False)]
    strings = [s for s in strings if s and "�" not in s and not any(a in s for a in added)]
    encoded = known.encode_batch_fast(strings, add_special_tokens=False)
    whole = frozenset(
        s for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1 and pattern.findall(s) == [s]
    )
    return whole, added


class Counter:
    """Token counts of texts: proven pre-tokens count one, the rest is merged by the library."""

    def __init__(self, path: str, whole: frozenset[str], added: frozenset[str]):
        import regex

        self.known, self.whole, self.added = tokenizer(path), whole, added
        self.find = regex.compile(PRE_TOKEN).findall
        self.words, self.pieces = Remembered(), Remembered()
        # Ranges in which the library's character classes and the pattern's are the same.
        self.agreed = regex.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*").fullmatch

    def merged(self, items: list[str]) -> list[int]:
        return [len(e.ids) for e in self.known.encode_batch_fast(items, add_special_tokens=False)]

    def in_words(self, items: list[str]) -> list[int]:
        """Counts of words, or of whole texts, each cut into pre-tokens."""
        cuts, totals = [], []
        for item in items:
            plain = self.agreed(item) and not any(a in item for a in self.added)
            cuts.append(self.find(item) if plain else None)
        rest = {p for cut in cuts if cut for p in cut if p not in self.whole and p not in self.pieces.new}
        values = self.pieces.fill(rest, self.merged) if rest else {}
        kept = self.pieces.new
        for item, cut in zip(items, cuts, strict=True):
            if cut is None:
                totals.append(self.merged([item])[0])
                continue
            n = 0
            for piece in cut:
                if piece in self.whole:
                    n += 1
                else:
                    n += values[piece] if piece in values else kept.get(piece) or self.merged([piece])[0]
            totals.append(n)
        return totals

    def count(self, text: str) -> int:
        cut = safe_words(text)
        if cut is None:
            return self.in_words([text])[0]
        cut[1:] = [" " + word for word in cut[1:]]
        got = list(map(self.words.new.get, cut))
        if None not in got:
            return sum(got)
        values = self.words.fill({word for word, n in zip(cut, got, strict=True) if n is None}, self.in_words)
        return sum(values[word] if n is None else n for word, n in zip(cut, got, strict=True))


@lru_cache(maxsize=2)
def _counter(path: str, whole: frozenset[str], added: frozenset[str]) -> Counter:
    return Counter(path, whole, added)


def token_counts(documents: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document, whole texts, no shuffle.

    A null or empty text has no bytes and no tokens; null ids and repeated rows
    pass through as they are; an empty table gives no rows. Other columns are
    not read. Special strings inside a text count as the library counts them.
    """
    spark = documents.sparkSession
    proof = spark.sparkContext.broadcast(proven_whole(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, *proof.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = [counter.count(t) for t in texts]
            size = [len(t.encode("utf-8")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[doc_id, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id), F.col(text).cast("string"))
    return rows.mapInArrow(run, f"{doc_id} {kind}, n_bytes long, n_tokens long, over_limit boolean")
