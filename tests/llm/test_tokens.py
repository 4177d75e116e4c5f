import random
import zlib

import numpy as np
import pytest

from plumbline.llm import planes, tokens

PIECES = [
    "a", " ", "  ", "\n", "the", "'s", " 're", "\t", "é", "1", "½", "٣", "ば", "😀", "!", ".", ",", ".\n", "<|endoftext|>",
    "x<|endo", "\x1c", "\x85", "ing", " Ⅷ", "́", "\r\n", "ǅ", "\xa0", "The",
]
ODD = [(5, None), (1, ""), (2, "  lead and trail  "), (None, "no id"), (2, "same id"), (2, "same id"), (9, "x" * 70_000), (8, "word " * 30_000)]


def odd_texts(n=4000, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def library(path, texts):
    return [e.ids for e in tokens.tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def test_counts_and_ids_are_the_librarys(vocabulary):
    texts = odd_texts()
    counter = tokens.Counter(vocabulary, *tokens.proven_whole(vocabulary))
    encoder = tokens.Encoder(vocabulary, limit=300)
    ids = [b for at in range(0, len(texts), 50) for b in encoder.ids(texts[at : at + 50])]
    for text, want, got in zip(texts, library(vocabulary, texts), ids, strict=True):
        assert counter.count(text) == len(want), repr(text)
        assert np.frombuffer(got, "<u4").tolist() == want, repr(text)


class Counted(tokens.Encoder):
    strings = 0

    def encoded(self, items):
        self.strings += len(items)
        return super().encoded(items)


def new_words(n, seed=5):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(rng.randint(6, 10))) for _ in range(n)})


def test_new_words_go_through_the_library_together(vocabulary):
    """A string of its own for each of them took 738 CPU seconds a GB in op9_token_planes."""
    words, encoder = new_words(20_000), Counted(vocabulary)
    texts = [f"{' '.join(words[at : at + 20])}.\n{words[at].title()}, {words[at]}; {words[at]}" for at in range(0, len(words), 20)]
    got = encoder.ids(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == library(vocabulary, texts)
    assert encoder.strings < len(words) / 20
    met = encoder.strings
    assert encoder.ids(texts) == got and encoder.strings == met


def test_what_is_remembered_is_small(vocabulary):
    """Workers that are used again keep it through all stages of the pipeline."""
    import gc
    import tracemalloc

    import pyarrow as pa

    words, encoder = new_words(50_000), tokens.Encoder(vocabulary)
    texts = [" ".join(words[at : at + 50]) for at in range(0, len(words), 50)]
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    encoder.ids(texts)
    gc.collect()
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 80 * len(words)


@pytest.mark.parametrize("limit", [0, 40, 400_000])
def test_pieces_are_the_librarys_whatever_is_remembered(vocabulary, limit):
    rng, encoder = random.Random(11), tokens.Encoder(vocabulary, limit)
    ends = [" ", " ", ", ", ".\n", "\n", "\n\n", "\n\n\n", ".. ", "1. ", "ß: ", "ⅷ. ", "中! ", "<|endoftext|> ", "'s. ", "é;\n", " '"]
    words = ["a", "The", "it", "Straße", "x" * 70, "don't", "日本語", "Ġ", "\u010a", "7", "-", "<b>"]
    texts = ["".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(1, 12))) + "z." for _ in range(3000)]
    for at in range(0, len(texts), 300):
        some = texts[at : at + 300]
        got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.ids(some)]
        for text, one, want in zip(some, got, library(vocabulary, some), strict=True):
            assert one == want, repr(text)


def test_pattern_agrees_with_the_library_on_its_alphabets(vocabulary):
    import regex

    known, find = tokens.tokenizer(vocabulary), regex.compile(tokens.PRE_TOKEN).finditer
    for point in [9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250)]:
        for text in (f"a{chr(point)}b", f" {chr(point)}1", f"!{chr(point)}{chr(point)} {chr(point)}"):
            assert [m.span() for m in find(text)] == [span for _, span in known.pre_tokenizer.pre_tokenize_str(text)]


def test_whole_tokens_are_proven(vocabulary):
    whole, added = tokens.proven_whole(vocabulary)
    assert len(whole) > 45_000 and "<|endoftext|>" in added and "<|endoftext|>" not in whole


def test_counts_of_odd_rows(make_docs, vocabulary):
    rows = tokens.token_counts(make_docs(ODD), vocabulary).collect()
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in rows)
    want = []
    for key, text in ODD:
        n = len(library(vocabulary, [text or ""])[0])
        want.append((key or 0, len(text or ""), n, n > 512))
    assert got == sorted(want)
    assert tokens.token_counts(make_docs([]), vocabulary).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 256, 1000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint32)
        index, payload = planes.pack(ids, kind, 256)
        segment = {"n_ids": n, "block_ids": 256, "kind": kind, "index": index, "payload": payload}
        assert (planes.unpack(segment) == ids).all()
        assert (planes.unpack(segment, 200, 600) == ids[200:600]).all()
        assert len(index) == -(-n // 256) * planes.PLANES[kind]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_hold_all_ids_in_order(spark, make_docs, vocabulary, tmp_path, kind):
    folder = str(tmp_path / "ids")
    planes.write_ids(make_docs(ODD), folder, vocabulary, kind=kind, block_ids=128, segment_ids=500)
    got = planes.read_documents(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 2, 2, 5, 8, 9]
    stream, at = [], 0
    for row in got:
        assert row.start == at and row.n_tokens == len(row.ids) and row.ids[-1] == 0
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
        stream, at = stream + row.ids, at + row.n_tokens
    by_text = sorted(tuple(i) for i in library(vocabulary, [t or "" for _, t in ODD]))
    assert sorted(tuple(r.ids[:-1]) for r in got) == by_text
    pieces = planes.read_range(spark, folder, 90, 2000).orderBy("start").collect()
    assert [i for p in pieces for i in p.ids] == stream[90:2000]


def test_no_documents_give_no_segments(spark, make_docs, vocabulary, tmp_path):
    folder = str(tmp_path / "none")
    planes.write_ids(make_docs([]), folder, vocabulary)
    assert planes.read_documents(spark, folder).count() == 0
    assert planes.read_range(spark, folder, 0, 10).count() == 0
