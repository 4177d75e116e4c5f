"""URL rules as one bit-parallel automaton.

Every glob takes one bit per literal byte and one to begin with, all of them
packed into 64-bit words. Reading a byte moves every glob of every URL of a batch
at once: shift, mask with the positions that hold this byte, and keep the
positions where a wildcard waits. ``*`` stands for any run of bytes but ``/``,
``**`` for any run; everything else is literal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import LOWER, UPPER


class Automaton:
    """Shift-And over several words for a list of globs; its size is that of the rules."""

    def __init__(self, globs: list[str]):
        literals, any_run, one_run, firsts, lasts = [], [], [], [], []
        for glob in globs:
            firsts.append(len(literals))
            literals.append(None)
            at = 0
            raw = glob.encode("utf-8")
            while at < len(raw):
                if raw[at : at + 2] == b"**":
                    any_run.append(len(literals) - 1)
                    at += 2
                elif raw[at : at + 1] == b"*":
                    one_run.append(len(literals) - 1)
                    at += 1
                else:
                    literals.append(raw[at])
                    at += 1
            lasts.append(len(literals) - 1)
        self.words = max(1, -(-len(literals) // 64))
        self.lasts = np.array(lasts, np.int64)
        self.begin = self._mask(firsts)
        always, within = self._mask(any_run), self._mask(one_run)
        self.stay = np.tile(always | within, (256, 1))
        self.stay[ord("/")] = always
        places: dict[int, list[int]] = {}
        for at, byte in enumerate(literals):
            if byte is not None:
                places.setdefault(byte, []).append(at)
        self.match = np.zeros((256, self.words), np.uint64)
        for byte, at in places.items():
            self.match[byte] = self._mask(at)

    def _mask(self, positions: list[int]) -> np.ndarray:
        mask = np.zeros(self.words, np.uint64)
        for at in positions:
            mask[at // 64] |= np.uint64(1 << at % 64)
        return mask

    def accepts(self, texts: list[bytes]) -> np.ndarray:
        """Which globs (columns) match which whole texts (rows)."""
        state = np.tile(self.begin, (len(texts), 1))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        buffer = np.frombuffer(b"".join(texts) or b"\0", np.uint8)
        starts = (np.cumsum(lengths) - lengths)[order]
        ending = lengths[order]
        running = state[order]
        active = len(texts)
        for step in range(int(ending[0]) if len(texts) else 0):
            while ending[active - 1] <= step:
                active -= 1
            byte = buffer[starts[:active] + step]
            now = running[:active]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            running[:active] = (moved & self.match[byte]) | (now & self.stay[byte])
        state[order] = running
        word, bit = self.lasts // 64, (self.lasts % 64).astype(np.uint64)
        return (state[:, word] >> bit & np.uint64(1)).astype(bool)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    globs: list[tuple[str, str]] = (),
    otherwise: str = "allow",
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    ``rules`` are (host, path, verdict): a rule fits its host and all below it if
    the path starts with the rule's; the longest fitting rule decides, of equally
    long ones the first. Where none fits, ``rule`` is null and the first fitting of
    ``globs`` (glob over ``.host/path``, verdict) decides, then ``otherwise``. A null URL or
    one without ``://`` has an empty host and path and fits no rule. Rows map
    one to one, without a shuffle; other columns are not read.
    """
    ranked = sorted(rules, key=lambda rule: -len(rule[0] + rule[1]))
    names = [host + path for host, path, _ in ranked]
    escaped = [f"*.{host}{path}**" for host, path, _ in ranked]
    verdicts = [verdict for _, _, verdict in ranked] + [verdict for _, verdict in globs] + [otherwise]
    compiled = Automaton(escaped + [glob for glob, _ in globs])
    n_rules, n_all = len(names), len(verdicts) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            fits = compiled.accepts([f".{h}{p}".encode() for h, p in zip(hosts, paths, strict=True)])
            best = np.where(fits.any(axis=1), fits.argmax(axis=1), n_all) if n_all else np.zeros(len(hosts), int)
            rule = [names[k] if k < n_rules else None for k in best.tolist()]
            verdict = [verdicts[k] for k in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    kind = pages.schema[page_id].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
