"""Texts as runs of recurring pieces, so that a tokenizer sees every distinct piece once."""

from __future__ import annotations

import re
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidegrid.llm.common import ramps

# White space that may stand before a space, where a text must not be cut.
SPACES = "\t\n\v\f\r \x1c\x1d\x1e\x1f\x85\xa0                　"
ASCII_RUNS = [c + " " for c in SPACES if ord(c) < 128]
OTHER_RUNS = [c + " " for c in SPACES if ord(c) >= 128]
CUT = re.compile(r"(?<=\S)(?= )")
RUN = re.compile(r"\s ")


class _Numbers(dict):
    def __init__(self, texts: list[str], prefix: str):
        self.texts, self.prefix = texts, prefix

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self.texts)
        self.texts.append(self.prefix + key)
        return n


class Pieces:
    """Numbers for pieces of texts, cut before each space that follows a visible character.

    Patterns that begin a new match there (a space belongs to the word behind it) give the same matches for the pieces one
    by one as for the whole text.
    """

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.opening, self.following = _Numbers(self.texts, ""), _Numbers(self.texts, " ")

    def __len__(self) -> int:
        return len(self.texts)

    def numbers(self, text: str) -> list[int]:
        if RUN.search(text):
            parts = [p if k == 0 else p[1:] for k, p in enumerate(CUT.split(text))]
        else:
            parts = text.split(" ")
        return [self.opening[parts[0]], *map(self.following.__getitem__, parts[1:])] if text else []

    def of_block(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts behind each other, and how many each text has; a word of the block is looked up once."""
        runs = [k for k, t in enumerate(texts) if t and RUN.search(t)]
        apart = set(runs)
        plain = pa.array(["" if k in apart else t or "" for k, t in enumerate(texts)], pa.large_string())
        parts = pc.split_pattern(plain, " ")
        n = np.diff(parts.offsets.to_numpy())
        coded = parts.flatten().dictionary_encode()
        codes, kinds = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        opens = np.zeros(len(codes), bool)
        opens[np.cumsum(n) - n] = True
        out = np.zeros(len(codes), np.int64)
        for own, numbers in ((opens, self.opening), (~opens, self.following)):
            used = np.zeros(len(kinds), bool)
            used[codes[own]] = True
            number = np.zeros(len(kinds), np.int64)
            number[used] = np.fromiter(map(numbers.__getitem__, compress(kinds, used.tolist())), np.int64, np.count_nonzero(used))
            out[own] = number[codes[own]]
        empty = pc.equal(pc.binary_length(plain), 0).to_numpy(zero_copy_only=False)
        out, n = out[~np.repeat(empty, n)], np.where(empty, 0, n)
        if runs:
            rows = {k: self.numbers(texts[k]) for k in runs}
            out = np.insert(out, np.repeat(np.cumsum(n)[runs], [len(rows[k]) for k in runs]), [x for k in runs for x in rows[k]])
            n[runs] = [len(rows[k]) for k in runs]
        return out, n


class Ragged:
    """Rows of numbers of any length, appended in blocks and taken by row."""

    def __init__(self, dtype) -> None:
        self.flat, self.length = np.zeros(0, dtype), np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)

    def extend(self, flat: np.ndarray, length: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])
        self.length = np.concatenate([self.length, length])
        self.start = np.cumsum(self.length) - self.length

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All numbers of the rows behind each other, and the length of each row."""
        n = self.length[rows]
        return self.flat[np.repeat(self.start[rows], n) + ramps(n)], n
