"""Byte-pair encoding of many words at once, for tokenizers that mark the end of a word ("</w>").

The pairs of all words are ranked by lookups in one sorted table, and each round merges the best pair of every word that still has one.
Only words of Latin-1 letters are encoded here (their lower case is a table); everything else is left to the tokenizer itself.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: A word of letters, then signs that always part from letters (an apostrophe or a digit wouldn't).
PATTERN = rf'^(?P<letters>[{LETTERS}]+)(?P<tail>[.,;:!?*#$%&|<>()"\-]*)$'
MOST_BYTES = 48
NONE = np.int32(2**31 - 1)


def byte_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies use for each byte: the byte's own where it has one, else the next from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordPieces:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or model["unk_token"] or model["dropout"]:
            raise ValueError("not a BPE with marked word ends")
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        signs = byte_signs()
        self.inner = np.array([vocab[signs[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab[signs[b] + "</w>"] for b in range(256)], dtype=np.int64)
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], dtype=np.int64)
        by = np.argsort(keys, kind="stable")
        self.keys, self.rank = np.append(keys[by], np.int64(2**62)), np.append(by.astype(np.int32), NONE)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words one after another, and each word's number of ids. words: lower-case, at most MOST_BYTES bytes."""
        n = len(words)
        length = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        _, offsets, data = words.buffers()
        start = np.frombuffer(offsets, np.int32)[words.offset : words.offset + n].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        pieces = np.ones(n, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for high in (4, 8, 12, 16, 24, MOST_BYTES):  # words of like length together: little padding
            rows = np.flatnonzero((length > low) & (length <= high))
            low = high
            if len(rows):
                symbol, alive = self._merge(data, start[rows], length[rows], high)
                pieces[rows] = alive.sum(axis=1)
                found.append((rows, symbol[alive]))
        out = np.zeros(int(pieces.sum()), np.uint32)
        first = np.cumsum(pieces) - pieces
        for rows, ids in found:
            k = pieces[rows]
            out[np.arange(len(ids)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[rows], k)] = ids
        return out, pieces

    def _merge(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(start)
        place = np.arange(width)
        alive = place[None, :] < length[:, None]
        byte = data[np.minimum(start[:, None] + place, len(data) - 1)]
        symbol = np.where(place[None, :] == length[:, None] - 1, self.last[byte], self.inner[byte])
        following = np.tile(place + 1, (n, 1))
        before = np.tile(place - 1, (n, 1))
        rank = np.full((n, width), NONE, np.int32)
        pair = place[None, :-1] < length[:, None] - 1
        rank[:, :-1][pair] = self.ranks(symbol[:, :-1][pair], symbol[:, 1:][pair])
        row = np.arange(n)
        while len(row):
            own = rank[row]
            at = own.argmin(axis=1)
            best = own[np.arange(len(row)), at]
            more = best != NONE
            row, at, best = row[more], at[more], best[more]
            gone = following[row, at]
            after = following[row, gone]
            symbol[row, at] = self.merged[best]
            alive[row, gone] = False
            rank[row, gone] = NONE
            following[row, at] = after
            right = after < length[row]
            before[row[right], after[right]] = at[right]
            rank[row, at] = NONE
            rank[row[right], at[right]] = self.ranks(symbol[row[right], at[right]], symbol[row[right], after[right]])
            prior = before[row, at]
            left = prior >= 0
            rank[row[left], prior[left]] = self.ranks(symbol[row[left], prior[left]], symbol[row[left], at[left]])
        return symbol, alive
