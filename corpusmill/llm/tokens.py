"""Ids of a public byte-level BPE vocabulary for batches of texts; each distinct chunk is encoded once.

The vocabulary's pattern never joins text across a space that stands between two non-space characters, but
for that space itself, which opens the next token. So a text's ids are those of its first chunk followed by
those of " " + chunk for each later one. Texts in which a space touches other white space, and texts that hold
a special token's string, are encoded whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are encoded together.
BATCH_BYTES = 6 << 20


class ByteBPE:
    """``encode(texts)``: the ids of all texts in one array, and where each text's begin."""

    def __init__(self, path: str):
        import json

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(path)
        self.specials = [t.content for t in exact.get_added_tokens_decoder().values()]
        self.exact = lambda s: exact.encode(s, add_special_tokens=False).ids
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of = {c: b for b, c in _byte_characters().items()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in set(self.specials)}
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        self.spaced = [i for token, i in ranks.items() if token.startswith(b" ")]
        self.plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def begin_with_space(self, n: int) -> np.ndarray:
        """For the first ``n`` ids, whether their tokens begin with a space."""
        out = np.zeros(n, bool)
        out[[i for i in self.spaced if i < n]] = True
        return out

    def whole(self, text: str) -> np.ndarray:
        return np.array((self.exact if any(s in text for s in self.specials) else self.plain)(text), dtype="<u4")

    def encode(self, texts: pa.Array, *, ordinary: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """``texts`` without nulls -> (ids as little-endian unsigned 32-bit, starts with one more for the end).

        ``ordinary``: special tokens' strings are read as any other text.
        """
        lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
        starts = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        word = coded.indices.to_numpy()
        chunks = coded.dictionary.to_pylist()
        length = pc.binary_length(coded.dictionary).to_numpy().astype(np.int64)
        bad = (length == 0) | (pc.binary_length(pc.utf8_trim_whitespace(coded.dictionary)).to_numpy() != length)
        for s in () if ordinary else self.specials:
            bad |= pc.match_substring(coded.dictionary, s).to_numpy(zero_copy_only=False)
        good = np.flatnonzero(~bad)
        ids = np.array(self.plain(" " + " ".join([chunks[i] for i in good] if bad.any() else chunks) if len(good) else ""), dtype="<u4")
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(length[good] + 1)) + 1
        begin, count = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        count[good], begin[good] = np.diff(ends, prepend=0), np.r_[0, ends[:-1]] if len(ends) else ends
        whole = np.logical_or.reduceat(bad[word], starts[:-1]) if len(word) else np.zeros(0, bool)
        alone: dict[int, np.ndarray] = {}
        for i, first in enumerate(word[starts[:-1]]):
            alone[i] = (np.array(self.plain(texts[i].as_py()), dtype="<u4") if ordinary else self.whole(texts[i].as_py())) if whole[i] else np.array(self.plain(chunks[first]), dtype="<u4")
        n_word = count[word]
        if whole.any():
            n_word[np.repeat(whole, np.diff(starts))] = 0
        n_word[starts[:-1]] = [len(a) for a in alone.values()]
        at = np.r_[0, np.cumsum(n_word)]
        take = np.arange(at[-1]) - np.repeat(at[:-1] - begin[word], n_word)
        firsts = at[starts[:-1]]
        for i, a in alone.items():
            take[firsts[i] : firsts[i] + len(a)] = 0
        out = ids[take] if len(ids) else np.zeros(at[-1], "<u4")
        for i, a in alone.items():
            out[firsts[i] : firsts[i] + len(a)] = a
        return out, at[starts]


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches joined, or cut, to about ``most`` bytes of a text column."""
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        each = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy()
        cuts = np.unique(np.searchsorted(np.cumsum(each), np.arange(most, each.sum(), most))) + 1
        for i, j in zip(np.r_[0, cuts], np.r_[cuts, b.num_rows]):
            if j > i:
                held.append(b.slice(int(i), int(j - i)))
                size += int(each[i:j].sum())
                if size >= most:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _byte_characters() -> dict[int, str]:
    """The public byte-to-character table of byte-level BPE: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBPE:
    """One per Python worker and path."""
    return ByteBPE(path)
