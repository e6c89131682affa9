"""Encoding of a corpus with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import importlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the vocabulary files of public tokenizers lie.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k"
#: Pre-tokens kept with their ids by each Python worker.
CACHE = 400_000


def _pattern(folder: str) -> str:
    """The published pre-token pattern of the vocabulary's package."""
    try:
        return importlib.import_module("public_tokenizers").PATTERN
    except ImportError:
        scope: dict = {}
        with open(os.path.join(folder, "__init__.py"), encoding="utf-8") as f:
            exec(f.read(), scope)  # noqa: S102 - the package's own module, where it lies outside the import path
        return scope["PATTERN"]


class Bpe:
    """A byte-level BPE encoder from a file of base64 tokens and their ranks.

    A pre-token's bytes form a linked list of positions. A queue with one bucket of positions per merge rank hands out the
    merges in rank order and from left to right: a two-level bitmap over the ranks tells by find-first-set which bucket is
    next, and entries that an earlier merge has made stale are skipped. Every merge costs a constant number of steps, so a
    very long pre-token takes time in proportion to its length, where a search for the lowest pair would take its square.
    """

    LEAF = 256

    def __init__(self, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> None:
        with open(os.path.join(folder, f"{vocabulary}.tiktoken"), "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.split = regex.compile(_pattern(folder))
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        # a merge of two tokens by their ids: found through the bytes of both, then remembered
        self.token = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            self.token[r] = t
        self.pairs: dict[int, int] = {}
        self.cache: dict[str, list[int]] = {}

    def _pair(self, a: int, b: int) -> int:
        """The rank of the merge of tokens a and b, or -1."""
        key = a << 20 | b
        found = self.pairs.get(key)
        if found is None:
            found = self.ranks.get(self.token[a] + self.token[b], -1)
            if len(self.pairs) > 4_000_000:
                self.pairs.clear()
            self.pairs[key] = found
        return found

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token's bytes."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        single, pair = self.single, self._pair
        ids = [single[b] for b in data]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        buckets: dict[int, list[int]] = {}
        leaves: dict[int, int] = {}
        top = 0
        for i in range(n - 1):
            r = pair(ids[i], ids[i + 1])
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    leaf = r >> 8
                    leaves[leaf] = leaves.get(leaf, 0) | 1 << (r & 255)
                    top |= 1 << leaf
        while top:
            leaf = (top & -top).bit_length() - 1
            bits = leaves[leaf]
            r = leaf << 8 | (bits & -bits).bit_length() - 1
            bits &= bits - 1
            if bits:
                leaves[leaf] = bits
            else:
                del leaves[leaf]
                top &= top - 1
            spots = buckets.pop(r)
            # positions come in the order of their making; equal ranks are merged from left to right
            if len(spots) > 1:
                spots.sort()
            for i in spots:
                a = ids[i]
                if a < 0:
                    continue
                j = after[i]
                if j >= n or pair(a, ids[j]) != r:
                    continue
                ids[i] = r
                ids[j] = -1
                k = after[j]
                after[i] = k
                if k < n:
                    before[k] = i
                    x = pair(r, ids[k])
                    if x >= 0:
                        if x in buckets:
                            buckets[x].append(i)
                        else:
                            buckets[x] = [i]
                            leaf = x >> 8
                            leaves[leaf] = leaves.get(leaf, 0) | 1 << (x & 255)
                            top |= 1 << leaf
                h = before[i]
                if h >= 0:
                    x = pair(ids[h], r)
                    if x >= 0:
                        if x in buckets:
                            buckets[x].append(h)
                        else:
                            buckets[x] = [h]
                            leaf = x >> 8
                            leaves[leaf] = leaves.get(leaf, 0) | 1 << (x & 255)
                            top |= 1 << leaf
        return [t for t in ids if t >= 0]

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; empty and null texts give none. Strings that look like special tokens are ordinary text."""
        if not text:
            return []
        cache, out = self.cache, []
        for word in self.split.findall(text):
            ids = cache.get(word)
            if ids is None:
                ids = self.merge(word.encode("utf-8", "surrogatepass"))
                if len(word) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[word] = ids
            out += ids
        return out


@lru_cache(maxsize=4)
def encoder(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Bpe:
    """One encoder per worker process."""
    return Bpe(folder, vocabulary)


def encode_column(text: Column, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """``array<int>`` of token ids of each text, never null (Arrow batches, no shuffle)."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = encoder(folder, vocabulary)
        for batch in batches:
            lists = [bpe.encode(t) for t in batch.to_pylist()]
            ends = np.zeros(len(lists) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in lists], out=ends[1:])
            flat = np.fromiter((i for x in lists for i in x), dtype=np.int32, count=int(ends[-1]))
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return encode(text)
