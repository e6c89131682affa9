"""Evaluation texts leaking into training text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.glyphs import CYRILLIC_TWINS, GREEK_TWINS, folded
from tracewright.session import Scratch

#: Share of edits by which a stretch of text may differ from a sentence of an item.
EDITS = 0.2
#: Share of an item's passage that a leak holds, and the least number of its sentences.
SHARE, SENTENCES = 0.45, 2
#: A first sentence with which this many different passages begin is a lead-in, no passage.
SHARED = 3
#: Random walks from each anchor, and bit samples of each walk.
WALKS, BANDS = 2, 2
#: Rows compared together, characters of a long text compared at a time, and characters of passages that go to the workers at a time.
LANES, STRETCH, CHARS = 4096, 256, 4_000_000
SEED = 7


class Form(NamedTuple):
    """Windows where a Chinese character leads, or where another one does: characters of an anchor, one of how many places is
    one, steps of a walk (a window has about half as many characters), and places of the walk in a sample."""

    gram: int
    every: int
    steps: int
    bits: int


#: Of leaks of half a passage with up to ``EDITS`` of each sentence in changed words, 98 of 100 must be found (a test counts them).
HAN, LETTERS = Form(1, 2, 28, 10), Form(4, 8, 64, 14)

_SENTENCE = re.compile(r"(?<=[。！？!?])|(?<=[.．])(?=\s|[^\x00-\x7f]|$)|\n\s*\n")


class _Folding(dict):
    """Characters to letters and digits of one case, width and script; anything else to nothing."""

    def __missing__(self, code: int) -> str | None:
        c = CYRILLIC_TWINS.get(chr(code)) or GREEK_TWINS.get(chr(code)) or chr(code)
        out = "".join(x for x in folded(c) or "" if x.isalnum()) or None
        self[code] = out
        return out


_FOLDING = _Folding()


def normal(text: str) -> str:
    """Letters and digits only, in one case, width and script."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return text.translate(_FOLDING)


def sentences(text: str | None) -> list[str]:
    """The sentences of a text as normal forms of four characters or more. Line breaks within a paragraph end none."""
    if not text:
        return []
    out = []
    for piece in _SENTENCE.split(text.replace("\r\n", "\n").replace("\r", "\n")):
        if not piece or not piece.strip():
            continue
        out.append(normal(piece))
        # a heading or an entry may stand on a line of its own before the sentence
        head, line, rest = piece.strip().partition("\n")
        if line and len(head) < 60 and rest.strip():
            out.append(normal(rest))
    return [s for s in out if len(s) >= 4]


def item_sentences(items: DataFrame, scratch: Scratch) -> DataFrame:
    """(item_id, sno, at, sentence, size, body): the distinct sentences of each passage, without lead-ins and closing questions.

    A first sentence with which passages begin that go on in ``SHARED`` or more ways is a lead-in; a last sentence that asks
    is none of the passage either. Nothing else is left out, so copies of an item keep their passages. ``at`` is the place of
    a sentence and ``body`` the size of the passage, in characters.
    """

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for item, text in zip(pdf["item_id"], pdf["text"], strict=True):
                pieces = [p for p in _SENTENCE.split((text or "").replace("\r\n", "\n").replace("\r", "\n")) if p and p.strip()]
                if len(pieces) > 1 and pieces[-1].strip()[-1] in "?？":
                    pieces = pieces[:-1]
                each = [s for s in dict.fromkeys(normal(p) for p in pieces) if len(s) >= 4]
                rows += [(item, k, s, each[1] if k == 0 and len(each) > 1 else None) for k, s in enumerate(each)]
            yield pd.DataFrame(rows, columns=["item_id", "k", "sentence", "next"])

    each = scratch.table("pieces", items.select("item_id", "text").where("text is not null").mapInPandas(split, "item_id long, k long, sentence string, next string").distinct())
    leads = each.where("k = 0 and next is not null").groupBy("sentence").agg(F.countDistinct("next").alias("n")).where(F.col("n") >= SHARED).select("sentence", F.lit(0).cast("long").alias("k"))
    own = each.join(leads, ["sentence", "k"], "left_anti").groupBy("item_id", "sentence").agg(F.min("k").alias("k")).withColumn("size", F.length("sentence"))
    body = own.groupBy("item_id").agg(F.sum("size").alias("body"))
    return scratch.table("sentences", own.join(body, "item_id").select("item_id", F.xxhash64("item_id", "sentence").alias("sno"), F.col("k").alias("at"), "sentence", "size", "body"))


def semiglobal(texts: np.ndarray, starts: np.ndarray, ends: np.ndarray, sentences_: list[str], which: np.ndarray) -> np.ndarray:
    """For each row the least edit distance between sentence ``which`` and any stretch of ``texts[start:end]``.

    Bit-parallel columns (Myers) in words of 64 characters, many rows at a time. ``texts`` are code points.
    """
    out = np.zeros(len(which), dtype=np.int64)
    if not len(which):
        return out
    sizes = np.array([len(s) for s in sentences_])
    m, n = sizes[which], ends - starts
    order = np.lexsort((which, n, (m + 63) // 64))
    alphabet = np.unique(np.frombuffer("".join(sentences_).encode("utf-32-le"), dtype=np.uint32))
    table = np.full(0x110001, len(alphabet), dtype=np.int32)
    table[alphabet] = np.arange(len(alphabet))
    texts = table[texts]
    one, top = np.uint64(1), np.uint64(63)
    blocks_of = (m[order] + 63) // 64
    edges = np.flatnonzero(np.diff(blocks_of)) + 1
    for group in np.split(order, edges):
        blocks = int((m[group[0]] + 63) // 64)
        for a in range(0, len(group), LANES):
            lanes = group[a : a + LANES]
            own, row = np.unique(which[lanes], return_inverse=True)
            flat = np.frombuffer("".join(sentences_[k] for k in own).encode("utf-32-le"), dtype=np.uint32)
            letters, code = np.unique(table[flat], return_inverse=True)
            local = np.full(len(alphabet) + 1, len(letters), dtype=np.int64)
            local[letters] = np.arange(len(letters))
            at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes[own]) - sizes[own], sizes[own])
            # masks of the places of each character in each sentence; the last character stands for all others
            masks = np.zeros((blocks, len(own) * (len(letters) + 1)), dtype=np.uint64)
            np.bitwise_or.at(masks, (at // 64, np.repeat(np.arange(len(own)), sizes[own]) * (len(letters) + 1) + code), one << (at % 64).astype(np.uint64))
            base = row * (len(letters) + 1)
            last = ((m[lanes] - 1) % 64).astype(np.uint64)
            pv, mv = np.full((blocks, len(lanes)), ~np.uint64(0)), np.zeros((blocks, len(lanes)), dtype=np.uint64)
            score, begin, width = m[lanes].astype(np.int64), starts[lanes], n[lanes]
            best = score.copy()
            for j in range(int(width.max())):
                if j >= width[0]:  # rows stand by length: the shorter ones are done
                    live = int(np.searchsorted(width, j, "right"))
                else:
                    live = 0
                k = base[live:] + local[texts[begin[live:] + j]]
                up, down = np.zeros(len(k), dtype=np.uint64), np.zeros(len(k), dtype=np.uint64)
                for b in range(blocks):
                    p, q = pv[b, live:], mv[b, live:]
                    eq = masks[b][k]
                    xv = eq | q
                    eq |= down
                    xh = (((eq & p) + p) ^ p) | eq
                    ph, mh = q | ~(xh | p), p & xh
                    end = last[live:] if b == blocks - 1 else top
                    out_up, out_down = (ph >> end) & one, (mh >> end) & one
                    ph, mh = (ph << one) | up, (mh << one) | down
                    pv[b, live:], mv[b, live:] = mh | ~(xv | ph), ph & xv
                    up, down = out_up, out_down
                score[live:] += up.astype(np.int64) - down.astype(np.int64)
                np.minimum(best[live:], score[live:], out=best[live:])
            out[lanes] = best
    return out


def distance(a: str, b: str) -> int:
    """Edit distance of two whole texts."""
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in a row and the places at which each one starts, the end of the last one included."""
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), edges


def _mixed(codes: np.ndarray, salt: int) -> np.ndarray:
    h = (codes.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def windows(codes: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, number of the text, place, width): keys under which windows of small edit distance meet.

    Windows begin at anchors, places chosen by a hash of the few characters there, so that a copy has them at the same places
    whatever stands before, and run over marks and sentences. A random walk reads a window from left to right: it writes the
    current character at every step and moves on or stays as a random function of step and character says. Two windows at a
    small edit distance walk alike again soon after an edit, so what they write differs in few places: edit distance is
    embedded into Hamming distance. A key hashes a random sample of places of one walk, and every walk is sampled
    ``BANDS`` times. A walk that leaves its text gives no key.
    """
    longest = max(HAN.steps, LETTERS.steps) + 1
    padded = np.concatenate([codes, np.zeros(longest, codes.dtype)])
    base = _mixed(padded, 1)
    walked = [_mixed(padded, 1000 + w) for w in range(WALKS)]
    han = codes >= 0x2E80
    out = []
    for form, lead in ((HAN, np.flatnonzero(han)), (LETTERS, np.flatnonzero(~han))):
        g = np.zeros(len(lead), dtype=np.uint64)
        for k in range(form.gram):
            g = (g ^ base[lead + k]) * np.uint64(0x100000001B3)
        g ^= g >> np.uint64(33)
        g *= np.uint64(0xC2B2AE3D27D4EB4F)
        place = lead[(g >> np.uint64(32)) < np.uint64(2**32 // form.every)]
        text = np.searchsorted(edges, place, "right") - 1
        for w in range(WALKS):
            rng = np.random.RandomState(SEED + w + 10 * form.bits)
            samples = [frozenset(rng.choice(form.steps, form.bits, replace=False).tolist()) for _ in range(BANDS)]
            odd = rng.randint(1, 2**62, size=form.steps).astype(np.uint64) | np.uint64(1)
            keys = [np.full(len(place), (w * BANDS + b) * 0x9E3779B9 + form.steps, dtype=np.uint64) for b in range(BANDS)]
            here = place.copy()
            for j in range(form.steps):
                v = walked[w][here]
                for b in range(BANDS):
                    if j in samples[b]:
                        keys[b] += v * odd[j]
                here += ((v >> np.uint64(j & 63)) & np.uint64(1)).astype(np.int64)
            whole = here < edges[text + 1]
            for key in keys:
                key = key[whole]
                key ^= key >> np.uint64(31)
                out.append((key * np.uint64(0x9E3779B97F4A7C15), text[whole], place[whole], (here - place)[whole]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Held:
    """Item sentences, in order of item and place, indexed by the windows of their passages, and the search for them in texts."""

    def __init__(self, items: np.ndarray, held: list[str], edits: float = EDITS, share: float = SHARE, least: int = SENTENCES) -> None:
        self.items, self.sentences, self.edits = items, held, edits
        sizes = np.array([len(s) for s in held], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        # a passage is the row of its sentences; a window belongs to the sentence in which its middle lies
        codes = np.frombuffer("".join(held).encode("utf-32-le"), dtype=np.uint32)
        first = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]]))
        h, _, place, width = windows(codes, np.append(starts[first], len(codes)))
        owner = np.searchsorted(starts, place + width // 2, "right") - 1
        order = np.argsort(h, kind="stable")
        self.keys, self.owner, self.at = h[order], owner[order].astype(np.int32), (place - starts[owner])[order].astype(np.int32)
        self.bits = max(20, int(16 * len(h) + 1).bit_length())
        self.seen = np.zeros(1 << self.bits, dtype=bool)
        self.seen[h >> np.uint64(64 - self.bits)] = True
        self.sizes = sizes
        self.longest = np.ceil(self.sizes * edits / (1 - edits)).astype(np.int64)
        self.limits = np.floor(self.sizes * edits + 1e-9).astype(np.int64)
        self.place = np.unique(items, return_inverse=True)[1]
        self.by = np.argsort(self.place, kind="stable")
        self.ordered = self.place[self.by]
        self.n_items, self.share, self.least = int(self.place.max()) + 1, share, least
        self.body = np.bincount(self.place, self.sizes, self.n_items)

    def suspects(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, place of an item) pairs that share two sentences or a fifth of the passage, found by windows that meet under a key."""
        codes, edges = _codes(texts)
        h, text, place, _ = windows(codes, edges)
        maybe = np.flatnonzero(self.seen[h >> np.uint64(64 - self.bits)])
        lo, hi = np.searchsorted(self.keys, h[maybe], "left"), np.searchsorted(self.keys, h[maybe], "right")
        n = hi - lo
        post = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        who, text = self.owner[post].astype(np.int64), np.repeat(text[maybe], n)
        start = np.repeat(place[maybe], n) - self.at[post]
        # windows of one alignment lie within the allowed edits of each other: one comparison for each step of that many places
        shift = int(self.sizes.max())
        found = np.unique((who * len(texts) + text) * (len(codes) + 2 * shift) + (start + shift) // (self.limits[who] + 1))
        found, first = np.divmod(found, len(codes) + 2 * shift)
        who, text = np.divmod(found, len(texts))
        if self.least > 1:
            # a leak holds two sentences or more, and windows of a single one are no leak
            both = np.unique(np.stack([text * (self.n_items) + self.place[who], who]), axis=1)
            pairs, n = np.unique(both[0], return_counts=True)
            some = np.isin(text * (self.n_items) + self.place[who], pairs[n > 1])
            who, text, first = who[some], text[some], first[some]
        step = self.limits[who] + 1
        first = first * step - shift
        begin = np.maximum(first - self.limits[who], edges[text])
        end = np.minimum(first + step + self.sizes[who] + self.limits[who], edges[text + 1])
        near = semiglobal(codes, begin, end, self.sentences, who) <= self.limits[who]
        some = np.unique(text[near] * len(self.sentences) + who[near])
        text, who = np.divmod(some, len(self.sentences))
        pairs, row, n = np.unique(text * self.n_items + self.place[who], return_inverse=True, return_counts=True)
        size = np.bincount(row, self.sizes[who], len(pairs))
        text, item = np.divmod(pairs, self.n_items)
        keep = (n >= 2) | (size >= 0.2 * self.body[item])
        return text[keep], item[keep]

    def find(self, raw: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text, sentence) of all sentences of suspected items that stand anywhere in the text."""
        texts = [normal(t) if t else "" for t in raw]
        text, item = self.suspects(texts)
        lo, hi = np.searchsorted(self.ordered, item, "left"), np.searchsorted(self.ordered, item, "right")
        n = hi - lo
        who = self.by[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        text = np.repeat(text, n)
        codes, edges = _codes(texts)
        # long texts in overlapping stretches, so that none keeps the others waiting
        n = np.maximum(-(-(edges[text + 1] - edges[text]) // STRETCH), 1)
        row = np.repeat(np.arange(len(who)), n)
        begin = edges[text][row] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRETCH
        end = np.minimum(begin + STRETCH + self.sizes[who[row]] + self.longest[who[row]], edges[text + 1][row])
        d = self.sizes[who].copy()
        np.minimum.at(d, row, semiglobal(codes, begin, end, self.sentences, who[row]))
        near = d <= self.limits[who]
        # the share of edits counts on the longer side, so a sentence with words put in may be a whole one of the text
        maybe = ~near & (d <= self.sizes[who] * self.edits / (1 - self.edits))
        pair = text * self.n_items + self.place[who]
        pairs, row = np.unique(pair, return_inverse=True)
        most = np.bincount(row, (near | maybe) * self.sizes[who], len(pairs))[row] if len(row) else row
        for k in np.flatnonzero(maybe & (most >= self.share * self.body[self.place[who]])):
            s = self.sentences[who[k]]
            near[k] = any(len(s) < len(w) and len(w) - len(s) <= int(len(w) * self.edits) and distance(s, w) <= int(len(w) * self.edits) for w in sentences(raw[text[k]]))
        return text[near], who[near]


def leaks(documents: DataFrame, items: DataFrame, scratch: Scratch, edits: float = EDITS, share: float = SHARE, least: int = SENTENCES) -> DataFrame:
    """(doc_id, item_id, held, n_sentences): every document that holds about half or more of an item's passage.

    Marks, blanks, case and width do not matter: all is done in the letters and digits. Passages and documents are cut into
    windows of the size of an item's sentences; windows that random walks and bit samples bring under one key are candidates, and
    the sentence there is compared with the text around it by semi-global edit distance. A document and an item that share
    two sentences or a fifth of the passage are compared in full: all sentences of the item with the whole text. ``held`` is
    the share of the passage whose sentences are found. Empty and null texts hold nothing; repeated rows of a document count
    once. Documents are read once for every ``CHARS`` characters of passages; nothing but found sentences is shuffled.
    """
    sents = item_sentences(items, scratch)
    total = sents.agg(F.sum("size")).first()[0] or 0
    rounds = int(-(-total // CHARS)) or 1
    out = None
    for r in range(rounds):
        part = sents.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r)
        found = _found(documents, part, scratch, edits, share, least)
        out = found if out is None else out.unionByName(found)
    full = out.distinct().join(sents, ["item_id", "sno"]).groupBy("doc_id", "item_id").agg((F.sum("size") / F.max("body")).alias("held"), F.count("*").alias("n_sentences"))
    return full.where((F.col("held") >= share) & (F.col("n_sentences") >= least)).select("doc_id", "item_id", F.round("held", 6).alias("held"), "n_sentences")


def _found(documents: DataFrame, sents: DataFrame, scratch: Scratch, edits: float, share: float, least: int) -> DataFrame:
    """(doc_id, item_id, sno) of the sentences found in documents. The sentences go to the workers, and only finds leave them."""
    rows = sents.select("item_id", "sno", "sentence", "at").orderBy("item_id", "at").toPandas()
    ids, snos = rows["item_id"].to_numpy(dtype=np.int64), rows["sno"].to_numpy(dtype=np.int64)
    shared = scratch.spark.sparkContext.broadcast((ids, snos, list(rows["sentence"])))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, snos, held = shared.value
        index = Held(ids, held, edits, share, least) if held else None
        for batch in batches:
            docs, texts = np.array(batch.column(0).to_pylist(), dtype=np.int64), batch.column(1).to_pylist()
            for a, b in _parts(texts) if index else ():
                text, who = index.find(texts[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(docs[a + text]), pa.array(ids[who]), pa.array(snos[who])], names=["doc_id", "item_id", "sno"])

    return documents.where("text is not null").select("doc_id", "text").mapInArrow(find, "doc_id long, item_id long, sno long")


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a million characters."""
    a = size = 0
    for b, t in enumerate(texts, 1):
        size += len(t or "")
        if size >= 1_000_000 or b == len(texts):
            yield a, b
            a, size = b, 0
