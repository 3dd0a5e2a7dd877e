"""Packing tokenised examples into sequences as vector bin packing.

Each example asks for tokens, segments and loss-bearing tokens at once, and a
sequence has a limit on each. An example longer than a sequence is first cut
into full pieces and a remainder. Within a block of pieces, a sequence is filled
by the dot-product heuristic: of the pieces that still fit in every dimension,
the next is the one whose demand has the largest dot product with the room left,
each dimension scaled by its limit and weighted by how scarce it is in the
block. When no piece fits, the sequence is closed and the next one is opened.

Blocks are dealt by a hash of a row's number, so that no id makes a block large,
and hold a bounded number of pieces; a block leaves at most a few sequences
partly filled. Pieces of a block are sorted first, so a repeated task packs them
alike.

Ids: the tokenizer's, then one end id. A null or empty text is the end id alone.
A piece bears loss on every id except its first, which has nothing before it.
Rows that repeat an id are packed as rows of their own. Every id of every
document lies in exactly one piece. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rfspark.llm.common import remembered, stretches, tidied, words_of

END_ID = 1
BLOCK = 4096  # documents in a block, about
TEXT_BYTES = 4 << 20
KNOWN = 200_000  # words whose ids a worker remembers
SEEN = 1 << 22  # slots of the table of words that were new once
AT_ONCE = 1 << 17  # words whose ids are laid out together
CODED = 8  # chunks of 2000 words that are with the tokenizer together
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, block long{ids}"


class WordIds:
    """Ids of words under a tokenizer that never joins across white space.

    Texts are split at ASCII white space first (the tokenizer splits there too),
    so a word that occurs often is encoded once. Plain words are encoded many at
    a time, end to end; which ids are whose is told by the word-end ids, one for
    each run of letters, digit or run of signs. A word with characters that the
    tokenizer may normalise, or with a special token's string, is encoded alone.
    """

    PLAIN = r"^[\x21-\x7e\x{a1}-\x{ff}]+$"
    # The tokenizer's own pattern; fixed by its file.
    RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        vocab = self.model.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        # Words seen twice or more, and where their ids lie. By hash, words that were new before:
        # two words on one slot only mean that one is remembered early.
        self.known: dict[bytes, int] = {}
        self.seen = np.zeros(SEEN, bool)
        self.held = np.zeros(0, np.uint32)
        self.first, self.size = np.zeros(KNOWN, np.int64), np.zeros(KNOWN, np.int64)

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words, end to end, and how many each has."""
        words = words.cast(pa.large_string())
        plain = pc.and_(pc.match_substring_regex(words, self.PLAIN), pc.invert(pc.match_substring(words, "<|")))
        plain = np.asarray(plain)
        runs = np.asarray(pc.count_substring_regex(words, self.RUNS))
        words = words.to_pylist()
        at = np.flatnonzero(plain)
        chunks = [at[i : i + 2000] for i in range(0, len(at), 2000)]
        ids, sizes, order = [], [], []
        # The tokenizer's own rows are many times the ids that are kept of them, so a few are held at a time.
        for few in (chunks[i : i + CODED] for i in range(0, len(chunks), CODED)):
            coded = self.model.encode_batch_fast([" ".join([words[i] for i in c]) for c in few], add_special_tokens=False)
            for chunk, c in zip(few, coded):
                own = np.array(c.ids, np.uint32)
                last = np.flatnonzero(self.ends[own])[np.cumsum(runs[chunk]) - 1] + 1
                ids.append(own)
                sizes.append(np.diff(last, prepend=0))
                order.append(chunk)
        odd = np.flatnonzero(~plain)
        for few in (odd[i : i + 2000] for i in range(0, len(odd), 2000)):
            for i, c in zip(few, self.model.encode_batch_fast([words[i] for i in few], add_special_tokens=False)):
                ids.append(np.array(c.ids, np.uint32))
                sizes.append(np.array([len(c.ids)]))
                order.append(np.array([i]))
        flat, size, order = (np.concatenate(x) for x in (ids, sizes, order))
        first = np.cumsum(size) - size
        back = np.argsort(order)
        return _gathered(flat, first[back], size[back]), size[back]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a batch of texts, end to end, and where each text's begin (one place more)."""
        codes, words, starts = words_of(texts)
        if not len(codes):
            return np.zeros(0, np.uint32), starts
        named, known = words.to_pylist(), self.known
        slot = np.fromiter((known.get(w, -1) for w in named), np.int64, len(named))
        old, new = slot >= 0, np.flatnonzero(slot < 0)
        size, first = np.zeros(len(named), np.int64), np.zeros(len(named), np.int64)
        size[old], first[old] = self.size[slot[old]], self.first[slot[old]]
        flat = self.held
        if len(new):
            made, counts = self._encoded(words.take(pa.array(new)))
            at = np.cumsum(counts) - counts
            size[new], first[new] = counts, len(flat) + at
            flat = np.concatenate([flat, made])
            often = np.flatnonzero(self._again(named, new, codes))[: KNOWN - len(known)]
            if len(often):
                slots = np.arange(len(known), len(known) + len(often))
                known.update(zip((named[i] for i in new[often]), slots.tolist()))
                self.size[slots] = counts[often]
                self.first[slots] = len(self.held) + np.cumsum(counts[often]) - counts[often]
                self.held = np.concatenate([self.held, _gathered(made, at[often], counts[often])])
        ends = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(size[codes], out=ends[1:])
        ids = np.empty(ends[-1], np.uint32)
        for a in range(0, len(codes), AT_ONCE):
            some = codes[a : a + AT_ONCE]
            ids[ends[a] : ends[a + len(some)]] = _gathered(flat, first[some], size[some])
        return ids, ends[starts]

    def _again(self, named: list[bytes], new: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Which new words come twice in their batch, or were new in one before; all are noted."""
        again = np.bincount(codes, minlength=len(named))[new] > 1
        if len(self.known) < KNOWN:
            slot = np.fromiter((hash(named[i]) for i in new), np.int64, len(new)) & (SEEN - 1)
            again |= self.seen[slot]
            self.seen[slot] = True
        return again


_coders: dict[str, WordIds] = remembered.setdefault("packing", {})


def coder_of(path: str) -> WordIds:
    """The worker's own encoder, which later tasks of this operator use again with the words it knows."""
    if path not in _coders:
        _coders[path] = WordIds(path)
    return _coders[path]


def _gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``first`` with ``size`` values each, end to end."""
    ends = np.cumsum(size)
    if not len(ends):
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(first - (ends - size), size)]


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", tokens: int = 2048, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``tokens`` ids: ``doc_id, start, length, ids_crc32, doc_tokens, block`` (and ``ids``)."""
    blocks = max(1, -(-docs.count() // BLOCK))
    schema = PIECES.format(ids=", ids array<int>" if with_ids else "")

    def run(batches):
        coder = coder_of(tokenizer)
        for batch in batches:
            # A few megabytes of text at a time: what a batch needs in memory is many times its text.
            for part in stretches(batch, 1, TEXT_BYTES):
                yield piece_rows(part, coder)

    def piece_rows(batch, coder):
        ids, starts = coder.encode(batch.column(1))
        n = len(batch)
        total = np.diff(starts) + 1
        count = -(-total // tokens)
        row = np.repeat(np.arange(n), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = nth * tokens
        length = np.minimum(tokens, total[row] - start)
        own = np.empty(len(ids) + n, "<u4")
        ends = starts[1:] + np.arange(n)
        keep = np.ones(len(own), bool)
        keep[ends] = False
        own[keep], own[ends] = ids, END_ID
        first = starts[:-1] + np.arange(n)
        raw = memoryview(own.view(np.uint8))
        at = (first[row] + start) * 4
        crc = np.fromiter((zlib.crc32(raw[a : a + 4 * z]) for a, z in zip(at.tolist(), length.tolist())), np.int64, len(row))
        doc = batch.column(0).take(pa.array(row))
        block = batch.column(2).take(pa.array(row))
        columns = [doc, *map(pa.array, (start, length, crc, total[row])), block]
        if with_ids:
            where = np.append((first[row] + start), len(own)).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(where), pa.array(own.view(np.int32))))
        names = [f.split()[0] for f in schema.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("block"),
    )
    return rows.mapInArrow(tidied(run, keep="packing"), schema)


def fill(demand: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """A bin for each item, by the dot-product heuristic.

    Items of equal demand are interchangeable: the search runs over distinct
    demands with their counts. Ties go to the demand that comes first in order.
    """
    kinds, of, count = np.unique(demand, axis=0, return_inverse=True, return_counts=True)
    of = of.ravel()
    share = kinds / limit
    scarce = (share * count[:, None]).sum(axis=0)
    weighted = share * (scarce / max(scarce.max(), 1e-12))
    waiting = np.argsort(of, kind="stable")
    taken, first = np.zeros(len(kinds), np.int64), np.cumsum(count) - count
    bins, left, bin_no = np.empty(len(demand), np.int64), len(demand), 0
    live = np.arange(len(kinds))
    while left:
        room = limit.astype(np.int64).copy()
        live = live[taken[live] < count[live]]
        fits = live
        while True:
            fits = fits[(kinds[fits] <= room).all(axis=1) & (taken[fits] < count[fits])]
            if not len(fits):
                break
            best = fits[np.argmax(weighted[fits] @ (room / limit))]
            # As many of this kind as the heuristic would take are taken one by one.
            bins[waiting[first[best] + taken[best]]] = bin_no
            taken[best] += 1
            left -= 1
            room -= kinds[best]
        bin_no += 1
    return bins


def pack(pieces: DataFrame, tokens: int = 2048, segments: int = 256, loss_tokens: int = 2048) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    No sequence has more than ``tokens`` ids, ``segments`` pieces or
    ``loss_tokens`` ids that bear loss (a piece bears at most ``tokens - 1``).
    """
    limit = np.array([tokens, segments, loss_tokens])
    if loss_tokens < tokens - 1:
        raise ValueError("a full piece would bear more loss than a sequence may")

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        length = rows["length"].to_numpy()
        demand = np.column_stack([length, np.ones(len(rows), np.int64), length - 1])
        bins = fill(demand, limit)
        order = np.argsort(bins, kind="stable")
        rows, bins, length = rows.iloc[order], bins[order], length[order]
        before = np.cumsum(length) - length
        new = np.flatnonzero(np.diff(bins, prepend=-1))
        offset = before - np.repeat(before[new], np.diff(np.append(new, len(bins))))
        return rows.assign(sequence_id=rows["block"].to_numpy() * (1 << 32) + bins, offset=offset).drop(columns="block")

    names = [f for f in pieces.columns if f != "block"]
    schema = ", ".join(f"`{f}` {pieces.schema[f].dataType.simpleString()}" for f in names)
    return pieces.groupBy("block").applyInPandas(packed, schema + ", sequence_id long, offset long")
