"""SentencePiece merge-type encoding with seeded dropout, and its lossless decoding.

A text is split into characters, and pairs of neighbours whose joined string is
a piece are merged in the order of piece scores, leftmost first. With dropout,
each candidate merge is skipped when a keyed hash of its place says so: the key is the seed,
the document's id, the segment (a word with the spaces ahead of it), its place
among the document's segments, and the characters that the candidate spans. So
every occurrence of a word is segmented on its own, and alike when a task runs
again. Without dropout the ids are the library's own.

No piece holds a space behind another character, so segments are independent.
Short ones are worked out side by side in arrays, one merge each per round.
Occurrences of a segment share its state for as long as the same candidates were
skipped; only those with a skip of their own branch off, so a merge is made once
for a state and a hash is taken for an occurrence. Long segments go one at a time
with a heap as the agenda.

Characters without a piece, and the piece model's own space sign when a text
holds it literally, are written as bytes, so decoding gives every text back.
Null counts as empty; an empty text has no ids. Ids may be null or repeat.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from rfspark.llm.common import mix64, stretches

SPACE = "▁"
SHORT = 32  # symbols; longer segments go through the heap
TEXT_BYTES = 8 << 20  # text worked on at a time
OCCURRENCES = 200_000  # segments of one length worked on side by side
NONE = np.int32(2**30)


class MergeDropout:
    """The encoder of one model, rate and seed."""

    def __init__(self, path: str, rate: float = 0.1, seed: int = 0):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        model, n = self.model, self.model.get_piece_size()
        self.seed, self.rate = seed, rate
        self.bound = np.uint64(min(int(rate * 2**64), 2**64 - 1))
        skip = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)]
        names = [model.id_to_piece(i) for i in range(n)]
        known = {p: i for i, p in enumerate(names) if not skip[i]}
        self.bytes_at = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        order = sorted(range(n), key=lambda i: (-model.get_score(i), i))
        self.rank = np.empty(n + 1, np.int32)
        self.rank[order], self.rank[n] = np.arange(n), NONE
        self.none = n  # the merged id of a pair that is no piece
        self.char = -np.arange(0x110000, dtype=np.int32) - 1
        for p, i in known.items():
            if len(p) == 1 and p != SPACE:
                self.char[ord(p)] = i
        self.char[ord(" ")] = known[SPACE]
        pairs = {}
        for p, i in known.items():
            for cut in range(1, len(p)):
                a, b = known.get(p[:cut]), known.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a << 16 | b] = i
        self.pairs = pairs
        self._build(pairs)
        raw = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        raw = [b"" if skip[i] and not model.is_byte(i) else r for i, r in enumerate(raw)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size

    def _build(self, pairs: dict) -> None:
        """An open table from a pair of ids to the id of the merged piece."""
        bits = max(4, (4 * len(pairs)).bit_length())
        size, self.shift = 1 << bits, 32 - bits
        self.keys, self.merged = np.full(size, -1, np.int64), np.full(size, self.none, np.int32)
        for key, value in pairs.items():
            at = (key * 0x9E3779B1 & 0xFFFFFFFF) >> self.shift
            while self.keys[at] >= 0:
                at = at + 1 & size - 1
            self.keys[at], self.merged[at] = key, value

    def _merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merged id of each pair, or ``none``."""
        out = np.full(a.shape, self.none, np.int32)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        key = a.ravel()[at].astype(np.int64) << 16 | b.ravel()[at]
        slot = ((key * 0x9E3779B1) & 0xFFFFFFFF) >> self.shift
        flat = out.ravel()
        while len(at):
            there = self.keys[slot]
            hit = there == key
            flat[at[hit]] = self.merged[slot[hit]]
            go = ~hit & (there >= 0)
            at, key, slot = at[go], key[go], (slot[go] + 1) & (len(self.keys) - 1)
        return flat.reshape(a.shape)

    def _dropped(self, key: np.ndarray, lo, mid, hi) -> np.ndarray:
        """Whether the merge of characters lo..mid with mid..hi is skipped under a segment's key."""
        place = (lo.astype(np.uint64) << np.uint64(42)) ^ (mid.astype(np.uint64) << np.uint64(21)) ^ hi.astype(np.uint64)
        return mix64(key + place * np.uint64(0x9E3779B97F4A7C15)) < self.bound

    def _short(self, sym: np.ndarray, state: np.ndarray, key: np.ndarray):
        """Occurrences of segments of one length.

        ``sym`` has a row for each segment, ``state`` each occurrence's segment.
        Gives rows of final symbols (padded), how many each has, and each
        occurrence's row.
        """
        n, width = sym.shape
        done, ends = [], []
        final = np.full(len(state), -1)
        who = np.arange(len(state))
        size = np.full(n, width)
        beg = np.tile(np.arange(width + 1, dtype=np.int32), (n, 1))
        cand = np.full((n, width), self.none, np.int32)
        made_rows = 0
        if width > 1:
            cand[:, :-1] = self._merge(sym[:, :-1], sym[:, 1:])
            offered = [np.full(n, p) for p in range(width - 1)]
        else:
            offered = []
        live = np.arange(width)
        while True:
            sym, beg, cand, size, state = self._branched(sym, beg, cand, size, state, key, offered)
            rank = self.rank[cand]
            at = rank.argmin(axis=1)
            go = rank[np.arange(len(sym)), at] < NONE
            stop = np.flatnonzero(~go)
            if len(stop):
                row = np.full(len(sym), -1)
                row[stop] = made_rows + np.arange(len(stop))
                made_rows += len(stop)
                done.append(sym[stop])
                ends.append(size[stop])
                over = ~go[state]
                final[who[over]] = row[state[over]]
                new = np.cumsum(go) - 1
                who, key, state = who[~over], key[~over], new[state[~over]]
                sym, beg, cand, size, at = (x[go] for x in (sym, beg, cand, size, at))
            if not len(sym):
                break
            here = np.arange(len(sym))
            made = cand[here, at]
            shift = live[None, :] + (live[None, :] > at[:, None])
            shift[:, -1] = np.minimum(shift[:, -1], width - 1)
            sym = np.take_along_axis(sym, shift, 1)
            sym[here, at] = made
            cand = np.take_along_axis(cand, shift, 1)
            cand[:, -1] = self.none
            wide = np.arange(width + 1)
            beg = np.take_along_axis(beg, np.minimum(wide[None, :] + (wide[None, :] > at[:, None]), width), 1)
            size = size - 1
            for there in (at - 1, at):
                cand[here[there >= 0], there[there >= 0]] = self.none
                ok = (there >= 0) & (there + 1 < size)
                r, p = here[ok], there[ok]
                if len(r):
                    cand[r, p] = self._merge(sym[r, p], sym[r, p + 1])
            offered = [at - 1, at]
        return np.concatenate(done), np.concatenate(ends), final

    def _branched(self, sym, beg, cand, size, state, key, offered):
        """The states after newly offered candidates (a place in each state, or -1) are skipped or not.

        An occurrence that skips none keeps its state; the others share a state where they skip the same.
        """
        if self.rate <= 0 or not offered:
            return sym, beg, cand, size, state
        skips = np.zeros(len(state), np.int64)
        every = np.arange(len(sym))
        for bit, place in enumerate(offered):
            at = np.maximum(place, 0)
            there = (place >= 0) & (cand[every, at] < self.none)
            lo, mid = beg[every, at], beg[every, np.minimum(at + 1, beg.shape[1] - 1)]
            hi = beg[every, np.minimum(at + 2, beg.shape[1] - 1)]
            mine = np.flatnonzero(there[state])
            of = state[mine]
            skip = self._dropped(key[mine], lo[of], mid[of], hi[of])
            skips[mine[skip]] |= 1 << bit
        odd = np.flatnonzero(skips)
        if not len(odd):
            return sym, beg, cand, size, state
        kinds, of = np.unique(state[odd] << len(offered) | skips[odd], return_inverse=True)
        came = kinds >> len(offered)
        branch = cand[came]
        for bit, place in enumerate(offered):
            hit = np.flatnonzero(kinds >> bit & 1)
            branch[hit, place[came[hit]]] = self.none
        state = state.copy()
        state[odd] = len(sym) + of
        # States that nobody is in any more are left out.
        used = np.zeros(len(sym) + len(kinds), bool)
        used[state] = True
        new = np.cumsum(used) - 1
        parts = ((sym, sym[came]), (beg, beg[came]), (cand, branch), (size, size[came]))
        sym, beg, cand, size = (np.concatenate(x)[used] for x in parts)
        return sym, beg, cand, size, new[state]

    def _long(self, sym: list[int], key: np.uint64) -> list[int]:
        """One segment, with a heap of candidate merges as the agenda."""
        n = len(sym)
        before, after, end = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
        agenda = []

        def offer(i):
            j = after[i]
            if i < 0 or j >= n or sym[i] < 0 or sym[j] < 0:
                return
            made = self.pairs.get(sym[i] << 16 | sym[j])
            if made is None:
                return
            if self.rate > 0 and self._dropped(key, *np.array([[i], [j], [end[j]]]))[0]:
                return
            heapq.heappush(agenda, (int(self.rank[made]), i, j, end[j], made))

        for i in range(n - 1):
            offer(i)
        gone = [False] * n
        while agenda:
            _, i, j, stop, made = heapq.heappop(agenda)
            if gone[i] or gone[j] or after[i] != j or end[j] != stop:
                continue
            sym[i], end[i], gone[j] = made, stop, True
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s, g in zip(sym, gone) if not g]

    def _segments(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words with the spaces ahead of them, and where each text's begin (one place more)."""
        texts = texts.cast(pa.large_string())
        if not pc.any(pc.match_substring(texts, "  ")).as_py():
            split = pc.split_pattern(texts, " ")
            return split.flatten(), np.asarray(split.offsets) - split.offsets[0].as_py()
        words, starts = [], [0]
        for t in texts.to_pylist():
            spaces = 0
            for w in t.split(" "):
                if w:
                    words.append(" " * spaces + w)
                    spaces = 0
                else:
                    spaces += 1
            # The piece sign that opens a segment stands for its first space.
            if spaces:
                words.append(" " * (spaces - 1))
            starts.append(len(words))
        return pa.array(words, pa.large_string()), np.array(starts)

    def encode(self, texts: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts end to end, and where each text's begin (one place more).

        ``keys``: an unsigned 64-bit value for each text, which its drops depend on.
        """
        texts = texts.fill_null("")
        words, starts = self._segments(texts)
        empty = np.asarray(pc.equal(pc.binary_length(texts), 0))
        count = np.diff(starts)
        if empty.any():
            words = words.filter(pa.array(~np.repeat(empty, count)))
            starts = np.concatenate([[0], np.cumsum(np.where(empty, 0, count))])
        if not len(words):
            return np.zeros(0, np.int32), starts
        coded = words.dictionary_encode()
        codes, names = np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_pylist()
        if self.rate > 0:
            named = np.fromiter((xxhash.xxh64_intdigest(w, self.seed) for w in names), np.uint64, len(names))
            doc = np.repeat(keys.astype(np.uint64), np.diff(starts))
            nth = np.arange(len(codes), dtype=np.uint64) - np.repeat(starts[:-1], np.diff(starts)).astype(np.uint64)
            salt = np.uint64(self.seed * 0x9E3779B97F4A7C15 & 2**64 - 1)
            flat, size, of = self._encoded(names, codes, mix64(named[codes] + mix64(doc + mix64(nth + salt))))
        else:
            flat, size, of = self._encoded(names, np.arange(len(names)), np.zeros(len(names), np.uint64))
            of = of[codes]
        lengths = size[of]
        ends, first = np.cumsum(lengths), np.cumsum(size) - size
        at = np.arange(ends[-1]) + np.repeat(first[of] - (ends - lengths), lengths)
        return flat[at], np.concatenate([[0], ends])[starts]

    def _encoded(self, names: list[str], codes: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Final ids of some segmentations, end to end, how many each has, and each occurrence's segmentation.

        ``codes``: the segment of each occurrence; ``key``: its key.
        """
        n = len(names)
        width = np.fromiter(map(len, names), np.int64, n) + 1
        sym = self.char[np.frombuffer((" " + " ".join(names)).encode("utf-32-le"), np.uint32)]
        first = np.cumsum(width) - width
        # Occurrences by length of segment, and by segment within one length.
        order = np.lexsort((codes, width[codes]))
        wide, begun = np.unique(width[codes[order]], return_index=True)
        parts, sizes, of, made = [], [], np.empty(len(codes), np.int64), 0
        for w, lo, hi in zip(wide.tolist(), begun, [*begun[1:], len(order)]):
            if w > SHORT:
                for o in order[lo:hi].tolist():
                    start = first[codes[o]]
                    out = self._long(sym[start : start + w].tolist(), key[o])
                    parts.append(np.array(out, np.int32))
                    sizes.append([len(out)])
                    of[o], made = made, made + 1
                continue
            for at in range(lo, hi, OCCURRENCES):
                some = order[at : min(at + OCCURRENCES, hi)]
                kinds, state = np.unique(codes[some], return_inverse=True)
                got, size, row = self._short(sym[first[kinds][:, None] + np.arange(w)], state, key[some])
                parts.append(got[np.arange(w)[None, :] < size[:, None]])
                sizes.append(size)
                of[some], made = row + made, made + len(size)
        flat, size = np.concatenate(parts), np.concatenate(sizes).astype(np.int64)
        if (flat < 0).any():
            flat, owner = self._as_bytes(flat, np.repeat(np.arange(made), size))
            size = np.bincount(owner, minlength=made)
        return flat, size, of

    def _as_bytes(self, flat, owner):
        """Characters without a piece, as the ids of their bytes."""
        size = np.ones(len(flat), np.int64)
        odd = np.flatnonzero(flat < 0)
        raw = [chr(-c - 1).encode() for c in flat[odd].tolist()]
        size[odd] = [len(r) for r in raw]
        out = np.repeat(flat, size)
        out[np.repeat(flat < 0, size)] = self.bytes_at[np.frombuffer(b"".join(raw), np.uint8)]
        return out, np.repeat(owner, size)

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The texts whose ids these are; the sign ahead of a text's first word is no space of its own."""
        size = self.raw_size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.raw_first[ids] - (ends - size), size)
        raw = self.raw[at] if total else np.zeros(0, np.uint8)
        offsets = np.concatenate([[0], ends])[starts]
        filled = offsets[1:] > offsets[:-1]
        drop = offsets[:-1][filled]
        keep = np.ones(total, bool)
        keep[drop[raw[drop] == ord(" ")]] = False
        lost = np.concatenate([[0], np.cumsum(~keep)])
        offsets = offsets - lost[offsets]
        buffers = [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(raw[keep].tobytes())]
        return pa.LargeStringArray.from_buffers(len(starts) - 1, buffers[1], buffers[2])


def _keys(ids: pa.Array) -> np.ndarray:
    names = ids.cast(pa.string()).fill_null("").to_pylist()
    return np.fromiter((xxhash.xxh64_intdigest(x) for x in names), np.uint64, len(names))


def encode(docs: DataFrame, model: str, id_col="doc_id", text_col="text", rate=0.1, seed=0) -> DataFrame:
    """``id, ids`` for every row."""

    def run(batches):
        coder = MergeDropout(model, rate, seed)
        for batch in batches:
            for part in stretches(batch, 1, TEXT_BYTES):
                ids, starts = coder.encode(part.column(1), _keys(part.column(0)))
                listed = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), listed], ["id", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``id, text`` from ``id, ids``."""

    def run(batches):
        coder = MergeDropout(model, 0.0)
        for batch in batches:
            lists = batch.column(1)
            starts = np.asarray(lists.offsets).astype(np.int64)
            texts = coder.decode(np.asarray(lists.flatten()), starts - starts[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), texts.cast(pa.string())], ["id", "text"])

    return encoded.select("id", "ids").mapInArrow(run, "id long, text string")


def round_trip(docs: DataFrame, model: str, id_col="doc_id", text_col="text", rate=0.1, seed=0) -> DataFrame:
    """Encode and decode in one pass: ``id, n_ids, ids_crc32, decoded_crc32, lossless`` for every row."""

    def run(batches):
        coder = MergeDropout(model, rate, seed)
        for batch in batches:
            for part in stretches(batch, 1, TEXT_BYTES):
                texts = part.column(1).fill_null("")
                ids, starts = coder.encode(texts, _keys(part.column(0)))
                back = coder.decode(ids, starts)
                raw, at = memoryview(ids.astype("<u4").view(np.uint8)), (starts * 4).tolist()
                crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])), np.int64, len(part))
                text_crc = np.fromiter((zlib.crc32(t.encode()) for t in back.to_pylist()), np.int64, len(part))
                same = pc.equal(back, texts.cast(pa.large_string()))
                columns = [part.column(0), pa.array(np.diff(starts)), pa.array(crc), pa.array(text_crc), same]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_ids", "ids_crc32", "decoded_crc32", "lossless"])

    schema = "id long, n_ids long, ids_crc32 long, decoded_crc32 long, lossless boolean"
    return _rows(docs, id_col, text_col).mapInArrow(run, schema)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
