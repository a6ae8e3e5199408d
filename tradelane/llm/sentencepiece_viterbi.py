"""SentencePiece encoding and decoding by batched Viterbi in numpy.

A text is cut where spaces stood (the escaped space begins a word), words that a task has not
met are collected, and words of equal length advance together: hashes of all their
substrings, by prefix sums, probe the sorted piece keys; then position by position the best
score of any piece ending there is a vectorised maximum whose argument is the back pointer.

The segmentation has the greatest sum of the vocabulary's piece scores (on equal sums, the
longest last piece): what SentencePiece computes for unigram models. A vocabulary stored as
merges has ranks for scores, and its ids are those that merging gives. There a piece is admitted
behind a path only if its border with the path's last piece holds: the two, merged by
themselves, stay those two (the first merge across a border would also happen in the pair
alone). Exactly one path of every beginning of a word has borders that all hold, so the maximum
runs over what merging leaves there, and no word is merged anew. Borders are tested in bulk, by
undoing the later of the two pieces' last merges again and again and looking for a better-ranked
piece across the border, and remembered in a table of fixed size. Pieces whose own merges do not
come in order of rank would be replayed pair by pair; ``replayed`` counts such pairs.
Either way the ids are SentencePiece's own. Characters without a piece become their UTF-8
bytes' pieces.

A word is a run of escaped spaces and the characters up to the next one. No piece has an escaped
space after another character, so a word's ids depend on the word alone.

Null text is empty and has no pieces. Texts are encoded whole; repeated rows alike. A text that
holds the escape character itself reads back with a space there, as in SentencePiece.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, read

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
NORMAL, BYTE = 1, 6
MERGES = 2
WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Words whose ids a task remembers; the oldest half goes when it is full.
MEMORY = 1_000_000
#: Characters of one batch of equally long words.
BATCH = 200_000
#: Places of the table of tested borders (8 bytes each), and of the filter before the sorted keys.
BORDERS, FILTER = 1 << 22, 20
NEVER = np.iinfo(np.int32).max


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            return value, at


def _fields(data: bytes):
    """``(number, value)`` of a serialised message: ints, or bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = 4 if kind == 5 else 8
            if kind == 2:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def load_pieces(path: str) -> list[tuple[str, float, int]]:
    """``(piece, score, type)`` in id order of a model file."""
    with open(path, "rb") as f:
        data = f.read()
    out = []
    for number, value in _fields(data):
        if number == 1:
            part = dict(_fields(value))
            score = float(np.frombuffer(part.get(2, b"\0\0\0\0"), dtype="<f4")[0])
            out.append((part[1].decode("utf-8"), score, part.get(3, NORMAL)))
    return out


def model_kind(path: str) -> int:
    """1: unigram, 2: merges (of the trainer's settings in the model file)."""
    with open(path, "rb") as f:
        settings = next((v for n, v in _fields(f.read()) if n == 2), b"")
    return dict(_fields(settings)).get(3, 1)


class Viterbi:
    def __init__(self, path: str):
        pieces = load_pieces(path)
        normal = [(p, s, i) for i, (p, s, t) in enumerate(pieces) if t == NORMAL]
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in normal):
            raise ValueError("a piece goes on beyond a word")
        self.rank = {p: s for p, s, _ in normal} if model_kind(path) == MERGES else None
        self.bytes_ids = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.longest = max(len(p) for p, _, _ in normal)
        worst = min(s for _, s, _ in normal)
        self.fallback = worst - 10.0
        rng = np.random.default_rng(211)
        self.base = int(rng.integers(0, 2**63)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self._powers(self.base, self.longest + 1)
        raw = np.zeros(len(normal), dtype=np.uint64)
        by_length: dict[int, list[int]] = {}
        for k, (p, _, _) in enumerate(normal):
            by_length.setdefault(len(p), []).append(k)
        for length, at in by_length.items():
            raw[at] = self._sums(self._codes([normal[k][0] for k in at], length))[-1]
        size = np.array([len(p) for p, _, _ in normal])
        keys = self._mixed(raw, size)
        order = np.argsort(keys)
        self.keys, self.raw, self.size = keys[order], raw[order], size[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << FILTER, dtype=bool)
        self.maybe[self.keys >> np.uint64(64 - FILTER)] = True
        self.scores = np.array([normal[k][1] for k in order])
        self.ids = np.array([normal[k][2] for k in order], dtype=np.int64)
        self.piece = [normal[k][0] for k in order]
        self.text = [p for p, _, _ in pieces]
        self.table = [p.encode() for p in self.text]
        for b, i in self.bytes_ids.items():
            self.table[i] = bytes([b])
        self.known: dict[str, bytes] = {}
        self.replayed = 0
        if self.rank is not None:
            self._read_merges()

    @staticmethod
    def _codes(words: list[str], length: int) -> np.ndarray:
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return flat.reshape(len(words), length)

    def _powers(self, base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def _sums(self, codes: np.ndarray) -> np.ndarray:
        """Hashes of all beginnings of equally long words: (length + 1, words)."""
        value = (codes.T.astype(np.uint64) + np.uint64(0x9E37)) * np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
        sums = np.zeros((codes.shape[1] + 1, len(codes)), dtype=np.uint64)
        np.cumsum(value * self._powers(self.base, codes.shape[1])[:, None], axis=0, out=sums[1:])
        return sums

    @staticmethod
    def _mixed(raw: np.ndarray, length) -> np.ndarray:
        h = (raw ^ (raw >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h + np.asarray(length).astype(np.uint64)

    def _probe(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes among the sorted piece keys, -1 for none."""
        out = np.full(h.shape, -1, dtype=np.int32)
        some = np.nonzero(self.maybe[h >> np.uint64(64 - FILTER)])
        wanted = h[some]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        out[some] = np.where(self.keys[at] == wanted, at, -1)
        return out

    def _found(self, codes: np.ndarray) -> list[np.ndarray]:
        """Per length the pieces at every place: ``found[length][start, word]``."""
        size = codes.shape[1]
        sums, down = self._sums(codes), self._powers(self.inverse, size + 1)[:, None]
        found = [np.empty((0, 0), dtype=np.int32)]
        for length in range(1, min(self.longest, size) + 1):
            found.append(self._probe(self._mixed((sums[length:] - sums[:-length]) * down[: size + 1 - length], length)))
        return found

    def _read_merges(self) -> None:
        """The last merge of every piece, its rank, and whether its merges come in order of rank."""
        n = len(self.keys)
        self.left, self.right = np.full((2, n), -1, dtype=np.int32)
        self.order = (-self.scores).astype(np.int32)
        self.valid, self.plain = self.size == 1, self.size == 1
        single = {p for p in self.piece if len(p) == 1}
        if any(c not in single for p in self.piece for c in p):
            raise ValueError("a piece holds a character that is none")
        self.time = np.where(self.valid, -1, self.order)
        for size in range(2, self.longest + 1):
            rows = np.flatnonzero(self.size == size)
            if not len(rows):
                continue
            found = self._found(self._codes([self.piece[k] for k in rows], size))
            cut = self._parted(found[:size], len(rows), size)
            for first in np.unique(cut[cut > 0]).tolist():
                at = np.flatnonzero(cut == first)
                here, a, b = rows[at], found[first][0, at], found[size - first][first, at]
                self.left[here], self.right[here], self.valid[here] = a, b, True
                self.plain[here] = self.plain[a] & self.plain[b] & (self.time[here] > np.maximum(self.time[a], self.time[b]))
        self.borders = np.full(BORDERS, -1, dtype=np.int64)

    def _parted(self, found: list[np.ndarray], n: int, size: int) -> np.ndarray:
        """Merges words of one length, never to one whole: where the second of two symbols begins, or 0."""
        longest = len(found) - 1
        score = np.full((size + 1, n, size), -np.inf)
        for length in range(2, longest + 1):
            piece = found[length].T
            score[length, :, : size + 1 - length] = np.where(piece >= 0, self.scores[piece], -np.inf)
        at = np.arange(n)
        end, before = np.tile(np.arange(1, size + 1), (n, 1)), np.tile(np.arange(-1, size - 1), (n, 1))
        offer = score[2].copy()
        while len(at):
            a = offer[at].argmax(axis=1)  # the leftmost of equals
            some = offer[at, a] > -np.inf
            at, a = at[some], a[some]
            m = end[at, a]
            e = end[at, m]
            end[at, a], end[at, m], offer[at, m] = e, 0, -np.inf
            inner = e < size
            offer[at, a] = score[np.where(inner, end[at, np.minimum(e, size - 1)] - a, 0), at, a]
            before[at[inner], e[inner]] = a[inner]
            left = before[at, a] >= 0
            row, place = at[left], before[at, a][left]
            offer[row, place] = score[e[left] - place, row, place]
        first = end[:, 0]
        return np.where((first < size) & (end[np.arange(n), np.minimum(first, size - 1)] == size), first, 0)

    def _stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging keeps each pair of pieces apart."""
        stay = np.ones(len(a), dtype=bool)
        for k in np.flatnonzero(~(self.plain[a] & self.plain[b])).tolist():
            self.replayed += 1
            stay[k] = self._replay(self.piece[a[k]] + self.piece[b[k]]) == [self.piece[a[k]], self.piece[b[k]]]
        live = np.flatnonzero(self.plain[a] & self.plain[b])
        x, y = a[live], b[live]
        above_x, above_y = np.full((2, len(live)), NEVER, dtype=np.int32)
        while len(live):
            size = self.size[x] + self.size[y]
            fits = np.flatnonzero(size <= self.longest)
            over = np.full(len(live), NEVER, dtype=np.int32)
            h = self.raw[x[fits]] + self.raw[y[fits]] * self.up[self.size[x[fits]]]
            whole = self._probe(self._mixed(h, size[fits]))
            over[fits[whole >= 0]] = self.order[whole[whole >= 0]]
            # of equal ranks the leftmost comes first: x's own merge, then the one across, then y's
            across = (over < above_x) & (over <= above_y) & (over < NEVER)
            stay[live[across]] = False
            tx, ty = self.time[x], self.time[y]
            on = ~across & ((tx >= 0) | (ty >= 0))
            live, x, y, tx, ty, above_x, above_y = (v[on] for v in (live, x, y, tx, ty, above_x, above_y))
            later = tx > ty  # of equal ranks y was merged later
            above_x, above_y = np.where(later, tx, above_x), np.where(later, above_y, ty)
            x, y = np.where(later, self.right[x], x), np.where(later, y, self.left[y])
        return stay

    def _holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_stay``, remembered; ``a`` is -1 where no piece, or a character without one, goes before."""
        out = np.ones(len(a), dtype=bool)
        real = np.flatnonzero(a >= 0)
        pair = (a[real].astype(np.int64) << 32) | (b[real].astype(np.int64) << 1)
        slot = ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (BORDERS - 1)
        entry = self.borders[slot]
        new = np.flatnonzero((entry | 1) != (pair | 1))
        if len(new):
            fresh, back = np.unique(pair[new], return_inverse=True)
            fresh |= self._stay((fresh >> 32).astype(np.int32), ((fresh & 0xFFFFFFFF) >> 1).astype(np.int32))
            entry[new] = fresh[back]
            self.borders[slot[new]] = entry[new]
        out[real] = entry & 1 == 1
        return out

    def segment(self, words: list[str]) -> list[list[int]]:
        """Best segmentation of words of one length."""
        return [np.frombuffer(ids, dtype="<u4").tolist() for ids in self._segment(words)]

    def _segment(self, words: list[str]) -> list[bytes]:
        n, size = len(words), len(words[0])
        found = self._found(self._codes(words, size))
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        back = np.zeros((size + 1, n), dtype=np.int32)
        last = np.full((size + 1, n), -1, dtype=np.int32)  # the path's last piece
        for end in range(1, size + 1):
            for length in range(min(self.longest, end), 0, -1):
                piece = found[length][end - length]
                rows = np.flatnonzero(piece >= 0)
                if self.rank is not None:  # one path holds: who has it needs no other
                    rows = rows[back[end, rows] == 0]
                    rows = rows[self.valid[piece[rows]]]
                    rows = rows[self._holds(last[end - length, rows], piece[rows])]
                score = best[end - length, rows] + self.scores[piece[rows]]
                better = score > best[end, rows]
                rows = rows[better]
                best[end, rows], back[end, rows], last[end, rows] = score[better], length, piece[rows]
            rows = np.flatnonzero(found[1][end - 1] < 0)
            score = best[end - 1, rows] + self.fallback
            better = score > best[end, rows]
            rows = rows[better]
            best[end, rows], back[end, rows], last[end, rows] = score[better], 1, -1
        ids = np.full((n, size), -1, dtype=np.int64)
        rows, end = np.arange(n), np.full(n, size)
        odd = np.zeros(n, dtype=bool)
        while len(rows):
            piece = last[end, rows]
            end = end - back[end, rows]
            ids[rows, end] = np.where(piece >= 0, self.ids[piece], -2)
            odd[rows[piece < 0]] = True
            rows, end = rows[end > 0], end[end > 0]
        flat = ids[ids >= 0].astype("<u4").tobytes()
        stop = (np.cumsum((ids >= 0).sum(axis=1)) * 4).tolist()
        out = [flat[a:b] for a, b in zip([0, *stop], stop, strict=False)]
        for row in np.flatnonzero(odd).tolist():
            own = [
                [i] if i >= 0 else [self.bytes_ids[x] for x in words[row][k].encode("utf-8", "surrogatepass")]
                for k, i in enumerate(ids[row].tolist())
                if i != -1
            ]
            out[row] = np.array([i for part in own for i in part], dtype="<u4").tobytes()
        return out

    def _replay(self, word: str) -> list[str]:
        """Symbols by merging: the best-ranked neighbours first, the leftmost of equals."""
        rank = self.rank
        size = len(word)
        end, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []

        def offer(a: int) -> None:
            m = end[a]
            if m < size:
                score = rank.get(word[a : end[m]])
                if score is not None:
                    heapq.heappush(heap, (-score, a, m, end[m]))

        for a in range(size):
            offer(a)
        while heap:
            _, a, m, e = heapq.heappop(heap)
            if end[a] != m or end[m] != e:  # one of the two has been merged since
                continue
            end[a], end[m] = e, -1
            if e < size:
                before[e] = a
                offer(a)
            if before[a] >= 0:
                offer(before[a])
        out, a = [], 0
        while a < size:
            out.append(word[a : end[a]])
            a = end[a]
        return out

    @staticmethod
    def _words(text: str) -> list[str]:
        """Words without their first escaped space."""
        if "  " not in text and text[0] != " " and SPACE not in text:
            return text.split(" ")
        return [w[1:] for w in WORD.findall(SPACE + text.replace(" ", SPACE))]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        split = [self._words(t) if t else [] for t in texts]
        known = self.known
        if len(known) > MEMORY:
            for w in list(known)[: MEMORY // 2]:
                del known[w]
        groups: dict[int, list[str]] = {}
        for w in set().union(*split).difference(known):
            groups.setdefault(len(w), []).append(w)
        for size, words in groups.items():
            step = max(1, BATCH // (size + 1))
            for i in range(0, len(words), step):
                part = words[i : i + step]
                known.update(zip(part, self._segment([SPACE + w for w in part]), strict=True))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return data.decode("utf-8", "surrogatepass").replace(SPACE, " ")[1:]


@functools.lru_cache(maxsize=2)
def model(path: str) -> Viterbi:
    """One model per Python worker: its tasks go on with the words and borders it knows."""
    return Viterbi(path)


def op7_sentencepiece_viterbi(spark, sf_dir, path: str | None = None) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = path or public_tokenizers.path(VOCABULARY)

    def make():
        own = model(path)

        def step(batch):
            rows = []
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(ids), 1000):
                part = texts[i : i + 1000]
                for doc, text, data in zip(ids[i : i + 1000], part, own.encode(part), strict=True):
                    again = own.decode(data)
                    digest = hashlib.sha256(again.encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((doc, len(data) // 4, zlib.crc32(data), digest, again == (text or "").replace(SPACE, " ")))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "exact"],
            )

        return step

    return arrow_map(docs, make, "doc_id bigint, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, exact boolean")

