"""Runs of consecutive words with a period, by suffix automaton and link-cut access.

A run is a stretch of words with smallest period ``q`` and at least ``max(SHORTEST, 2 * q)`` words
that no neighbouring word extends.

The suffix automaton of the words is built first. Its suffix links form a tree in which the path
from the state of a prefix to the root holds all suffixes of that prefix. Every state carries the
end of its last occurrence so far; appending word ``i`` recolours the path of prefix ``i`` to ``i``.
Paths of one colour are kept as splay trees and the recolouring is the access of link-cut trees, so
a path is walked segment by segment, ``O(log n)`` of them amortised. A segment of colour ``p`` whose
deepest state has length ``L`` says that the ``L`` words before ``i`` last ended at ``p``. If
``q = i - p`` is at most ``L``, the words from ``p - L + 1`` to ``i`` are a square or more with
smallest period ``q``. Each run shows itself so where its first square ends (a primitive word last
ended exactly ``q`` before); what is found is extended to both sides and counted once.

Only stretches that can hold a run are given to the automaton: every run's ``GRAM``-word grams, but
for ``GRAM - 1`` at most in its middle, come twice inside the run. So stretches of grams that come
twice in their stretch, with gaps of that size, hold all runs whole; they are found by hashes, whose
collisions only add words to look at.

Each text is judged by itself, so nothing is shuffled. Words are ``[^\\x20\\x09-\\x0D]+``. Null and
empty texts have none and no runs. Texts of any length are read whole; a text is one task's work,
about ten microseconds and 500 bytes a word of its stretches. Repeated rows and ids are judged alike; an
empty table gives an empty result; other columns pass through ``collapse``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, by_bytes, read
from tradelane.llm.phrases import mix, union

U = np.uint64
SHORTEST, GRAM = 12, 6
#: Times the stretches are narrowed; more would only spare work.
ROUNDS = 8
SLICE = 4 << 20


def automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """``(length, link, state of each prefix)``; states are counted from 1, the root, and links of it are 0."""
    step: list[dict[int, int]] = [{}, {}]
    link, length, prefix = [0, 0], [0, 0], []
    last = 1
    for c in word:
        here = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(1)
        prefix.append(here)
        p = last
        while p and c not in step[p]:
            step[p][c] = here
            p = link[p]
        if p:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[here] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[here] = copy
        last = here
    return length, link, prefix


class LastEnds:
    """Last occurrences of all suffixes: a tree whose paths of one colour are splay trees.

    The root of a splay tree carries the colour; its parent, not having it as a child, is the
    state above the path.
    """

    def __init__(self, link: list[int]):
        self.above = list(link)
        self.left = [0] * len(link)
        self.right = [0] * len(link)
        self.colour = [-1] * len(link)

    def _splay(self, x: int) -> None:
        above, left, right, colour = self.above, self.left, self.right, self.colour

        def rotate(x: int, p: int) -> None:
            top = above[p]
            if left[p] == x:
                child = left[p] = right[x]
                right[x] = p
            else:
                child = right[p] = left[x]
                left[x] = p
            if child:
                above[child] = p
            above[p] = x
            above[x] = top
            if top:
                if left[top] == p:
                    left[top] = x
                elif right[top] == p:
                    right[top] = x
            colour[x] = colour[p]

        while True:
            p = above[x]
            if not p or (left[p] != x and right[p] != x):
                return
            top = above[p]
            if top and (left[top] == p or right[top] == p):
                same = (left[top] == p) == (left[p] == x)
                rotate(p if same else x, top if same else p)
            rotate(x, above[x])

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """Recolours the path of ``state`` to ``end``: ``(colour, deepest state)`` of the segments met."""
        above, right, colour = self.above, self.right, self.colour
        met = []
        lower, x = 0, state
        while x:
            self._splay(x)
            met.append((colour[x], x))
            if right[x]:
                colour[right[x]] = colour[x]
            right[x] = lower
            lower, x = x, above[x]
        self._splay(state)
        colour[state] = end
        return met


def _agree(word: np.ndarray, a: int, b: int, way: int) -> int:
    """How many words agree from places ``a`` and ``b`` on, going ``way`` (1 or -1)."""
    room = len(word) - max(a, b) if way > 0 else min(a, b) + 1
    done, width = 0, 16
    while done < room:
        n = min(width, room - done)
        if way > 0:
            differ = word[a + done : a + done + n] != word[b + done : b + done + n]
        else:
            differ = word[a - done - n + 1 : a - done + 1][::-1] != word[b - done - n + 1 : b - done + 1][::-1]
        if differ.any():
            return done + int(differ.argmax())
        done, width = done + n, width * 4
    return room


def runs_of(word: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of a sequence of numbers, by start, then period."""
    length, link, prefix = automaton(word.tolist())
    ends = LastEnds(link)
    done: dict[int, int] = {}  # period -> end of its last run
    found = []
    for i, state in enumerate(prefix):
        for p, deepest in ends.access(state, i):
            q = i - p
            if p < 0 or q > length[deepest] or done.get(q, -1) >= i:
                continue
            first = p - length[deepest] + 1
            start = first - _agree(word, first - 1, first - 1 + q, -1) if first else 0
            end = i + _agree(word, i + 1 - q, i + 1, 1)
            done[q] = end
            if end - start + 1 >= max(shortest, 2 * q):
                found.append((start, end - start + 1, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(word: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """Half-open stretches of words that hold all runs of the texts laid end to end (``owner``: the text)."""
    n = len(word) - GRAM + 1
    if n < 1:
        return []
    spread = mix(word.astype(np.uint64) + U(1))
    gram = np.zeros(n, dtype=np.uint64)
    for j in range(GRAM):
        gram = gram * U(0x9E3779B97F4A7C15) + spread[j : j + n]
    at = np.flatnonzero(owner[:n] == owner[GRAM - 1 :])
    part = owner[at].astype(np.uint64)
    for _ in range(ROUNDS):
        key = mix(mix(gram[at]) + part * U(0xC2B2AE3D27D4EB4F))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        if twice.all():
            break
        at = at[twice]
        if not len(at):
            return []
        new = (np.diff(at, prepend=-GRAM - 1) > GRAM) | (np.diff(owner[at], prepend=-1) != 0)
        part = np.cumsum(new).astype(np.uint64)
    edge = np.flatnonzero(np.diff(part, prepend=U(0)) != 0) if len(at) else at
    first, last = at[edge], at[np.concatenate([edge[1:], [len(at)]]) - 1] + GRAM if len(at) else at
    wide = last - first >= SHORTEST
    return list(zip(first[wide].tolist(), last[wide].tolist(), strict=True))


def _numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, equal for equal words, and the text each belongs to."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    word = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), dtype=np.int64)
    return word, np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def runs_in(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text (a list of words)."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    word, owner = _numbers(texts)
    base = np.searchsorted(owner, np.arange(len(texts)))
    for a, b in stretches(word, owner):
        t = int(owner[a])
        shift = a - int(base[t])
        out[t] += [(start + shift, length, q) for start, length, q in runs_of(word[a:b])]
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside runs and those of each run's first period."""
    if not runs:
        return words
    start, length, q = np.array(runs, dtype=np.int64).T
    kept: list[bytes] = []
    done = 0
    for a, b in zip(*(x.tolist() for x in union(start + q, start + length)), strict=True):
        kept += words[done:a]
        done = b
    return kept + words[done:]


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's altered texts: of one id in ten, the end repeats with a period. Null ids keep theirs."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def _mapped(docs: DataFrame, text: int, schema: str, result: Callable, alter: Callable | None = None) -> DataFrame:
    """``mapInArrow`` in slices: ``result(slice, words, runs)``; ``alter(slice)`` may give other words."""

    def make():
        def step(batch):
            for part in by_bytes(batch, text, SLICE):
                words = [t.split() if t else [] for t in part.column(text).to_pylist()]
                words = alter(part, words) if alter else words
                yield result(part, words, runs_in(words))

        return step

    return arrow_map(docs, make, schema)


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` with the repetitions of each run removed from ``text``, the rest joined by one space.

    Texts without runs are left as they are; ``n_chars``, where there is one, is counted anew.
    """
    names = docs.columns
    packed = docs.toDF(*[f"_{i}" for i in range(len(names))])
    at = names.index("text")
    schema = ", ".join(f"`{n}` {t}" for n, t in packed.dtypes)

    def result(batch, words, runs):
        old = batch.column(0).to_pylist()
        raw = [b" ".join(collapsed(w, r)) if r else o for o, w, r in zip(old, words, runs, strict=True)]
        columns = list(batch.columns[1:])
        columns[at] = pa.array([None if t is None else t.decode() for t in raw], pa.string())
        if "n_chars" in names:
            i = names.index("n_chars")
            columns[i] = pa.array([len((t or b"").decode()) for t in raw]).cast(columns[i].type)
        return pa.RecordBatch.from_arrays(columns, batch.schema.names[1:])

    return _mapped(packed.select(F.col(f"_{at}").cast("binary").alias("_text"), "*"), 0, schema, result).toDF(*names)


RESULT = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def report(docs: DataFrame, alter: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row of ``docs``: number of runs, the longest run, and digests of all runs and of what is kept.

    ``alter(doc_id, words)`` may change a text's words first.
    """

    def altered(batch, words):
        return [alter(i, w) for i, w in zip(batch.column(0).to_pylist(), words, strict=True)]

    def result(batch, words, runs):
        longest = [min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None, None, None) for r in runs]
        listed = ["".join(f"{s},{n},{q}\n" for s, n, q in r) for r in runs]
        columns = [pa.array([len(r) for r in runs], pa.int64()), *(pa.array([x[i] for x in longest], pa.int64()) for i in range(3))]
        columns.append(pa.array([None if n is None else 1000 * n // q for _, n, q in longest], pa.int64()))
        columns.append(pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]))
        columns.append(pa.array([hashlib.sha256(b" ".join(collapsed(w, r))).hexdigest() for w, r in zip(words, runs, strict=True)]))
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return _mapped(rows, 1, RESULT, result, altered if alter else None)


def op13_periodic_runs(spark, sf_dir) -> DataFrame:
    return report(read(spark, sf_dir, "documents"), repeated_tail)
