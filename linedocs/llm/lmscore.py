"""Language-model scores by online logistic mixing of hashed-context predictors.

A text is its lower-cased words, each followed by a space, then a line end.  A byte
is a path through a binary code tree chosen by the byte before (frequent bytes have short paths), so a
byte is a few binary decisions.  Three predictors look each decision up by a hash of the tree
node and a context: the last two bytes, the last four bytes (across words), the word so far.

1. Every training text belongs to one of two folds (by a hash of the text, so that equal texts are together).
   One pass counts, by fold, words and their heads: the first three bytes of a word after the three before
   its space.
2. The pairs of neighbouring bytes, from the counted words, shape the code trees.  No context goes from a
   later byte of a word to another word, so the tables of hashed slots are filled from counted heads and
   counted words, not decision by decision.  Every task adds up its own tables, slices of them are summed
   after a shuffle in two levels.  Slots become one byte each: a quantised logit and how often the slot was seen; once per fold and once for both.
3. The mixer is learned online in tasks, over all training texts, each with the tables of the fold that it is
   not in: the logits are combined by weights that a gate chooses from the three levels of experience, with a
   step along the gradient after each small batch, in shards and an order that hashes of id and text give.  An adaptive map of the mixed probability per depth in the
   tree is counted on the way.  The tasks' weights are averaged by how often each gate was used, their maps summed.
4. All texts are scored with the tables of both folds: per decision three look-ups, three weighted logits,
   one cost.  What is broadcast has the fixed size of the tables.

In 4 a worker keeps the costs of the heads and tails of words that it has met, in bounded memory.

The base score needs every word's count.  The ``head_words`` most frequent are
broadcast; the others are joined, a document's rare words at a time.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from itertools import islice
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

END = "\n"
SPACE, STOP = 32, 10
TABLE_BITS = (18, 20, 22)  # slots of each predictor
SLICE = 1 << 16
MIX, ODD = 0x9E3779B1, 0x85EBCA6B
LEVELS, LIMIT = 64, 8.0
QUANTA, QLIMIT, DEPTHS = 384, 12.0, 16
CHUNK = 1 << 15
PAD = 4
HEAD = 3  # bytes of a word whose contexts reach into the word before
GROUP = 1 << 20  # bytes of texts whose words are looked up at once
MOST_HEADS = 1 << 20  # heads that a task gathers before it counts them
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # of the first bytes of eight
PART_BYTES = 24 << 20  # of the heads, the short and the long words that a worker remembers, each
SHARD_BYTES, MOST_SHARDS = 16 << 20, 100_000  # bytes of text that a mixer is learned on in one place
MOST_WORDS = 600_000  # distinct words that a task counts before it passes them on


def stream_of(words: list[bytes]) -> bytes:
    return b" ".join([*words, b"\n"])


def code_tree(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """Binary code of the 256 bytes for how often each occurs: its decisions (node, bit)."""
    heap = [(int(c) + 1, i, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    children, nxt = {}, 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        children[nxt] = (a[2], b[2])
        heapq.heappush(heap, (a[0] + b[0], nxt, nxt))
        nxt += 1
    paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    todo = [(heap[0][2], [])]
    while todo:
        node, path = todo.pop()
        if node < 256:
            paths[node] = path
        else:
            for bit, child in enumerate(children[node]):
                todo.append((child, [*path, (node - 256, bit)]))
    return paths


def pairs_of(sample: bytes) -> np.ndarray:
    """How often each (byte before, byte) occurs, as flat counts."""
    x = np.frombuffer(sample, np.uint8).astype(np.int64)
    return np.bincount(x[:-1] * 256 + x[1:], minlength=1 << 16)


def code_trees(sample: bytes) -> dict:
    return trees_of(pairs_of(sample))


def trees_of(counts: np.ndarray) -> dict:
    """A code for each byte before, from the counts of pairs: tables by (byte before, byte) of its decisions'
    number and place in flat tables of their depth and bit, and of a hash of their node."""
    counts = counts.reshape(256, 256)
    codes = [path for row in counts for path in code_tree(row)]
    length = np.array([len(p) for p in codes], np.intp)
    node = np.array([(i & ~255) | n for i, p in enumerate(codes) for n, _ in p], np.uint32)
    return {"length": length, "start": length.cumsum() - length, "salt": mixed_hash(node + np.uint32(77)),
            "step": np.array([min(d, DEPTHS - 1) << 1 | b for p in codes for d, (_, b) in enumerate(p)], np.uint8)}


def looked_up(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``table[at]`` of places that are all inside; numpy's fastest way."""
    return np.take(table, at, mode="clip")


def mixed_hash(x: np.ndarray) -> np.ndarray:
    x = x * np.uint32(ODD)
    return (x ^ (x >> np.uint32(15))) * np.uint32(MIX)


class Coder:
    """Turns streams into decisions; keeps what every batch needs again."""

    def __init__(self, tree: dict):
        self.tree, self.size = tree, 0

    def grow(self, n: int) -> None:
        """Powers of ODD and of its inverse modulo 2^32 for n places, and 0, 1, 2..."""
        if n > self.size:
            self.size = 1 << max(17, n.bit_length())

            def powers(base: int) -> np.ndarray:
                return np.cumprod(np.concatenate([[1], np.full(self.size - 1, base)]).astype(np.uint32), dtype=np.uint32)

            self.power, self.back = powers(ODD), powers(pow(ODD, -1, 1 << 32))
            self.upward = np.arange(8 * self.size, dtype=np.intp)

    def skipped(self, head: bytes) -> int:
        """Decisions of the bytes of ``head`` at the start of a text."""
        x = np.frombuffer(b" " + head, np.uint8).astype(np.intp)
        return int(self.tree["length"][x[:-1] << 8 | x[1:]].sum())

    def contexts(self, streams: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """(byte before, byte) as a number, decisions of each, the contexts (two, four, the word so far), where streams start.

        A stream sees nothing of the one before it: each begins after ``PAD`` spaces, which are only context."""
        lengths = np.fromiter(map(len, streams), np.int64, len(streams))
        return self.contexts_in(padded(streams)[:-PAD], (lengths + PAD).cumsum() - lengths)

    def contexts_in(self, x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """The same of streams that are joined already, each after ``PAD`` spaces."""
        n = len(x)
        pair = np.concatenate([np.zeros(1, np.intp), x[:-1].astype(np.intp) << 8])
        pair |= x
        reps = np.take(self.tree["length"], pair)
        reps[(begin[:, None] - np.arange(1, PAD + 1)).ravel()] = 0
        wide = np.concatenate([np.zeros(PAD, np.uint32), x.astype(np.uint32)])
        two = wide[3:-1] | wide[2:-2] << np.uint32(8)
        four = two | wide[1:-3] << np.uint32(16) | wide[:-4] << np.uint32(24)
        # hash of the word so far: sum of byte * odd^position from its start to here, scaled back
        self.grow(n + 1)
        sums = np.concatenate([np.zeros(1, np.uint32), np.cumsum((wide[PAD:] + np.uint32(1)) * self.power[:n], dtype=np.uint32)[:-1]])
        edge = np.where((x == SPACE) | (x == STOP), self.upward[1:n + 1], 0)
        word = np.concatenate([np.zeros(1, np.intp), np.maximum.accumulate(edge)[:-1]])
        so_far = (sums - np.take(sums, word)) * np.take(self.back, word)
        return pair, reps, [two, four, so_far], begin

    def expand(self, pair: np.ndarray, reps: np.ndarray, contexts: dict[int, np.ndarray]) -> tuple:
        """depth of every decision of the bytes, its slot in the table of each given predictor, its bit."""
        tree = self.tree
        self.grow(len(pair))
        ends = reps.cumsum()
        total = int(ends[-1])
        of = np.repeat(self.upward[:len(pair)], reps)  # the one costly step: all else are look-ups by it
        flat = looked_up(np.take(tree["start"], pair) - (ends - reps), of)
        flat += self.upward[:total] if total <= len(self.upward) else np.arange(total)
        salt = looked_up(tree["salt"], flat)
        slots = {}
        for i, c in contexts.items():
            slot = looked_up(mixed_hash(c + np.uint32(i + 1)), of)
            slot += salt
            slot >>= np.uint32(32 - TABLE_BITS[i])
            slots[i] = slot.astype(np.intp)
        step = looked_up(tree["step"], flat)
        return step >> 1, slots, step & 1

    def decisions(self, streams: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """depth of every decision of the streams, its slot in each table, its bit, and where each stream starts."""
        pair, reps, contexts, begin = self.contexts(streams)
        depth, slots, bit = self.expand(pair, reps, dict(enumerate(contexts)))
        return depth, list(slots.values()), bit, (reps.cumsum() - reps)[begin]

    def heads(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """As ``contexts``, of the heads with these keys: each a stream whose first ``PAD`` bytes are only context."""
        x = np.full((len(keys), 2 * PAD + HEAD), SPACE, np.uint8)
        for i, column in enumerate((4, 5, 6, 8, 9, 10)):
            x[:, column] = keys >> (40 - 8 * i) & 255
        begin = np.arange(len(keys)) * x.shape[1] + PAD
        pair, reps, contexts, _ = self.contexts_in(x.ravel(), begin)
        own = reps.reshape(x.shape)
        own[:, :2 * PAD] = 0
        own[x[:, 8] == STOP, 9:] = 0
        own[x[:, 9] == SPACE, 10] = 0
        return pair, reps, contexts, begin

    def tails(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """As ``contexts``, of words and the space after each, without the decisions of their heads."""
        pair, reps, contexts, begin = self.contexts([w + b" " for w in words])
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        for k in range(HEAD):
            reps[begin[lengths > k] + k] = 0
        return pair, reps, contexts, begin


def padded(streams: list[bytes]) -> np.ndarray:
    """The bytes of streams with ``PAD`` spaces before, between and after them."""
    pad = b" " * PAD
    return np.frombuffer(pad + pad.join([*streams, b""]), np.uint8)


def head_keys(x: np.ndarray, step: int = GROUP) -> np.ndarray:
    """A number for the head of each word of padded streams, in their order: the three bytes before the
    space before the word, then the word's first ``HEAD`` (zero after its space, and after a line end)."""
    out = [np.zeros(0, np.int64)]
    for low in range(PAD, len(x) - 2, step):
        part = x[low - PAD:min(low + step, len(x) - 2) + 2]
        space = part == SPACE
        at = np.flatnonzero(space[3:-3] & ~space[4:-2]) + 4
        wide = part.astype(np.uint32)
        three = wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]
        own = np.take(three, at)
        own &= np.where(np.take(space, at + 1), np.uint32(0xFFFF00), np.uint32(0xFFFFFF))
        own[np.take(part, at) == STOP] = STOP << 16
        out.append(np.take(three, at - 4).astype(np.int64) << 24 | own)
    return np.concatenate(out)


class Heads:
    """Counts the heads of words."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new, self.size = [], 0

    def add(self, streams: Iterator[bytes]) -> None:
        for batch in batches_of(streams, GROUP):
            self.new.append(head_keys(padded(batch)))
            self.size += len(self.new[-1])
            if self.size > MOST_HEADS:
                self.counted()

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys in order, and how often each occurs."""
        if self.new:
            keys, counts = np.unique(np.concatenate(self.new), return_counts=True)
            self.new, self.size = [], 0
            keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
            order = keys.argsort(kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
            self.keys, self.counts = keys[first], np.add.reduceat(counts[order], first) if len(first) else counts
        return self.keys, self.counts


class Counts:
    """What one task gathers from texts (the heads of their words) and from counted words (all else)."""

    def __init__(self, coder: Coder, kind: type = np.uint32):
        self.coder = coder
        self.tables = [np.zeros(2 << bits, kind) for bits in TABLE_BITS]
        self.heads = Heads()

    def texts(self, streams: Iterator[bytes]) -> None:
        self.heads.add(streams)

    def counted_heads(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Count the decisions of heads, as often as each occurs: those after four bytes, and the first after two."""
        for at in range(0, len(keys), 3000):
            pair, reps, (two, four, _), begin = self.coder.heads(keys[at:at + 3000])
            first = np.zeros(len(reps), bool)
            first[begin + PAD] = True
            self.weighted(pair, reps, {0: two, 1: four}, begin, counts[at:at + 3000], {0: first})

    def weighted(self, pair: np.ndarray, reps: np.ndarray, contexts: dict[int, np.ndarray], begin: np.ndarray,
                 times: np.ndarray, only: dict[int, np.ndarray]) -> None:
        """Count decisions, ``times`` for each stream; in a table only those of bytes where ``only`` is true."""
        _, slots, bit = self.coder.expand(pair, reps, contexts)
        times = np.repeat(times, np.add.reduceat(reps, begin)).astype(self.tables[0].dtype, copy=False)
        for i, slot in slots.items():
            slot <<= 1
            slot += bit
            if i in only:
                own = np.flatnonzero(np.repeat(only[i], reps))
                np.add.at(self.tables[i], np.take(slot, own), np.take(times, own))
            else:
                np.add.at(self.tables[i], slot, times)

    def words(self, words: list[str], counts: np.ndarray, tables: tuple[int, ...] = (0, 1, 2)) -> None:
        """Count the decisions of words and of ends, as often as each occurs: all after the word so far, those
        after four bytes past the heads, and those after two bytes past the first."""
        for at in range(0, len(words), 4000):
            texts = [w.encode() + (b"" if w == END else b" ") for w in words[at:at + 4000]]
            times = np.asarray(counts[at:at + 4000]).astype(np.uint64)
            short = [w for w in texts if len(w) <= 2 * CHUNK]
            if len(short) < len(texts):
                for w, c in zip(texts, times):
                    for piece, known in pieces_of(w) if len(w) > 2 * CHUNK else ():
                        self.some_words([piece], np.array([c]), tables, known)
                times = times[[len(w) <= 2 * CHUNK for w in texts]]
            if short:
                self.some_words(short, times, tables)

    def some_words(self, texts: list[bytes], times: np.ndarray, tables: tuple[int, ...], known: int = 0) -> None:
        """Of a piece of a word, the first ``known`` bytes are counted already."""
        pair, reps, contexts, begin = self.coder.contexts(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        reps[begin[0]:begin[0] + known] = 0
        past = {i: np.ones(len(reps), bool) for i in (0, 1)}
        past[0][begin] = False
        for k in range(HEAD):
            past[1][begin[lengths > k] + k] = False
        self.weighted(pair, reps, {i: contexts[i] for i in tables}, begin, times, past)

    def finish(self) -> list[np.ndarray]:
        """The tables, with all heads counted."""
        self.counted_heads(*self.heads.counted())
        return self.tables


def batches_of(streams: Iterator[bytes], most: int | None = None) -> Iterator[list[bytes]]:
    """Streams in lists of about ``most`` bytes (CHUNK); a longer one is alone."""
    most = most or CHUNK
    out, size = [], 0
    for s in streams:
        if out and size + len(s) > most:
            yield out
            out, size = [], 0
        out.append(s)
        size += len(s)
    if out:
        yield out


def pieces_of(stream: bytes) -> Iterator[tuple[bytes, int]]:
    """A very long stream in pieces of CHUNK, each with how many bytes before it are only context."""
    if len(stream) <= 2 * CHUNK:
        yield stream, 0
        return
    at = 0
    while at < len(stream):
        # start at the word, and four bytes before, so that every context is whole
        back = at
        if at:
            back = max(0, min(at - 4, max(stream.rfind(b" ", 0, at), at - (1 << 12))))
        yield stream[back:at + CHUNK], at - back
        at += CHUNK


def short_of(streams: Iterator[bytes], long: list[bytes]) -> Iterator[bytes]:
    """The streams that need no cutting; the others are put into ``long``."""
    for s in streams:
        if len(s) <= 2 * CHUNK:
            yield s
        else:
            long.append(s)


class Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


class Lookup:
    """Values by number keys, found once for each key that is met."""

    def __init__(self, width: int):
        self.keys, self.values = None, np.zeros((0, width))

    def of(self, keys: np.ndarray, found: Callable) -> np.ndarray:
        """A row of values for each of ``keys``; ``found`` gives those of keys not met before, from places where they stand."""
        order = keys.argsort()
        ranked = np.take(keys, order)
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        own = ranked[first]
        known = self.keys is not None and len(self.keys)
        fresh = np.take(self.keys, np.searchsorted(self.keys, own), mode="clip") != own if known else np.ones(len(own), bool)
        if fresh.any():
            both = np.concatenate([*([self.keys] if known else []), own[fresh]])
            values = np.concatenate([self.values, found(order[first][fresh])])
            by_key = both.argsort(kind="stable")
            self.keys, self.values = both[by_key], values[by_key]
        out = np.empty((len(keys), self.values.shape[1]))
        out[order] = np.take(np.take(self.values, np.searchsorted(self.keys, own), axis=0), first.cumsum() - 1, axis=0)
        return out


class Parts:
    """The heads and tails of the words that a scoring worker has met, with their costs.  Equal parts have equal
    decisions, so each is looked up once, and kept until too much is; so is what ``known`` says of a word.
    Words of up to eight bytes are looked up by these as a number."""

    def __init__(self, coder: Coder, tables: list[np.ndarray], mixer: dict, known: Callable = lambda word, other: other):
        self.coder, self.tables, self.mixer, self.known = coder, tables, mixer, known
        self.heads, self.short = Lookup(1), Lookup(2)
        self.long, self.long_values, self.long_size = Numbers(), np.zeros((0, 2)), 0

    def forget(self, most: int = PART_BYTES) -> None:
        """Start again what has become larger than ``most`` bytes."""
        if 16 * len(self.heads.values) > most:
            self.heads = Lookup(1)
        if 24 * len(self.short.values) > most:
            self.short = Lookup(2)
        if self.long_size > most:
            self.long, self.long_values, self.long_size = Numbers(), np.zeros((0, 2)), 0

    def costs(self, pair: np.ndarray, reps: np.ndarray, contexts: list[np.ndarray], begin: np.ndarray) -> np.ndarray:
        """Sums over the decisions of each part (zero where it has none)."""
        depth, slots, bit = self.coder.expand(pair, reps, dict(enumerate(contexts)))
        cost = costs_of(depth, [looked_up(t, s) for t, s in zip(self.tables, slots.values())], bit, self.mixer)
        n = np.add.reduceat(reps, begin)
        out, some = np.zeros(len(n)), n > 0
        if some.any():
            out[some] = np.add.reduceat(cost.astype(np.float64), (n.cumsum() - n)[some])
        return out

    def found(self, words: list[bytes]) -> np.ndarray:
        """Rows of a tail's cost and what is known of the word."""
        costs = np.concatenate([np.zeros(0), *(self.costs(*self.coder.tails(b)) for b in batches_of(iter(words)))])
        return np.stack([costs, np.array([self.known(w, math.nan) for w in words], float)], axis=1)

    def of(self, streams: list[bytes], words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each word (and line end) of some short streams, in order: log10 probability, and what is known of it."""
        self.forget()
        x = padded(streams)
        keys = head_keys(x)
        cost = self.heads.of(keys, lambda at: np.concatenate([
            self.costs(*self.coder.heads(keys[at[i:i + 3000]])) for i in range(0, len(at), 3000)])[:, None])[:, 0]
        space = x == SPACE
        begin, end = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
        few = end - begin <= 8
        short, long = np.flatnonzero(few), np.flatnonzero(~few)
        values = np.empty((len(words), 2))
        # the word's bytes and the space after it, if that is among the eight; zeros
        eight = np.frombuffer(x.tobytes() + bytes(8), np.uint8)
        eight = np.ndarray((len(x),), "<u8", eight, 0, (1,))[begin[short]]
        eight &= np.take(MASKS, np.minimum((end - begin)[short] + 1, 8))
        values[short] = self.short.of(eight, lambda at: self.found([words[i] for i in short[at].tolist()]))
        if len(long):
            before = len(self.long)
            number = np.fromiter(map(self.long.__getitem__, [words[i] for i in long.tolist()]), np.intp, len(long))
            new = list(islice(reversed(self.long), len(self.long) - before))[::-1]
            if new:
                self.long_values = np.concatenate([self.long_values, self.found(new)])
                self.long_size += sum(map(len, new)) + 180 * len(new)
            values[long] = np.take(self.long_values, number, axis=0)
        return cost + values[:, 0], values[:, 1]


def codes_of(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """A byte per slot: quantised logit and level of experience."""
    n = zeros + ones
    p = (ones + 0.4) / (n + 0.8)
    logit = np.clip(np.log(p / (1 - p)), -LIMIT, LIMIT)
    level = np.round((logit + LIMIT) / (2 * LIMIT) * (LEVELS - 1)).astype(np.uint8)
    seen = (n > 0).astype(np.uint8) + (n > 3) + (n > 31)
    return (level * 4 + seen).astype(np.uint8)


def logits() -> np.ndarray:
    return (np.repeat(np.arange(LEVELS), 4) / (LEVELS - 1) * 2 * LIMIT - LIMIT).astype(np.float32)


def gates(codes: list[np.ndarray]) -> np.ndarray:
    return ((codes[0] & 3) << 4 | (codes[1] & 3) << 2 | codes[2] & 3).astype(np.intp)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def places(depth: np.ndarray, mixed: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Numbers of (depth, quantum of the mixed logit, bit)."""
    x = np.clip(mixed, -QLIMIT, QLIMIT - 1e-3)
    x += np.float32(QLIMIT)
    x *= np.float32(QUANTA / (2 * QLIMIT))
    place = x.astype(np.int32).astype(np.intp)
    place += np.take(np.arange(DEPTHS) * QUANTA, depth)
    place <<= 1
    place += bit
    return place


class Mixer:
    """Learns online: weights (gate, predictor and bias), how often each gate was used, and the adaptive map's
    counts (depth, quantum) of decisions and of ones."""

    def __init__(self):
        self.weights = np.zeros((64, 4), np.float64)
        self.weights[:, :3] = 0.4
        self.used = np.zeros(64, np.int64)
        self.total = np.zeros(DEPTHS * QUANTA, np.int64)
        self.ones = np.zeros(DEPTHS * QUANTA, np.int64)
        self.value, self.steps = logits() * ((np.arange(256) & 3) > 0), 0

    def learn(self, depth: np.ndarray, bit: np.ndarray, codes: list[np.ndarray], batch: int = 4096) -> None:
        gate, target = gates(codes), bit.astype(np.float32)
        values = [np.take(self.value, c) for c in codes]
        all_mixed = np.empty(len(bit), np.float32)
        for at in range(0, len(bit), batch):
            s = slice(at, at + batch)
            g, xs = gate[s], [v[s] for v in values]
            w = self.weights.T.astype(np.float32, order="C")
            mixed = np.take(w[3] * np.float32(0.3), g, out=all_mixed[s], mode="clip")
            for row, x in zip(w, xs):
                term = np.take(row, g, mode="clip")
                term *= x
                mixed += term
            # target - 1 / (1 + exp(-mixed))
            error = np.negative(mixed)
            np.exp(error, out=error)
            error += 1
            np.divide(1, error, out=error)
            error = np.subtract(target[s], error, out=error).astype(np.float64)
            seen = np.bincount(g, minlength=64)
            change = np.stack([*(np.bincount(g, weights=error * x, minlength=64) for x in xs), 0.3 * np.bincount(g, weights=error, minlength=64)], axis=1)
            self.weights += 0.02 / math.sqrt(1 + self.steps / 500) * change / np.sqrt(np.maximum(seen, 1))[:, None]
            self.used += seen
            self.steps += 1
        # the map's counts of all batches at once
        both = np.bincount(places(depth, all_mixed, bit), minlength=2 * len(self.total)).reshape(-1, 2)
        self.total += both.sum(axis=1)
        self.ones += both[:, 1]

    def streams(self, streams: list[bytes], coder: Coder, tables: list[np.ndarray]) -> None:
        long: list[bytes] = []
        for b in batches_of(short_of(iter(streams), long)):
            depth, slots, bit, _ = coder.decisions(b)
            self.learn(depth, bit, [looked_up(t, s) for t, s in zip(tables, slots)])
        for piece, context in (p for s in long for p in pieces_of(s)):
            depth, slots, bit, _ = coder.decisions([piece])
            skip = coder.skipped(piece[:context])
            self.learn(depth[skip:], bit[skip:], [looked_up(t, s[skip:]) for t, s in zip(tables, slots)])


def mixer_of(weights: np.ndarray, total: np.ndarray, ones: np.ndarray) -> dict:
    """Look-ups of the weighted logits (gate, code), and the refined cost of a decision (depth, quantum, bit)."""
    value = logits()
    center = squash((np.arange(QUANTA) + 0.5) / QUANTA * 2 * QLIMIT - QLIMIT)
    prior = np.tile(center, DEPTHS)
    p = np.clip((ones + 16 * prior) / (total + 16), 1e-5, 1 - 1e-5)
    cost = np.stack([np.log10(1 - p), np.log10(p)], axis=1).ravel().astype(np.float32)
    lut = np.stack([weights[:, i:i + 1] * (value * ((np.arange(256) & 3) > 0))[None, :] for i in range(3)])
    return {"lut": lut.astype(np.float32).reshape(3, -1), "bias": (0.3 * weights[:, 3]).astype(np.float32), "cost": cost}


def learn_mixer(streams: list[bytes], coder: Coder, tables: list[np.ndarray], rounds: int = 3) -> dict:
    """The mixer learned in one place, in rounds; the map is that of the last one."""
    mixer = Mixer()
    for _ in range(rounds):
        mixer.total[:], mixer.ones[:] = 0, 0
        mixer.streams(streams, coder, tables)
    return mixer_of(mixer.weights, mixer.total, mixer.ones)


def decision_costs(streams: list[bytes], coder: Coder, tables: list[np.ndarray], mixer: dict) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of each decision, and where each stream starts."""
    depth, slots, bit, starts = coder.decisions(streams)
    return costs_of(depth, [looked_up(t, s) for t, s in zip(tables, slots)], bit, mixer), starts


def costs_of(depth: np.ndarray, codes: list[np.ndarray], bit: np.ndarray, mixer: dict) -> np.ndarray:
    gate = gates(codes)
    mixed = np.take(mixer["bias"], gate)
    row = gate << 8
    for lut, c in zip(mixer["lut"], codes):
        mixed += looked_up(lut, row + c)
    return looked_up(mixer["cost"], places(depth, mixed, bit))


def log10_probabilities(streams: list[bytes], coder: Coder, tables: list[np.ndarray], mixer: dict) -> list[float]:
    out = [0.0] * len(streams)
    short = [i for i, s in enumerate(streams) if len(s) <= 2 * CHUNK]
    at = 0
    for batch in batches_of(streams[i] for i in short):
        cost, starts = decision_costs(batch, coder, tables, mixer)
        for i, v in zip(short[at:at + len(batch)], np.add.reduceat(cost.astype(np.float64), starts)):
            out[i] = float(v)
        at += len(batch)
    for i, s in enumerate(streams):
        if len(s) > 2 * CHUNK:
            for piece, context in pieces_of(s):
                cost, _ = decision_costs([piece], coder, tables, mixer)
                skip = coder.skipped(piece[:context])
                out[i] += float(cost[skip:].sum(dtype=np.float64))
    return out


def text_scores(texts: list[list[bytes]], parts: Parts) -> Iterator[tuple]:
    """Of each text, as words: bytes of its stream, tokens, known ones, the sum of their logs, log10 probability,
    the unknown words and how often each occurs."""
    streams, long = list(map(stream_of, texts)), []
    scores = {}
    at = 0
    short = [i for i, s in enumerate(streams) if len(s) <= 2 * CHUNK]
    for batch in batches_of(short_of(iter(streams), long), GROUP):
        own, at = short[at:at + len(batch)], at + len(batch)
        words = [w for i in own for w in (*texts[i], b"\n")]
        cost, logs = parts.of(batch, words)
        ends = np.cumsum([len(texts[i]) + 1 for i in own])
        starts = np.concatenate([[0], ends[:-1]])
        rare = np.flatnonzero(np.isnan(logs))
        logs[rare] = 0
        cuts = np.searchsorted(rare, np.concatenate([starts, ends[-1:]])).tolist()
        for k, (i, c, v) in enumerate(zip(own, np.add.reduceat(cost, starts).tolist(), np.add.reduceat(logs, starts).tolist())):
            scores[i] = c, v, Counter([words[j] for j in rare[cuts[k]:cuts[k + 1]].tolist()])
    for i, c in zip((i for i, s in enumerate(streams) if len(s) > 2 * CHUNK), log10_probabilities(long, parts.coder, parts.tables, parts.mixer)):
        found = [(w, parts.known(w, math.nan)) for w in (*texts[i], b"\n")]
        scores[i] = c, sum(v for _, v in found if v == v), Counter(w for w, v in found if v != v)
    for i, (words, stream) in enumerate(zip(texts, streams)):
        cost, logs, rare = scores[i]
        yield len(stream), len(words) + 1, len(words) + 1 - rare.total(), logs, cost, list(rare), list(rare.values())


def remainder(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text (null: of nothing) modulo ``folds``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def pair_counts(rows: DataFrame) -> np.ndarray:
    """How often each (byte before, byte) occurs in the streams of rows (text), or of texts given by rows (word, c)
    of their counted words and ends: at most 65,536 sums."""
    counted = "c" in rows.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            if counted:
                words, times = [w.encode() for w in batch.column(0).to_pylist()], batch.column(1).to_numpy()
                # a word has the pairs from the space before it to the space after it, an end only the first
                x = np.frombuffer(b" " + b" ".join([*words, b""]), np.uint8).astype(np.intp)
                pairs = x[:-1] << 8 | x[1:]
                each = np.repeat(times, np.fromiter(map(len, words), np.intp, len(words)) + 1)
                np.add.at(total, pairs, each)
                total[STOP << 8 | SPACE] = 0
                continue
            for t in batch.column(0).to_pylist():
                total += pairs_of(b" " + stream_of(split_words(t))) if len(t) > CHUNK else 0
            short = [stream_of(split_words(t)) for t in batch.column(0).to_pylist() if len(t) <= CHUNK]
            for some in batches_of(iter(short)):
                total += pairs_of(b" " + b" ".join(some))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["pair", "n"])

    out = np.zeros(1 << 16, np.int64)
    for r in rows.mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out


def mixed_in_tasks(spark: SparkSession, train: DataFrame, tree: dict, folds: list[list[np.ndarray]], size: int) -> Mixer:
    """The mixer from rows (text, fold, place), each learned from with the tables of the other fold.  A task learns online over
    a shard, in order of ``place``, a hash of id and text; the number of shards follows from the ``size`` of the texts alone. So what is
    learned does not depend on how the rows lie.  Gates' weights (times their use) and the map's counts are summed in
    a shuffle to fixed numbers of rows."""
    model = spark.sparkContext.broadcast((tree, folds))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, folds = model.value
        coder, mixer = Coder(tree), Mixer()
        for batch in batches:
            for at in range(0, len(batch), 400):
                part = batch.slice(at, 400)
                streams: list[list[bytes]] = [[], []]
                for t, f in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    streams[f].append(stream_of(split_words(t)))
                for f in (0, 1):
                    mixer.streams(streams[f], coder, folds[1 - f])
        at, used = np.flatnonzero(mixer.total), np.flatnonzero(mixer.used)
        sums = mixer.weights[used] * mixer.used[used, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([used, 64 + at]), pa.int32()), pa.array(np.concatenate([mixer.used[used], mixer.total[at]]), pa.int64()),
             *(pa.array(np.concatenate([sums[:, i], mixer.ones[at] if i == 0 else np.zeros(len(at))]), pa.float64()) for i in range(4))],
            ["place", "n", *names])

    names = ["w0", "w1", "w2", "w3"]
    shards = max(1, min(MOST_SHARDS, -(-size // SHARD_BYTES)))
    ordered = train.repartition(shards, "place").sortWithinPartitions("place", "text").select("text", "fold")
    sums = ordered.mapInArrow(learn, "place int, n long, w0 double, w1 double, w2 double, w3 double")
    mixer = Mixer()
    for r in sums.groupBy("place").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).collect():  # 64 and 6,144 rows at most
        if r["place"] < 64:
            mixer.weights[r["place"]] = [r[c] / r["n"] for c in names]
        else:
            mixer.total[r["place"] - 64], mixer.ones[r["place"] - 64] = r["n"], r["w0"]
    model.unpersist()
    return mixer


ROWS = "word string, c long, slice int, salt int, data binary"


def packed(tables: list[np.ndarray], salt: int) -> Iterator[pd.DataFrame]:
    """The slices of the tables that hold anything, as rows."""
    codec, first = pa.Codec("zstd"), 0
    for t in tables:
        pairs = t.reshape(-1, 2 * SLICE)
        for i, p in enumerate(pairs):
            if p.any():
                yield pd.DataFrame({"word": [None], "c": [None], "slice": [first + i], "salt": [salt],
                                    "data": [codec.compress(p.astype(np.uint64).tobytes(), asbytes=True)]})
        first += len(pairs)


def counted(texts: DataFrame) -> DataFrame:
    """Rows (word, c0, c1) and rows (fold, data) of heads and their counts from rows (text, fold); partial counts, to be added up."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, seen = [Heads(), Heads()], [Counter(), Counter()]
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                streams: list[list[bytes]] = [[], []]
                for t, f in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = split_words(t)
                    seen[f].update(words)
                    streams[f].append(stream_of(words))
                for f in (0, 1):
                    seen[f][b"\n"] += len(streams[f])
                    heads[f].add(iter(streams[f]))
                    if len(heads[f].keys) > MOST_HEADS:
                        yield blob(f, heads[f])
                        heads[f] = Heads()
                if sum(map(len, seen)) > MOST_WORDS:
                    yield rows(*seen)
                    seen = [Counter(), Counter()]
        yield rows(*seen)
        for f in (0, 1):
            yield blob(f, heads[f])

    def blob(fold: int, heads: Heads) -> pa.RecordBatch:
        data = pa.Codec("zstd").compress(np.concatenate(heads.counted()).tobytes(), asbytes=True)
        return pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in schema.types[:3]), pa.array([fold], pa.int32()),
                                           pa.array([len(heads.keys)], pa.int64()), pa.array([data], pa.binary())], schema=schema)

    def rows(one: Counter, two: Counter) -> pa.RecordBatch:
        words = list(one.keys() | two.keys())
        n = len(words)
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()).cast(pa.string()), *(pa.array([s[w] for w in words], pa.int64()) for s in (one, two)),
             *(pa.nulls(n, t) for t in schema.types[3:])], schema=schema)

    schema = pa.schema([("word", pa.string()), ("c0", pa.int64()), ("c1", pa.int64()), ("fold", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
    return texts.mapInArrow(count, "word string, c0 long, c1 long, fold int, n long, data binary")


def head_tables(heads: DataFrame, tree: dict) -> DataFrame:
    """Slices of tables with their fold from rows (fold, n, data) of counted heads."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        codec, coder = pa.Codec("zstd"), Coder(tree)
        counts = [Counts(coder, np.uint64), Counts(coder, np.uint64)]
        for f in frames:
            for fold, n, data in zip(f["fold"], f["n"], f["data"]):
                both = np.frombuffer(codec.decompress(data, 16 * n, asbytes=True), np.int64) if n else np.zeros(0, np.int64)
                counts[fold].counted_heads(both[:n], both[n:])
        for fold in (0, 1):
            for f in packed(counts[fold].tables, TaskContext.get().partitionId() % 64):
                yield f.assign(fold=fold)[["fold", "slice", "salt", "data"]]

    return heads.mapInPandas(count, "fold int, slice int, salt int, data binary")


def word_tables(words: DataFrame, tree: dict, tables: tuple[int, ...] = (2,)) -> DataFrame:
    """Slices of the word-so-far table (or of those given) from rows (word, c)."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        counts = Counts(Coder(tree), np.uint64)  # counts of a whole corpus
        for f in frames:
            counts.words(f["word"].tolist(), f["c"].to_numpy(), tables)
        yield from packed(counts.tables, TaskContext.get().partitionId() % 64)

    return words.mapInPandas(count, ROWS)


def summed_tables(spark: SparkSession, slices: DataFrame) -> list[list[np.ndarray]]:
    """The tables of fold 0, of fold 1 and of both as one byte per slot, from rows (fold, slice, salt, data)."""
    def added(frames: Iterator[pd.DataFrame], last: bool) -> Iterator[pd.DataFrame]:
        codec, sums = pa.Codec("zstd"), {}
        for f in frames:
            for fold, k, salt, data in zip(f["fold"], f["slice"], f["salt"], f["data"]):
                p = np.frombuffer(codec.decompress(data, 16 * SLICE, asbytes=True), np.uint64)
                for key in [(fold, k, 0), (2, k, 0)] if last else [(fold, k, salt)]:
                    if key in sums:
                        sums[key] += p
                    else:
                        sums[key] = p.copy()
        for (fold, k, salt), p in sums.items():
            if last:
                data = codes_of(p[::2].astype(float), p[1::2].astype(float)).tobytes()
            else:
                data = codec.compress(p.tobytes(), asbytes=True)
            yield pd.DataFrame({"fold": [fold], "slice": [k], "salt": [salt], "data": [data]})

    kind = "fold int, slice int, salt int, data binary"
    most = sum((1 << b) // SLICE for b in TABLE_BITS)
    some = slices.repartition(most, "fold", "slice", "salt").mapInPandas(lambda f: added(f, False), kind)
    done = some.repartition(most, "slice").mapInPandas(lambda f: added(f, True), kind)
    got = {(r["fold"], r["slice"]): r["data"] for r in written(spark, done, "tables").collect()}  # 3 x 5.5 MB, whatever the corpus
    blank = codes_of(np.zeros(1), np.zeros(1)).tobytes() * SLICE
    out = []
    for fold in range(3):
        first, tables = 0, []
        for bits in TABLE_BITS:
            n = (1 << bits) // SLICE
            tables.append(np.frombuffer(b"".join(bytes(got.get((fold, first + i), blank)) for i in range(n)), np.uint8))
            first += n
        out.append(tables)
    return out


def score(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 5, held: int = 1,
          head_words: int = 400_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_bytes (of the stream), n_tokens, n_known,
    train_tokens, base_score, score, bits_per_byte.

    Null and empty texts are one end token; a null id counts as empty text in the
    split; rows pass one to one, repeated ones too (and each counts in training); an empty table gives
    an empty one; other columns are not looked at."""
    rest = remainder(F.col(doc_id), folds)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), rest.alias("rest"))
    train = rows.where(F.col("rest") != held).select("text", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("fold"),
                                                     F.xxhash64("doc_id", "text").alias("place"))
    parts = written(spark, counted(train.select("text", "fold")), "counts")
    words = written(spark, parts.where("word is not null").groupBy("word").agg(
        F.sum(F.col("c0") + F.col("c1")).alias("c"), F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "words")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    pairs = pair_counts(words.select("word", "c"))
    tree = trees_of(pairs)
    slices = head_tables(parts.where("data is not null").select("fold", "n", "data"), tree)
    for f in (0, 1):
        slices = slices.unionByName(word_tables(words.where(f"c{f} > 0").select("word", F.col(f"c{f}").alias("c")), tree, (0, 1, 2)).select(
            F.lit(f).alias("fold"), "slice", "salt", "data"))
    *halves, tables = summed_tables(spark, slices)
    learned = mixed_in_tasks(spark, train, tree, halves, int(pairs.sum()))
    mixer = mixer_of(learned.weights, learned.total, learned.ones)
    # the most frequent words by a bound on their count, found from a histogram of counts (some thousand
    # bins at most), never by sorting all words in one place
    level = F.floor(F.log2("c") * 64)
    head, least = 0, math.inf
    for r in sorted(words.groupBy(level.alias("b")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["b"]):
        head += r["n"]
        if head > head_words:
            break
        least = r["b"]
    tail = words.where(level < F.lit(float(least))).select("word", "c")
    top = written(spark, words.where(level >= F.lit(float(least))).select("word", "c").repartition(8), "head")
    logs = {r["word"].encode(): math.log10(r["c"] + 0.5) for r in top.toLocalIterator()}
    model = spark.sparkContext.broadcast((tree, tables, mixer, logs, []))
    del logs

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, tables, mixer, logs, kept = model.value
        if not kept:  # what a worker remembers from one task to the next
            kept.append(Parts(Coder(tree), tables, mixer, logs.get))
        parts = kept[0]
        for batch in batches:
            for at in range(0, len(batch), 400):
                part = batch.slice(at, 400)
                columns = list(zip(*text_scores(list(map(split_words, part.column("text").to_pylist())), parts)))
                new = [pa.array(c, t) for c, t in zip(columns[:5], (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
                rare = [pa.array(columns[5], pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array(columns[6], pa.list_(pa.int64()))]
                kept = [part.column(c) for c in ("doc_id", "held_out", "__h1", "__h2")]
                yield pa.RecordBatch.from_arrays([*kept, *new, *rare], names)

    names = ["doc_id", "held_out", "__h1", "__h2", "n_bytes", "n_tokens", "n_known", "known", "score", "rare", "times"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    all_rows = rows.select("doc_id", (F.col("rest") == held).alias("held_out"), F.xxhash64("text").alias("__h1"),
                           F.xxhash64(F.lit("linedocs"), "text").alias("__h2"), "text").mapInArrow(
        scored, f"doc_id {kind}, held_out boolean, __h1 long, __h2 long, n_bytes long, n_tokens long, n_known long, known double, "
                "score double, rare array<string>, times array<long>")
    all_rows = written(spark, all_rows, "scored")
    base = F.lit(math.log10(n + 0.5 * (v + 1)))
    unseen = math.log10(0.5)
    # rare words by document text (equal texts have equal words)
    once = all_rows.select("__h1", "__h2", "rare", "times").dropDuplicates(["__h1", "__h2"])
    rare = once.select("__h1", "__h2", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("f"))))
    met = rare.join(tail, "word")
    seen = met.groupBy("__h1", "__h2").agg(F.sum("f").alias("f"), F.sum(F.col("f") * F.log10(F.col("c") + 0.5)).alias("logs"))
    joined = all_rows.select("doc_id", "held_out", "__h1", "__h2", "n_bytes", "n_tokens", "n_known", "known", "score").join(
        seen, ["__h1", "__h2"], "left")
    f = F.coalesce("f", F.lit(0))
    missing = F.col("n_tokens") - F.col("n_known") - f
    logs = F.col("known") + F.coalesce("logs", F.lit(0.0)) + missing * F.lit(unseen)
    return joined.select("doc_id", "held_out", "n_bytes", "n_tokens", (F.col("n_known") + f).alias("n_known"),
                         F.lit(int(n)).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * base).alias("base_score"),
                         "score", (-F.col("score") * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))
