"""Language-model scores by logistic context mixing over the decisions of words.

Every token of every text is predicted, from the words before it. A training word used more than once has a binary path: a
Huffman code of how often words are used, by powers of two, then its number among the words used as often. All other words
share the path of the escape. For each decision on a path, predictors give counts: the decision alone, the decision after
the word before, after the two words before, and in the group (language, say) that the text's words so far tell; where the
word before stood earlier in its text, the word that followed it there says which way its own path goes. Their logits are
combined with weights that two gates select, learned online from all training texts, and an adaptive map refines the
outcome. Training texts fall in two halves by their words; weights are learned on each half with the counts of the other,
so no text is predicted from itself, and scores use the counts of both.

Behind the escape a word is either the one that followed earlier, with a learned chance, or it is spelled byte by byte with
a closing space, every byte in eight decisions (the end of a text is the empty spelling). These are mixed alike from hashed
contexts (the last 1, 2, 3, 4 and 6 bytes of the word with the bits already known), learned from all distinct training
words. A spelling depends on its word only: each distinct word is spelled once, and texts gather words by position. The
chances of all texts add up to at most one, as a word with a path of its own can also be spelled.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from panelforge.llm import word_blocks
from panelforge.llm.common import mapped, stored, write_whole
from panelforge.session import scratch_path

#: Bytes of context and bits of the table of each predictor; tables are as large whatever the corpus.
ORDERS = {1: 18, 2: 20, 3: 22, 4: 22, 6: 22}
PRIOR = 0.3  # added to both counts
TYPES_PER_TASK = 1 << 18
#: Groups of training texts.
GROUPS = 8
GATES_SEEN, GATES_PLACE = 3 * (len(ORDERS) + 1), 32
INPUTS = len(ORDERS) + 1  # with a constant
STEPS = 33  # of the refining map, over logits from −8 to 8
RATE = 0.05
#: Numbers of matches in a row that are told apart; the last stands for more.
MATCH = range(8)
#: Predictors of a word's decisions and the bits of their tables: by nothing else, by the word before, by the two before, by
#: the group the text seems to be of. The last is the match's, by matches in a row and place on the path.
WORD_ORDERS = {0: 20, 1: 22, 2: 22, 3: 20}
MATCHED, MATCHED_BITS = 4, 8
#: Powers of two of a word's count, and the longest path.
LEVELS, LONGEST = 48, 52
#: Table entries as read: a logit in steps, and in the lowest bits how sure it is, by its number of counts.
LOGIT, SURE = np.float32(24 / 2046), 3
#: Words whose decisions are learned or scored together, positions held at a time (a longer text alone), and counted by one task.
STRETCH, HELD, COUNTED = 1 << 15, 1 << 18, 1 << 25
#: Parts of a table that are summed by tasks of their own.
REGIONS = 16
#: Words whose decisions are dealt to batches together.
LEARN_WORDS = 4096
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_NODE = np.uint64(0xC2B2AE3D27D4EB4F)
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix of bytes with a closing space) of words of equal length, few enough that the tables' lines they touch stay in the cache."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    edges = np.r_[0, np.flatnonzero(np.diff(sizes[order])) + 1, len(words)]
    for lo, hi in zip(edges[:-1], edges[1:]):
        step = max(1, (1 << 13) // (int(sizes[order[lo]]) + 1))
        for at in range(lo, hi, step):
            rows = order[at : min(hi, at + step)]
            data = b"".join([words[i] + b" " for i in rows])
            yield rows, np.frombuffer(data, np.uint8).reshape(len(rows), -1)


def contexts(matrix: np.ndarray) -> dict[int, np.ndarray]:
    """The last k bytes before every byte, as one number; before the word there are spaces."""
    padded = np.full((matrix.shape[0], matrix.shape[1] + 6), 32, np.uint64)
    padded[:, 6:] = matrix
    out, whole = {}, np.zeros(matrix.shape, np.uint64)
    for k in range(1, 7):
        whole = whole << np.uint64(8) | padded[:, 6 - k : 6 - k + matrix.shape[1]]
        if k in ORDERS:
            out[k] = whole * _MULTIPLY
    return out


def decisions(matrix: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(bit number, bit, half, node) of every byte: half tells the upper four bits and, once known, which they were; the
    node is the bits known within the half, with a leading one."""
    for half in (0, 1):
        nibble = matrix >> 4 if half == 0 else matrix & 15
        salt = np.zeros(matrix.shape, np.uint64) if half == 0 else (matrix >> 4).astype(np.uint64) + np.uint64(1)
        node = np.ones(matrix.shape, np.int64)
        for i in range(4):
            bit = (nibble >> (3 - i)) & 1
            yield 4 * half + i, bit, salt, node
            node = node << 1 | bit


def lines(context: np.ndarray, salt: np.ndarray, bits: int) -> np.ndarray:
    """First slot of a half: its four decisions lie side by side in a predictor's table."""
    return ((context + salt * _NODE) * _MULTIPLY >> np.uint64(64 - bits + 4)).astype(np.int64) << 4


def count_order(words: list[bytes], order: int, table: np.ndarray) -> None:
    """Add every decision of the words to a predictor's table (slots × 2, flat)."""
    for _, matrix in by_length(words):
        context = contexts(matrix)[order]
        for i, bit, salt, node in decisions(matrix):
            if i % 4 == 0:
                line = lines(context, salt, ORDERS[order])
            np.add.at(table, ((line | node) * 2 + bit).ravel(), np.uint32(1))


def place_gates(shape: tuple[int, int], bit: int) -> np.ndarray:
    at = np.minimum(np.arange(shape[1]), 3)
    return np.broadcast_to(at * 8 + bit, shape)


def all_inputs(tables: dict[int, np.ndarray], matrix: np.ndarray, leave_out: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(bit number, bit, *``inputs``) of every byte; a half's lines are found once for its four decisions."""
    context = contexts(matrix)
    for i, bit, salt, node in decisions(matrix):
        if i % 4 == 0:
            at = {order: lines(context[order], salt, bits) for order, bits in ORDERS.items()}
        yield i, bit, *inputs(tables, context, bit, salt, node, leave_out, at)


def inputs(tables: dict[int, np.ndarray], context: dict[int, np.ndarray], bit: np.ndarray, salt: np.ndarray, node: np.ndarray, leave_out: int, at: dict[int, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(logits of the predictors, gate by how many and how well the contexts are known).

    ``leave_out`` 1 takes the word's own occurrence off the counts: it is predicted from the others, as online learning
    predicts before it updates. ``at`` holds the ``lines`` of the half, where they are known.
    """
    x = np.empty((INPUTS, bit.size), np.float32)
    gate, sure = np.zeros(bit.size, np.int8), np.zeros(bit.size, np.int8)
    own = bit.ravel().astype(np.float32)
    for i, (order, bits) in enumerate(ORDERS.items()):
        line = lines(context[order], salt, bits) if at is None else at[order]
        counts = tables[order].view("<u8").take((line | node).ravel()).view("<u4").reshape(-1, 2)  # both counts of a slot in one read
        zeros, ones = counts[:, 0].astype(np.float32), counts[:, 1].astype(np.float32)
        if leave_out:
            ones -= own
            zeros -= 1 - own
        total = zeros + ones
        np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)), out=x[i])
        known = total > 0
        gate += known
        np.copyto(sure, (total > 3).view(np.int8) + (total > 30).view(np.int8), where=known)
    x[-1] = 0.3
    return x, (gate * 3 + sure).astype(np.int64)


def squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


class Mixer:
    """Weights by two gates, added, and the counts of the refining map."""

    INPUTS, SEEN, PLACE = INPUTS, GATES_SEEN, GATES_PLACE

    def __init__(self, state: np.ndarray | None = None):
        a, b = self.SEEN * self.INPUTS, self.weights()
        if state is None:
            state = np.zeros(b + self.SEEN * STEPS * 2)
            state[:a] = 0.3
        self.state = state
        self.seen, self.place = state[:a].reshape(self.SEEN, self.INPUTS), state[a:b].reshape(self.PLACE, self.INPUTS)
        self.map = state[b:].reshape(self.SEEN, STEPS, 2)
        self.past = np.zeros_like(self.seen), np.zeros_like(self.place)

    @classmethod
    def weights(cls) -> int:
        """How many numbers of the state are weights; they come first."""
        return (cls.SEEN + cls.PLACE) * cls.INPUTS

    def gate(self, seen: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Both gates in one number."""
        return (seen * self.PLACE + place).astype(np.int64, copy=False)

    def both(self) -> np.ndarray:
        """Weights of both gates added, a row per input."""
        seen, place = np.ascontiguousarray(self.seen.T, np.float32), np.ascontiguousarray(self.place.T, np.float32)
        return (seen[:, :, None] + place[:, None, :]).reshape(self.INPUTS, -1)

    @staticmethod
    def logit(x: np.ndarray, gate: np.ndarray, both: np.ndarray) -> np.ndarray:
        z = np.zeros(x.shape[1], np.float32)
        for row, weights in zip(x, both):
            z += row * weights.take(gate)
        return z.clip(-12, 12, out=z)

    @staticmethod
    def step(z: np.ndarray) -> np.ndarray:
        at = (z + np.float32(8)) * np.float32((STEPS - 1) / 16)
        return np.rint(at, out=at).clip(0, STEPS - 1, out=at).astype(np.int64)

    def learn(self, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, batch: int = 4096) -> None:
        """Predict a batch, then move the weights that its gates select against their mean error, in steps that shrink
        with the errors so far; then count the outcome in the map. A batch takes every so many-th of the decisions."""
        parts = max(1, len(gate) // batch)
        whole = len(gate) // parts * parts
        dealt = lambda c: np.ascontiguousarray(c[..., :whole].reshape(*c.shape[:-1], -1, parts).swapaxes(-1, -2))
        some_x, some_gate, some_bit = dealt(x), dealt(gate), dealt(bit.astype(np.float32))
        for i in range(parts):
            self._learn(some_x[:, i], some_gate[i], some_bit[i])
        if whole < len(gate):
            self._learn(x[:, whole:], gate[whole:], bit[whole:].astype(np.float32))

    def _learn(self, x: np.ndarray, gate: np.ndarray, bit: np.ndarray) -> None:
        shape = (self.SEEN, self.PLACE)
        z = self.logit(x, gate, self.both())
        error = bit - squash(z)
        number = np.bincount(gate, minlength=self.SEEN * self.PLACE).reshape(shape)
        total = [np.bincount(gate, row * error, minlength=self.SEEN * self.PLACE).reshape(shape) for row in x]
        for axis, weights, past in ((1, self.seen, self.past[0]), (0, self.place, self.past[1])):
            mean = np.stack([t.sum(axis=axis) for t in total], axis=1) / np.maximum(number.sum(axis=axis), 64)[:, None]  # rare gates move little
            past += mean * mean
            weights += RATE * mean / np.sqrt(past + 1e-6)
        self.map += np.bincount((gate // self.PLACE * STEPS + self.step(z)) * 2 + (bit > 0), minlength=self.map.size).reshape(self.map.shape)

    def refiner(self, kind: type = np.float64) -> tuple[np.ndarray, np.ndarray]:
        """(offset, factor) by cell of the map: halfway between the mixed and the refined estimate."""
        n = self.map.reshape(-1, 2)
        number = n.sum(axis=1) + 2
        return (n[:, 1] / number / 2).astype(kind), (0.5 + 1 / number).astype(kind)

    def probability(self, x: np.ndarray, seen: np.ndarray, place: np.ndarray, prepared: tuple | None = None) -> np.ndarray:
        """Of a one. ``prepared`` holds ``both()`` and ``refiner()`` where many are asked."""
        both, (offset, factor) = prepared or (self.both(), self.refiner())
        z = self.logit(x, self.gate(seen, place), both)
        cell = seen * STEPS + self.step(z)
        return (offset.take(cell) + factor.take(cell) * squash(z.astype(factor.dtype))).clip(1e-6, 1 - 1e-6)


def learn_words(words: list[bytes], tables: dict[int, np.ndarray], mixer: Mixer, rng: np.random.Generator) -> int:
    """One online pass over all decisions of the words, taken in random order and dealt to batches; returns their number."""
    done, words = 0, [words[i] for i in rng.permutation(len(words))]
    for lo in range(0, len(words), LEARN_WORDS):
        rows = []
        for _, matrix in by_length(words[lo : lo + LEARN_WORDS]):
            for i, bit, x, seen in all_inputs(tables, matrix, 1):
                rows.append((x, mixer.gate(seen, place_gates(bit.shape, i).ravel()), bit.ravel()))
        x, gate, bit = (np.concatenate(c, axis=-1) for c in zip(*rows))
        mixer.learn(x, gate, bit)
        done += len(bit)
    return done


def spelled(words: list[bytes], tables: dict[int, np.ndarray], mixer: Mixer) -> np.ndarray:
    """log2 probability of each word's spelling."""
    out, prepared = np.zeros(len(words)), (mixer.both(), mixer.refiner())
    for rows, matrix in by_length(words):
        for i, bit, x, seen in all_inputs(tables, matrix, 0):
            p = mixer.probability(x, seen, place_gates(bit.shape, i).ravel(), prepared)
            flat = bit.ravel()
            out[rows] += np.log2(np.where(flat, p, 1 - p)).reshape(bit.shape).sum(axis=1)
    return out


def tables_of(folder: str) -> dict[int, np.ndarray]:
    return {k: np.frombuffer(mapped(f"{folder}/order-{k}"), "<u4") for k in ORDERS}


def tokens(text: str) -> list[bytes]:
    """Words with A-Z lowered, then the end of the text: the empty word."""
    return [*text.encode().lower().split(), b""]


def _splitter():
    return tokens


def _distinct(groups: int):
    def sums(bucket: int, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        at, places, parts = word_blocks.Numbers(), [], []
        for _, _, payload in rows:
            words, numbers = word_blocks.unpacked(payload, 1 + groups)
            places.append(np.fromiter(map(at.__getitem__, words), np.int64, len(words)))
            parts.append(np.stack(numbers[1:]))
        place, part = np.concatenate(places), np.concatenate(parts, axis=1)
        counts = np.stack([np.bincount(place, p, len(at)).astype(np.int64) for p in part])
        words = list(at)
        order = sorted(range(len(words)), key=words.__getitem__)  # paths do not depend on which block came first
        words, counts = [words[i] for i in order], counts[:, order]
        total = counts.sum(axis=0)
        level = levels(total)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([bucket], pa.int32()), "payload": pa.array([word_blocks.packed(words, *counts)], pa.binary()),
            "words": [int((total > 0).sum())], "once": [int((total == 1).sum())], "tokens": [counts.sum(axis=1)],
            "sizes": [np.bincount(level, minlength=LEVELS)], "uses": [np.bincount(level, total, LEVELS).astype(np.int64)],
        })

    return sums


def _trained(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[list[bytes]]:
    """Training words, in stretches that bound memory."""
    held: list[bytes] = []
    for batch in batches:
        for payload in batch.column("payload").to_pylist():
            words, counts = word_blocks.unpacked(payload, groups)
            held += [w for w, c in zip(words, np.sum(counts, axis=0).tolist()) if c]
            if len(held) >= TYPES_PER_TASK:
                yield held
                held = []
    if held:
        yield held


def _stretches(batches: Iterator[pa.RecordBatch], groups: int, words: int = 1 << 16) -> Iterator[list[tuple]]:
    """Buckets with their words and counts, some at a time: spelling many words at once costs less than bucket by bucket."""
    held, number = [], 0
    for batch in batches:
        for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own, counts = word_blocks.unpacked(payload, groups)
            held.append((bucket, own, np.stack(counts)))
            number += len(own)
            if number >= words:
                yield held
                held, number = [], 0
    if held:
        yield held


def _region(order: int, region: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([order], pa.int32()), pa.array([region], pa.int32()), pa.array([payload], pa.binary())], names=["order", "region", "payload"])


def _regions(order: int, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for region, part in enumerate(table.reshape(REGIONS, -1)):
        if part.any():
            yield _region(order, region, zstandard.ZstdCompressor(level=1).compress(part.tobytes()))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for order, region, payload in zip(*(c.to_pylist() for c in batch.columns)):
            part = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint32)
            sums[order, region] = sums[order, region] + part if (order, region) in sums else part.copy()
    for (order, region), part in sums.items():
        yield _region(order, region, zstandard.ZstdCompressor(level=1).compress(part.tobytes()))


def _gathered(batches: Iterator[pa.RecordBatch], slots: dict[int, int]) -> dict[int, np.ndarray]:
    """Whole tables by order, from their regions."""
    tables: dict[int, np.ndarray] = {}
    for batch in batches:
        for order, region, payload in zip(*(c.to_pylist() for c in batch.columns)):
            table = tables.setdefault(order, np.zeros((REGIONS, 2 * slots[order] // REGIONS), "<u4"))
            table[region] = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint32)
    return tables


REGION_SCHEMA = "order int, region int, payload binary"


def _state(mixer: Mixer, decisions: int) -> pa.RecordBatch:
    """A task's mixer as rows: weights times the decisions they were learned from, and the counts of its map."""
    value = mixer.state.copy()
    value[: mixer.weights()] *= decisions
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(value), dtype=np.int32)), pa.array(value), pa.array(np.full(len(value), float(decisions)))], names=["i", "value", "weight"])


def averaged(learned: DataFrame, mixer: Mixer) -> np.ndarray:
    """State of one mixer from those of the tasks: weights averaged by decisions, maps added up."""
    state = mixer.state
    for r in learned.groupBy("i").agg(F.sum("value").alias("value"), F.sum("weight").alias("weight")).collect():  # as many rows as the mixer has numbers
        state[r["i"]] = r["value"] / r["weight"] if r["i"] < mixer.weights() else r["value"]
    return state


STATE_SCHEMA = "i int, value double, weight double"


def train(distinct: DataFrame, types: int, groups: int) -> tuple[str, np.ndarray]:
    """(folder of the predictors' tables, state of the mixer) from all distinct training words.

    Tasks count their words; the tables are summed by regions and put together, one fixed-size file per order. Then tasks
    learn weights online, each over all its words, and the weights are averaged by decisions.
    """
    spark = distinct.sparkSession
    folder = scratch_path(spark, "lm")
    parts = max(1, -(-types // TYPES_PER_TASK))
    dealt = distinct.select("bucket", "payload").repartition(parts, "bucket")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _trained(batches, groups):
            for order, bits in ORDERS.items():
                table = np.zeros(2 << bits, np.uint32)
                count_order(words, order, table)
                yield from _regions(order, table)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for order, table in _gathered(batches, {k: 1 << bits for k, bits in ORDERS.items()}).items():
            write_whole(f"{folder}/order-{order}", [table.tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array([order], pa.int32())], names=["order"])

    summed = dealt.mapInArrow(count, REGION_SCHEMA).repartition(len(ORDERS) * REGIONS, "order", "region").mapInArrow(_added, REGION_SCHEMA)
    counted = summed.repartition(len(ORDERS), "order").mapInArrow(write, "order int")
    have = {r["order"] for r in counted.collect()}  # one row per order
    for order in ORDERS.keys() - have:
        write_whole(f"{folder}/order-{order}", [bytes(8 << ORDERS[order])])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of(folder)
        for words in _trained(batches, groups):
            mixer = Mixer()
            rng = np.random.default_rng(1)
            yield _state(mixer, learn_words(words, tables, mixer, rng))

    return folder, averaged(dealt.mapInArrow(learn, STATE_SCHEMA), Mixer())


def levels(count: np.ndarray) -> np.ndarray:
    """Power of two of every count; 0 for words used once or never, which have no path of their own."""
    return np.maximum(np.frexp(count.astype(np.float64))[1] - 1, 0)


class Paths:
    """Paths of words, as numbers with a leading one before the decisions."""

    def __init__(self, sizes: dict[int, np.ndarray], uses: np.ndarray, once: int):
        """``sizes`` and ``uses``: words by bucket and level, tokens by level; ``once``: words used once."""
        self.first, total = {}, np.zeros(LEVELS, np.int64)
        for bucket in sorted(sizes):
            self.first[bucket] = total
            total = total + sizes[bucket]
        self.width = {int(k): int(total[k] - 1).bit_length() for k in np.flatnonzero(total) if k > 0}
        heap = [(int(uses[k]), k, [k]) for k in self.width] + [(max(once, 1), 0, [0])]
        self.head = dict.fromkeys([0, *self.width], 0)
        size = dict.fromkeys(self.head, 0)
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, i, low), (b, j, high) = heapq.heappop(heap), heapq.heappop(heap)
            for bit, members in ((0, low), (1, high)):
                for k in members:
                    self.head[k] |= bit << size[k]
                    size[k] += 1
            heapq.heappush(heap, (a + b, min(i, j), low + high))
        self.head = {k: head | 1 << size[k] for k, head in self.head.items()}
        if max(size[k] + self.width.get(k, 0) for k in size) > LONGEST:
            raise ValueError("a word's path has too many decisions")

    def of(self, bucket: int, count: np.ndarray) -> np.ndarray:
        """Paths of a bucket's words in their order."""
        level = levels(count)
        out = np.full(len(count), self.head[0], np.int64)
        for k in np.unique(level[level > 0]).tolist():
            at = np.flatnonzero(level == k)
            out[at] = (self.head[k] << self.width[k]) + self.first[bucket][k] + np.arange(len(at))
        return out


def sizes_of(path: np.ndarray) -> np.ndarray:
    """Decisions of every path; −1 where there is none (0)."""
    return np.frexp(path.astype(np.float64))[1] - 1


class BlockWords:
    """What is known of a block's words, by their numbers."""

    def __init__(self, rows: np.ndarray, numbers: list[int], floor: float):
        self.total, self.path, spelled, *counts = rows
        self.spelled = spelled.view("<f8")
        self.base = np.log10((self.total + 0.5) / floor)
        self.level = np.minimum(levels(self.total), 14).astype(np.int8)
        #: Log use by group, with the use overall as one more token.
        self.use = [np.log((c + np.power(10.0, self.base)) / (n + 1)).astype(np.float32) for c, n in zip(counts, numbers)]
        self.share = np.log(np.maximum(numbers, 1e-300) / max(sum(numbers), 1))


class Positions:
    """What every token of some texts is predicted from: contexts, the word expected by a match, and the gates' parts."""

    def __init__(self, codes: np.ndarray, ends: np.ndarray, words: BlockWords):
        first, sizes = ends[:-1], np.diff(ends)
        self.path = words.path[codes]
        self.codes = codes
        shifted = lambda x, start: np.where(opening, start, np.r_[x[:1], x[:-1]])
        opening = np.zeros(len(codes), bool)
        opening[first] = True
        before = shifted(self.path, 0)
        self.before = shifted(words.level[codes], 15).astype(np.uint16)
        pair = shifted(before, 0).astype(np.uint64) * _MULTIPLY + before.astype(np.uint64)
        self.group, best = np.zeros(len(codes), np.int8), None
        for g, use in enumerate(words.use):
            own = use[codes].astype(np.float64)
            told = np.cumsum(own) - own
            told += words.share[g] - np.repeat(told[first], sizes)
            if best is None:
                best = told
            else:
                better = told > best + 1e-9
                best[better], self.group[better] = told[better], g
        self.context = {1: before.astype(np.uint64) * _MULTIPLY, 2: (pair ^ pair >> np.uint64(32)) * _PAIR, 3: group_context(self.group)}
        follower = followers(codes, ends)
        has, self.hit, self.run = matches(codes, ends, follower)
        self.escaped = words.level[codes] == 0
        self.again = has & self.escaped & self.escaped[follower]
        self.expected = np.where(has, self.path[follower], 0)
        self.sum = np.add.reduceat(self.path * 0x9E3779B1, first)

    def half(self) -> np.ndarray:
        """Half of the training texts that each text falls in, by its words."""
        return (self.sum.astype(np.uint64) * _NODE >> np.uint64(63)).astype(np.int64)


def pieces(files: str, block: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A block's ``texts_with_groups``, in batches of whole texts that bound what is held of their positions."""
    for keys, ends, codes, group, size in word_blocks.texts_with_groups(files, block):
        lo = 0
        while lo < len(keys):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + HELD, "right")) - 1)
            yield keys.slice(lo, hi - lo), ends[lo : hi + 1] - ends[lo], codes[ends[lo] : ends[hi]], group[lo:hi], size[lo:hi]
            lo = hi


def group_context(group: np.ndarray) -> np.ndarray:
    return (group.astype(np.uint64) + np.uint64(1)) * _MULTIPLY


def walk(path: np.ndarray, context: dict[int, np.ndarray]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, dict[int, np.ndarray]]]:
    """(depth, number of paths longer than it, bit, node, slots by order) of paths in falling order of length; four
    decisions in a row lie side by side in a table."""
    size = sizes_of(path)
    for depth in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -depth))
        up = size[:n] - depth
        node = path[:n] >> up
        bit = path[:n] >> (up - 1) & 1
        known = depth % 4
        if known == 0:
            line = {order: lines(c[:n], node.astype(np.uint64), WORD_ORDERS[order]) for order, c in context.items()}
        inner = node & ((1 << known) - 1) | 1 << known
        yield depth, n, bit, node, {order: at[:n] | inner for order, at in line.items()}


def falling(path: np.ndarray) -> np.ndarray:
    return np.argsort(-sizes_of(path), kind="stable")


def expects(known: np.ndarray, expected: np.ndarray, run: np.ndarray, depth: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which of ``known`` are still on the expected word's path, its next decision, place in the match's table); who left
    that path does not return."""
    known = known[: np.searchsorted(known, len(node))]
    up = sizes_of(expected[known]) - depth
    known, up = known[up > 0], up[up > 0]
    on = expected[known] >> up == node[known]
    known, up = known[on], up[on]
    return known, expected[known] >> (up - 1) & 1, run[known] * 32 + min(depth, 30)


def count_words(at: Positions, rows: np.ndarray, tables: dict[int, np.ndarray]) -> None:
    """Add the decisions of the tokens at ``rows`` to the tables (slots × 2, flat) that depend on the words before."""
    one = np.uint32(1)
    for lo in range(0, len(rows), STRETCH):
        some = rows[lo : lo + STRETCH]
        some = some[falling(at.path[some])]
        expected, run = at.expected[some], at.run[some]
        known = np.flatnonzero(expected)
        for depth, n, bit, node, slots in walk(at.path[some], {order: at.context[order][some] for order in (1, 2)}):
            for order, slot in slots.items():
                np.add.at(tables[order], slot * 2 + bit, one)
            known, next_bit, place = expects(known, expected, run, depth, node)
            np.add.at(tables[MATCHED], place * 2 + (next_bit == bit[known]), one)
    # Behind the escape: does a word without a path come again?
    again = rows[at.again[rows]]
    np.add.at(tables[MATCHED], (at.run[again] * 32 + 31) * 2 + at.hit[again], one)


def count_uses(path: np.ndarray, used: np.ndarray, tables: dict[int, np.ndarray]) -> None:
    """Add the decisions of a block's words, as often as each was used in a group (groups × words), to the tables that
    depend on the group only, and on nothing."""
    for group, word, order in [(None, used.sum(axis=0), 0)] + [(g, u, 3) for g, u in enumerate(used)]:
        at = np.flatnonzero(word)
        at = at[falling(path[at])]
        context = np.zeros(len(at), np.uint64) if group is None else group_context(np.full(len(at), group))
        times = word[at].astype(np.uint32)
        for _, n, bit, _, slots in walk(path[at], {order: context}):
            np.add.at(tables[order], slots[order] * 2 + bit, times[:n])


def as_read(counts: np.ndarray) -> np.ndarray:
    """Table entries from counts (slots × 2): the logit and how sure it is (no counts, 1, up to 3, 7, 15, more), in 16 bits."""
    zeros, ones = counts[:, 0].astype(np.float32), counts[:, 1].astype(np.float32)
    logit = np.clip(np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR))), -11.9, 11.9)
    return (np.rint(logit / LOGIT + 1023).astype(np.uint16) << SURE) | np.frexp(zeros + ones)[1].clip(0, 5).astype(np.uint16)


def logits(entry: np.ndarray) -> np.ndarray:
    return (entry >> SURE) * LOGIT - 1023 * LOGIT


class WordMixer(Mixer):
    INPUTS = len(WORD_ORDERS) + 2  # with the match and a constant
    SEEN, PLACE = 6 * 4 * 4, 16 * 8


#: Gate by matches in a row.
_RUN = np.array([1, 2, 2, *[3] * 5], np.uint16)


def word_inputs(tables: dict[int, np.ndarray], at: Positions, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of tokens, bit, logits, gate by how well the contexts are known, gate by the word before and the place) of
    every decision of the tokens at ``rows``, which come in falling order of their paths' lengths."""
    path, expected, run, before = at.path[rows], at.expected[rows], at.run[rows], at.before[rows] * np.uint16(8)
    context = {order: at.context[order][rows] for order in (1, 2, 3)}
    known = np.flatnonzero(expected)
    for depth, n, bit, node, slots in walk(path, {0: np.zeros(len(rows), np.uint64), **context}):
        x = np.empty((WordMixer.INPUTS, n), np.float32)
        entry = {order: tables[order].take(slot) for order, slot in slots.items()}
        for order, e in entry.items():
            np.multiply(e >> SURE, LOGIT, out=x[order])
            x[order] -= 1023 * LOGIT
        seen = (entry[1] & 7) << 4 | np.minimum(entry[2] & 7, 3) << 2
        known, next_bit, place = expects(known, expected, run, depth, node)
        told = logits(tables[MATCHED][place])
        x[MATCHED] = 0
        x[MATCHED, known] = np.where(next_bit, told, -told)
        seen[known] |= _RUN[run[known]]
        x[-1] = 0.3
        yield n, bit, x, seen, before[:n] + np.uint16(min(depth, 7))


def learn_texts(at: Positions, rows: np.ndarray, tables: dict[int, np.ndarray], mixer: Mixer, rng: np.random.Generator) -> int:
    """One online pass over all decisions of the tokens at ``rows``, taken in random order and dealt to batches; returns their number."""
    done, rows = 0, rng.permutation(rows)
    for lo in range(0, len(rows), STRETCH):
        some = rows[lo : lo + STRETCH]
        parts = [(bit, x, mixer.gate(seen, place)) for _, bit, x, seen, place in word_inputs(tables, at, some[falling(at.path[some])])]
        if parts:
            bit, x, gate = (np.concatenate(c, axis=-1) for c in zip(*parts))
            mixer.learn(x, gate, bit, 8192)
            done += len(bit)
    return done


def predicted(at: Positions, words: BlockWords, tables: dict[int, np.ndarray], mixer: Mixer) -> np.ndarray:
    """log10 probability of every token after those before it."""
    out, prepared = np.zeros(len(at.path)), (mixer.both(), mixer.refiner(np.float32))
    for lo in range(0, len(out), STRETCH):
        some = np.arange(lo, min(len(out), lo + STRETCH))
        some = some[falling(at.path[some])]
        chance = np.ones(len(some))
        for i, (n, bit, x, seen, place) in enumerate(word_inputs(tables, at, some), 1):
            p = mixer.probability(x, seen, place, prepared)
            chance[:n] *= np.where(bit, p, 1 - p)
            if i % 32 == 0:  # no product is as small as a float can be
                out[some] += np.log10(chance)
                chance[:] = 1
        out[some] += np.log10(chance)
    escaped = np.flatnonzero(at.escaped)
    out[escaped] += words.spelled[at.codes[escaped]]
    again = np.flatnonzero(at.again)
    chance = squash(logits(tables[MATCHED][at.run[again] * 32 + 31]).astype(np.float64))
    own = words.spelled[at.codes[again]]
    out[again] += np.log10(np.where(at.hit[again], chance, 0) + (1 - chance) * 10.0**own + 1e-300) - own
    return out


def train_texts(spark, files: str, blocks: list[int], positions: int, groups: int, words_of) -> tuple[str, np.ndarray]:
    """(folder of the word predictors' tables, state of the mixer) from all training texts.

    Tasks count the decisions of their blocks' training texts, by halves; the tables are summed by regions and written as
    they are read, one fixed-size file per order for each half and for both. Then weights are learned, block by block.
    """
    folder = scratch_path(spark, "lm-words")
    bits = {**WORD_ORDERS, MATCHED: MATCHED_BITS}
    parts = max(1, min(len(blocks), max(spark.sparkContext.defaultParallelism, -(-positions // COUNTED))))

    def trained(block: int, words: BlockWords) -> Iterator[tuple[Positions, list[np.ndarray]]]:
        """Texts' positions, batch by batch, and which of them are training tokens of either half."""
        for _, ends, codes, group, _ in pieces(files, block):
            if (group >= 0).any():
                at = Positions(codes, ends, words)
                half = np.repeat(np.where(group >= 0, at.half(), -1), np.diff(ends))
                yield at, [np.flatnonzero(half == h) for h in (0, 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [{order: np.zeros(2 << b, np.uint32) for order, b in bits.items()} for _ in (0, 1)]
        for block in _dealt(batches, blocks, parts):
            words = words_of(block)
            used = np.zeros((2, groups * len(words.path)), np.uint32)
            for at, halves in trained(block, words):
                for h, rows in enumerate(halves):
                    count_words(at, rows, tables[h])
                    np.add.at(used[h], at.group[rows].astype(np.int64) * len(words.path) + at.codes[rows], np.uint32(1))
            for h in (0, 1):
                count_uses(words.path, used[h].reshape(groups, -1), tables[h])
        for h in (0, 1):
            for order, table in tables[h].items():
                yield from _regions(2 * order + h, table)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _gathered(batches, {2 * order + h: 1 << b for order, b in bits.items() for h in (0, 1)})
        for order in {k // 2 for k in tables}:
            one, two = (tables.get(2 * order + h, np.zeros((1, 2 << bits[order]), np.uint32)).reshape(-1, 2) for h in (0, 1))
            for name, table in (("0", one), ("1", two), ("all", one + two)):
                write_whole(f"{folder}/order-{order}-{name}", [as_read(table).tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array([order], pa.int32())], names=["order"])

    numbers = spark.range(0, parts, 1, parts)
    summed = numbers.mapInArrow(count, REGION_SCHEMA).repartition(2 * REGIONS, "order", "region").mapInArrow(_added, REGION_SCHEMA)
    keyed = summed.withColumn("_to", F.expr("order div 2")).repartition(len(bits), "_to").drop("_to")
    have = {r["order"] for r in keyed.mapInArrow(write, "order int").collect()}  # one row per order
    for order in bits.keys() - have:
        for name in ("0", "1", "all"):
            write_whole(f"{folder}/order-{order}-{name}", [as_read(np.zeros((1 << bits[order], 2))).tobytes()])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _dealt(batches, blocks, len(blocks)):
            mixer, rng, done = WordMixer(), np.random.default_rng(1), 0
            for at, halves in trained(block, words_of(block)):
                for h, rows in enumerate(halves):
                    done += learn_texts(at, rows, word_tables(folder, str(1 - h)), mixer, rng)
            if done:
                yield _state(mixer, done)

    return folder, averaged(spark.range(0, len(blocks), 1, max(1, len(blocks))).mapInArrow(learn, STATE_SCHEMA), WordMixer())


def word_tables(folder: str, name: str) -> dict[int, np.ndarray]:
    return {order: np.frombuffer(mapped(f"{folder}/order-{order}-{name}"), "<u2") for order in (*WORD_ORDERS, MATCHED)}


def _dealt(batches: Iterator[pa.RecordBatch], blocks: list[int], parts: int) -> Iterator[int]:
    for batch in batches:
        for i in batch.column(0).to_pylist():
            yield from blocks[i::parts]


def score_texts(docs: DataFrame, learns: Column, group: Column | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every whole text, learning where ``learns`` holds.

    ``base_score`` is the smoothed unigram's log10 probability, ``score`` the mixing model's; ``bits_per_byte`` is the score
    by the text's UTF-8 bytes, null for texts without any. ``group`` tells training texts apart (any type; its values are
    hashed to ``GROUPS``); a score never depends on it. Null and empty texts are one token, the end. With nothing to learn
    from, every count is 0 and words are only spelled. Rows repeat as given.
    """
    spark = docs.sparkSession
    of = F.lit(0) if group is None else F.pmod(F.xxhash64(group), F.lit(GROUPS))
    groups = 1 if group is None else GROUPS
    blocks = word_blocks.write_blocks(docs, _splitter, key, text, F.when(learns, of), groups)
    schema = "bucket int, payload binary, words long, once long, tokens array<long>, sizes array<long>, uses array<long>"
    distinct = stored(word_blocks.by_bucket(blocks.words, _distinct(groups), schema), "lm-words")
    listed = distinct.select("bucket", "words", "once", "tokens", "sizes", "uses").collect()  # one row per bucket
    types, once = (sum(r[c] for r in listed) for c in ("words", "once"))
    numbers = [sum(r["tokens"][g] for r in listed) for g in range(groups)]
    paths = Paths({r["bucket"]: np.array(r["sizes"]) for r in listed}, np.sum([r["uses"] for r in listed] or [[0] * LEVELS], axis=0), once)
    number = sum(numbers)
    folder, state = train(distinct, types, groups)
    files = blocks.folder
    floor = number + 0.5 * (types + 1)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, tables = _model(folder, Mixer, state, lambda: tables_of(folder))
        for rows in _stretches(batches, groups):
            spelling = spelled([w for _, own, _ in rows for w in own], tables, mixer) * np.log10(2)
            at = 0
            for bucket, own, counts in rows:
                total = counts.sum(axis=0)
                payload = word_blocks.packed(own, total, paths.of(bucket, total), spelling[at : at + len(own)].astype("<f8").view("<i8"), *counts)
                at += len(own)
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([None], pa.int64()), pa.array([payload], pa.binary())], names=["bucket", "block", "payload"])

    def words(bucket: int, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        answer = np.zeros((0, 0))
        for _, block, payload in rows:
            if block is None:  # the bucket's scored words come first
                own, answers = word_blocks.unpacked(payload, 3 + groups)
                known = {w: i for i, w in enumerate(own)}
                answer = np.stack(answers)
                continue
            listed, (steps, *_) = word_blocks.unpacked(payload, 1 + groups)
            at = np.fromiter((known[w] for w in listed), np.int64, len(listed))
            back = np.concatenate([np.cumsum(steps)[None, :], answer[:, at]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([zstandard.ZstdCompressor(level=1).compress(back)], pa.binary())], names=["block", "payload"])

    def keep(block: int, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        """Write what is known of a block's words, in the order of their numbers."""
        parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(r[1]), "<i8") for r in rows]
        place, *values = np.concatenate([p.reshape(4 + groups, -1) for p in parts], axis=1)
        table = np.zeros((3 + groups, len(place)), "<i8")
        table[:, place] = values
        write_whole(f"{files}/{block}.words", [zstandard.ZstdCompressor(level=1).compress(table.tobytes())])
        number = sum(len(codes) for _, _, codes in word_blocks.texts_of(files, block))
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([number], pa.int64())], names=["block", "positions"])

    def words_of(block: int) -> BlockWords:
        table = np.frombuffer(zstandard.ZstdDecompressor().decompress(mapped(f"{files}/{block}.words")), "<i8")
        return BlockWords(table.reshape(3 + groups, -1), numbers, floor)

    asked = distinct.select("bucket", "payload").mapInArrow(scored, "bucket int, block long, payload binary").unionByName(blocks.words)
    answers = word_blocks.by_bucket(asked, words, "block long, payload binary", ["block"])
    kept = word_blocks.by_block(answers, keep, "block long, positions long").collect()  # one row per block of up to 8 million tokens
    names = [r["block"] for r in sorted(kept, key=lambda r: (-r["positions"], r["block"]))]
    word_folder, word_state = train_texts(spark, files, names, sum(r["positions"] for r in kept), groups, words_of)
    columns = [key, "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, tables = _model(word_folder, WordMixer, word_state, lambda: word_tables(word_folder, "all"))
        for block in _dealt(batches, names, len(names)):
            words = words_of(block)
            for keys, ends, codes, _, size in pieces(files, block):  # every text has a token, its end
                total = lambda x: np.add.reduceat(x, ends[:-1])
                score = total(predicted(Positions(codes, ends, words), words, tables, mixer))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(np.diff(ends).astype(np.int64)), pa.array(total((words.total > 0)[codes].astype(np.int64)).astype(np.int64)), pa.array(np.full(len(keys), number, np.int64)),
                     pa.array(total(words.base[codes])), pa.array(score), pa.array(-score * np.log2(10) / np.maximum(size, 1), mask=size == 0)],
                    names=columns,
                )

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return spark.range(0, len(names), 1, max(1, len(names))).mapInArrow(texts, schema)


def followers(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Place of the word that followed where the word before stood earlier in its text; 0: nowhere."""
    n = len(codes)
    text = np.repeat(np.arange(len(ends) - 1, dtype=np.int64), np.diff(ends))
    keys = text << 32 | codes
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    earlier = np.full(n, -1)
    earlier[order[1:][same]] = order[:-1][same]
    follower = np.r_[-1, earlier[:-1]] + 1
    follower[ends[:-1]] = 0  # nothing precedes the first word
    return follower


def matches(codes: np.ndarray, ends: np.ndarray, follower: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether the word before stood earlier in its text, whether the word that followed it there comes again, hits in a row so far, up to 7)."""
    n, follower = len(codes), followers(codes, ends) if follower is None else follower
    has = follower > 0
    hit = has & (codes[follower] == codes)
    at = np.arange(n)
    missed = np.maximum.accumulate(np.where(hit, -1, at))
    run = at - np.r_[-1, missed[:-1]] - 1
    return has, hit, np.minimum(run, len(MATCH) - 1)


def _model(folder: str, kind: type, state: np.ndarray, tables: Callable[[], dict]) -> tuple[Mixer, dict[int, np.ndarray]]:
    """A model, opened once per worker."""
    if _MODELS.get("folder") != folder:
        _MODELS.update(folder=folder, model=(kind(state), tables()))
    return _MODELS["model"]


_MODELS: dict = {}
