"""Scoring texts with a small causal self-attention model over subword ids.

Texts are lower-cased words joined by spaces, as the library's byte-level BPE cuts them. The most
frequent subwords are classes of their own; the rest share one, inside which a binary tree over all
of its ids, each node a logistic function of the attention layer's output, gives each id its own
probability. Every id is an input of its own, too. One attention layer over a window of ids, added
to the log odds of class pairs, gives each class' probability. Windows overlap: each but the first scores only what
the one before it didn't, so every token is scored once and has some context. A word's probability
is the product of its subwords', which knows no unknown.

Corpus counts - words for the base score, subwords for the classes, pairs of classes - come from
all training documents through Spark. The attention weights are trained on all their windows, in
rounds: each task goes on from the round's weights with numpy over the windows of its documents, and
Spark adds up what the tasks arrive at for the next round, weighted by their windows.
"""

from __future__ import annotations

import copy
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfunnel.llm import tokens
from shopfunnel.llm.common import result, saved, scratch
from shopfunnel.llm.words import Words, text_chunks

#: Classes, with one for rare subwords and one for the end of a text; inputs have one for the start.
CLASSES = 128
TAIL, END, START = CLASSES - 2, CLASSES - 1, CLASSES
#: Positions of a window, of these scored by all but a text's first, and width of the model.
WINDOW, SCORED, WIDTH = 32, 24, 16
#: Passes over windows given at once, windows of a step, its length.
EPOCHS, STEP_WINDOWS, STEP = 3, 128, 0.004
#: Length of the first step of a rare id's embedding and of a tree node; later ones are shorter.
RARE_STEP = 0.1
#: Heaviest nodes of the tree, computed for all rare ids at once.
TOP = 128
#: Rounds of training, windows of a task over all rounds, about, and windows trained on at least: fewer are repeated.
ROUNDS, TASK_WINDOWS, LEAST_WINDOWS = 4, 100_000, 90_000
#: Words whose counts for the base score the tasks hold; the others' counts are joined.
FREQUENT = 200_000
#: Windows computed at once: few, so that their arrays stay in a core's cache. Rare ids make a step for each such lot.
_WINDOWS = 64
#: Subwords whose windows are held at once in training.
_SUBWORDS = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def in_training(id_col: str = "doc_id") -> Column:
    """Documents to learn from: all but one residue of the id's checksum. Null ids are among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 != 2, F.lit(True))


def _normal_texts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words of each text, a space before each: UTF-8 bytes, and the places where texts begin and end."""
    data = _LOWER[words.data]
    spaced = np.full(int((words.ends - words.starts).sum()) + len(words.starts), 0x20, np.uint8)
    lengths = words.ends - words.starts + 1
    places = np.cumsum(lengths) - lengths
    inside = np.ones(len(spaced), dtype=bool)
    inside[places] = False
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[words.starts] += 1
    edge[words.ends] -= 1
    spaced[inside] = data[np.cumsum(edge[:-1], dtype=np.int8) > 0]
    return spaced, np.append(places, len(spaced))[words.bounds]


def _spelled(words: Words, vocabulary: str) -> list[np.ndarray]:
    """Subword ids of each text."""
    ids, bounds = tokens.encoder(vocabulary).flat(*_normal_texts(words))
    return np.split(ids, bounds[1:-1])


def word_counts(texts: DataFrame) -> DataFrame:
    """``hash, word, n`` of all words of ``texts(text)``; the row without a word counts the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _count_rows([0], [None], [len(batch)])
            for _, _, words in text_chunks(batch.column("text"), lower=True):
                keys, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
                raw = _LOWER[words.data].tobytes()
                spans = zip(words.starts[first].tolist(), words.ends[first].tolist())
                yield _count_rows(keys.view(np.int64), [raw[a:b].decode(errors="replace") for a, b in spans], n)

    rows = texts.mapInArrow(count, "hash long, word string, n long")
    return rows.groupBy("hash", "word").agg(F.sum("n").alias("n"))


def _count_rows(keys: object, words: list, n: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(words, pa.string()), pa.array(n, pa.int64())], ["hash", "word", "n"])


def subword_counts(counts: DataFrame, vocabulary: str) -> np.ndarray:
    """How often each subword id stands in the counted words."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        total = np.zeros(encoder.tokenizer.get_vocab_size(), dtype=np.int64)
        for batch in batches:
            for low in range(0, len(batch), 4096):
                some = batch.slice(low, 4096)
                spelled = encoder.encode([" " + w for w in some.column("word").to_pylist()])
                ids = np.frombuffer(b"".join(spelled), "<u4")
                repeats = np.repeat(some.column("n").to_numpy(), [len(s) // 4 for s in spelled])
                total += np.bincount(ids, repeats, minlength=len(total)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    found = counts.filter("word is not null").select("word", "n").mapInArrow(spell, "id long, n long")
    found = found.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(tokens.encoder(vocabulary).tokenizer.get_vocab_size(), dtype=np.int64)
    total[found["id"].to_numpy()] = found["n"].to_numpy()
    return total


@dataclass
class Classes:
    """Class of each subword id and the natural logarithm of its share of the class."""

    of: np.ndarray
    share: np.ndarray

    @staticmethod
    def from_counts(counts: np.ndarray) -> Classes:
        best = np.argsort(-counts, kind="stable")[:TAIL]
        of = np.full(len(counts), TAIL, dtype=np.int64)
        of[best] = np.arange(len(best))
        rare = of == TAIL
        share = np.zeros(len(counts))
        share[rare] = np.log((counts[rare] + 1) / (counts[rare].sum() + rare.sum()))
        return Classes(of, share)

    def sequence(self, data: bytes) -> np.ndarray:
        """Classes of a text's ids with the end."""
        return np.append(self.of[np.frombuffer(data, "<u4")], END)

    def cut(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Classes of a text's ids with the end, a byte each, and the numbers of the rare ones among all rare ones."""
        of = self.of[ids]
        return np.append(of, END).astype(np.uint8).tobytes(), self._number[ids[of == TAIL]].astype("<u4").tobytes()

    @cached_property
    def _number(self) -> np.ndarray:
        return np.cumsum(self.of == TAIL) - 1


def codes(sequence: np.ndarray, members: np.ndarray) -> np.ndarray:
    """``sequence`` with the numbers of its rare ids, counted on from the start's, in their places."""
    out = sequence.astype(np.int64)
    out[out == TAIL] = START + 1 + members
    return out


def _sums_by(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``keys`` and the sums of their ``rows``."""
    if keys.max() < 1 << 16:
        keys = keys.astype(np.uint16)  # sorted by digits
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    low = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[low].astype(np.int64), np.add.reduceat(rows.take(order, axis=0), low, axis=0)


class Members:
    """The rare ids: an embedding of each, and a Huffman tree that tells them apart.

    A node's logit is linear in the attention layer's output. Untrained, an id's probability is its
    share of the counts, one added to each.
    """

    def __init__(self, counts: np.ndarray) -> None:
        n = len(counts)
        heap = list(zip((counts + 1).tolist(), range(n)))
        heapq.heapify(heap)
        above, bit = np.full(2 * n, -1), np.zeros(2 * n, bool)
        bias = np.zeros(max(n - 1, 1))
        while len(heap) > 1:
            (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
            node = 2 * n - len(heap) - 2  # inner nodes come after the ids
            above[left], above[right], bit[right] = node, node, True
            bias[node - n] = np.log(b / a)
            heapq.heappush(heap, (a + b, node))
        owners, nodes, bits = [], [], []
        at, owner = np.arange(n), np.arange(n)
        while len(at):
            on = above[at] >= 0
            owner, bits_here, at = owner[on], bit[at[on]], above[at[on]]
            owners.append(owner)
            nodes.append(at - n)
            bits.append(bits_here)
        owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(owner, kind="stable")
        self.nodes, self.bits = np.concatenate(nodes)[order].astype(np.int32), np.concatenate(bits)[order]
        sizes = np.bincount(owner, minlength=n)
        self.low = np.cumsum(sizes) - sizes
        # Inner nodes are numbered by weight: the heaviest come last, and last on every way up.
        self.cut = max(0, len(bias) - TOP)
        self.deep = np.bincount(owner[order], self.nodes < self.cut, minlength=n).astype(np.int64)
        rest = sizes - self.deep
        ways = np.zeros((n, len(bias) - self.cut), np.int8)
        place = tokens._ragged(self.low + self.deep, rest)
        ways[np.repeat(np.arange(n), rest), self.nodes[place] - self.cut] = np.where(self.bits[place], -1, 1)
        ways, self.entry = np.unique(ways, axis=0, return_inverse=True)
        self.ways, self.entry = ways.astype(np.float32), self.entry.ravel().astype(np.int32)
        self.tree = np.zeros((len(bias), WIDTH + 1), np.float32)
        self.tree[:, WIDTH] = bias
        self.embed = np.zeros((n, WIDTH), np.float32)

    def _paths(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes below the heaviest on the ways to some members, which turn is taken there, and whose way it is."""
        sizes = self.deep[member]
        place = tokens._ragged(self.low[member], sizes)
        return self.nodes[place], self.bits[place], np.repeat(np.arange(len(member)), sizes)

    def _turns(self, hidden: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """At the heaviest nodes: the turns taken, 0 where a way doesn't lead, and the odds against each."""
        turns = self.ways.take(self.entry[member], axis=0)
        odds = hidden @ self.tree[self.cut :, :WIDTH].T
        odds += self.tree[self.cut :, WIDTH]
        odds *= turns
        if not _tame(odds):
            np.clip(odds, -80, 80, out=odds)
        return turns, np.exp(odds, out=odds)

    def _odds(self, hidden: np.ndarray, weights: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """The odds against the turns taken at nodes with the ``weights``."""
        logit = np.einsum("ij,ij->i", hidden, weights[:, :WIDTH]) + weights[:, WIDTH]
        return np.exp(np.clip(np.where(bit, -logit, logit), -80, 80))

    def log_probabilities(self, hidden: np.ndarray, member: np.ndarray) -> np.ndarray:
        turns, odds = self._turns(hidden, member)
        odds += 1
        out = -np.einsum("ij,ij->i", np.log(odds, out=odds), np.abs(turns, out=turns)).astype(np.float64)
        node, bit, owner = self._paths(member)
        if len(node):
            odds = self._odds(hidden.take(owner, axis=0), self.tree.take(node, axis=0), bit)
            out -= np.bincount(owner, np.log(odds + 1), minlength=len(member))
        return out

    def slopes(self, hidden: np.ndarray, member: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Derivatives of the loss of ``n`` positions by ``hidden``, the nodes met, and those by them."""
        turns, odds = self._turns(hidden, member)
        by_logit = np.divide(odds, odds + 1, out=odds)
        by_logit *= turns
        by_logit *= 1 / n
        by_hidden = by_logit @ self.tree[self.cut :, :WIDTH]
        by_top = by_logit.T @ np.concatenate([hidden, np.ones((len(hidden), 1), hidden.dtype)], axis=1)
        top = np.flatnonzero(turns.any(axis=0))
        node, bit, owner = self._paths(member)
        if not len(node):
            return by_hidden, top + self.cut, by_top[top]
        weights, met = self.tree.take(node, axis=0), hidden.take(owner, axis=0)
        odds = self._odds(met, weights, bit)
        slope = (np.where(bit, -1, 1) * odds / ((odds + 1) * n)).astype(np.float32)[:, None]
        weights *= slope
        low = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        by_hidden[owner[low]] += np.add.reduceat(weights, low, axis=0)[:, :WIDTH]
        at, by_node = _sums_by(node, np.concatenate([slope * met, slope], axis=1))
        return by_hidden, np.concatenate([at, top + self.cut]), np.concatenate([by_node, by_top[top]])


class Rare:
    """AdaGrad steps of :class:`Members`' rows, and how often each was met."""

    def __init__(self, members: Members) -> None:
        self.tables = {"tree": members.tree, "embed": members.embed}
        self.squares = {k: np.full_like(t, 1e-10) for k, t in self.tables.items()}
        self.met = {k: np.zeros(len(t), np.int64) for k, t in self.tables.items()}

    def step(self, name: str, at: np.ndarray, slopes: np.ndarray, share: float) -> None:
        squares = self.squares[name].take(at, axis=0)
        squares += slopes**2
        self.squares[name][at] = squares
        self.tables[name][at] -= np.float32(RARE_STEP * share) * slopes / np.sqrt(squares, out=squares)
        self.met[name][at] += 1


class Attention:
    """Log probabilities of classes: pair log odds plus one layer of masked self-attention."""

    def __init__(self, pairs: np.ndarray, members: Members | None = None, seed: int = 5) -> None:
        random = np.random.default_rng(seed)

        def drawn(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / np.sqrt(WIDTH)).astype(np.float32)

        self.pairs, self.members = pairs.astype(np.float32), members
        self.weights = {
            "embed": drawn(CLASSES + 1, WIDTH), "place": 0.1 * drawn(WINDOW, WIDTH), "query": drawn(WIDTH, WIDTH),
            "key": drawn(WIDTH, WIDTH), "value": drawn(WIDTH, WIDTH), "out": drawn(WIDTH, WIDTH),
            "score": 0.1 * drawn(WIDTH, CLASSES), "bias": np.zeros(CLASSES, np.float32),
        }
        self.past = np.tril(np.ones((WINDOW, WINDOW), np.float32))

    def _sides(self) -> np.ndarray:
        """Weights to queries, scaled, keys, values and a column that becomes ones."""
        w = self.weights
        query = w["query"] * w["query"].dtype.type(WIDTH**-0.5)
        return np.concatenate([query, w["key"], w["value"], np.zeros_like(query[:, :1])], axis=1)

    def hidden(self, inputs: np.ndarray, low: int = 0) -> tuple[np.ndarray, tuple]:
        """The layer's output at positions from ``low`` on, and what its derivatives need.

        Sums over what a position sees come from the column of ones beside the values.
        """
        w = self.weights
        x = w["embed"].take(_classes(inputs), axis=0) + w["place"]
        if self.members:
            rare = np.flatnonzero(inputs > START)
            x.reshape(-1, WIDTH)[rare] += self.members.embed[inputs.ravel()[rare] - START - 1]
        both = (x.reshape(-1, WIDTH) @ self._sides()).reshape(*inputs.shape, 3 * WIDTH + 1)
        both[..., 3 * WIDTH] = 1
        q, k, v = both[:, low:, :WIDTH], both[..., WIDTH : 2 * WIDTH], both[..., 2 * WIDTH :]
        seen, past = q @ k.transpose(0, 2, 1), self.past[low:]
        if not _tame(seen):
            seen -= np.where(past > 0, seen, -np.inf).max(axis=2, keepdims=True)
            np.minimum(seen, 0, out=seen)
        np.exp(seen, out=seen)
        seen *= past
        met = seen @ v
        total = met[..., WIDTH:]
        met = met[..., :WIDTH] / total
        return x[:, low:] + (met.reshape(-1, WIDTH) @ w["out"]).reshape(met.shape), (x, q, k, v, seen, met, total)

    def _before(self) -> np.ndarray:
        """What the logits of classes begin with, for each class before."""
        return self.pairs + self.weights["bias"]

    def _logits(self, hidden: np.ndarray, classes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Logits of the classes after some ``classes``, whose exponentials are finite and don't all vanish."""
        z = hidden @ self.weights["score"]
        z += before.take(classes, axis=0)
        most = np.sqrt(_squares(hidden).max(initial=0) * _squares(self.weights["score"].T).max())
        if not (most < 40 and _tame(self.weights["bias"])):  # as the pairs' odds are those of shares
            z -= z.max(axis=1, keepdims=True)
        return z

    def log_probabilities(self, inputs: np.ndarray, targets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Natural logarithms at the ``wanted`` positions of windows, in their order."""
        low = _unwanted(wanted)
        at = np.flatnonzero(wanted[:, low:])
        hidden, target = self.hidden(inputs, low)[0].reshape(-1, WIDTH).take(at, axis=0), targets[:, low:].ravel()[at]
        z = self._logits(hidden, _classes(inputs[:, low:].ravel()[at]), self._before())
        chosen = z[np.arange(len(z)), _classes(target)]
        out = chosen - np.log(np.einsum("ij->i", np.exp(z, out=z)))
        rare = np.flatnonzero(target > START)
        if self.members and len(rare):
            out[rare] += self.members.log_probabilities(hidden[rare], target[rare] - START - 1)
        return out

    def slopes(
        self, inputs: np.ndarray, targets: np.ndarray, wanted: np.ndarray, rare: Rare | None = None, share: float = 1.0, of: int = 0
    ) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of the classes in windows and its derivatives by the weights; a part of it if ``of`` positions.

        With ``rare``, the loss of the rare ids inside their class adds to the derivatives, and
        their tree and embeddings make their step.
        """
        w = self.weights
        flat = lambda a: a.reshape(-1, a.shape[-1])
        low = _unwanted(wanted)
        hidden, (x, q, k, v, seen, met, sums) = self.hidden(inputs, low)
        at = np.flatnonzero(wanted[:, low:])
        mine, target = flat(hidden).take(at, axis=0), targets[:, low:].ravel()[at]
        p = self._logits(mine, _classes(inputs[:, low:].ravel()[at]), self._before())
        n = of or len(mine)
        rows, classes = np.arange(len(mine)), _classes(target)
        chosen = p[rows, classes]
        np.exp(p, out=p)
        total = np.einsum("ij->i", p)
        loss = (np.log(total) - chosen).sum() / n
        scale = (1 / (total * p.dtype.type(n)))[:, None]
        p[rows, classes] -= total
        scaled = np.concatenate([mine * scale, scale], axis=1).T @ p
        out = {"score": scaled[:WIDTH], "bias": scaled[WIDTH]}
        dmine = p @ w["score"].T
        dmine *= scale
        if rare:
            tail = np.flatnonzero(target > START)
            by_hidden, nodes, by_node = self.members.slopes(mine[tail], target[tail] - START - 1, n)
            dmine[tail] += by_hidden
            rare.step("tree", nodes, by_node, share)
        dh = np.zeros(hidden.shape, dmine.dtype)
        flat(dh)[at] = dmine
        out["out"] = flat(met).T @ flat(dh)
        dmet = (flat(dh) @ w["out"].T).reshape(dh.shape)
        dmet /= sums
        by_met = np.empty((*dh.shape[:2], WIDTH + 1), dmet.dtype)
        by_met[..., :WIDTH] = dmet
        np.negative(np.einsum("bij,bij->bi", dmet, met), out=by_met[..., WIDTH])
        ds = by_met @ v.transpose(0, 2, 1)
        ds *= seen
        sides = np.empty((*inputs.shape, 3 * WIDTH), dh.dtype)
        sides[:, :low, :WIDTH] = 0
        np.matmul(ds, k, out=sides[:, low:, :WIDTH])
        np.matmul(ds.transpose(0, 2, 1), q, out=sides[..., WIDTH : 2 * WIDTH])
        np.matmul(seen.transpose(0, 2, 1), dmet, out=sides[..., 2 * WIDTH :])
        by_side = flat(x).T @ flat(sides)
        by_side[:, :WIDTH] *= by_side.dtype.type(WIDTH**-0.5)
        for number, name in enumerate(("query", "key", "value")):
            out[name] = by_side[:, number * WIDTH : (number + 1) * WIDTH]
        dx = (flat(sides) @ self._sides()[:, : 3 * WIDTH].T).reshape(x.shape)
        dx[:, low:] += dh
        out["place"] = dx.sum(axis=0)
        found, by_code = _sums_by(inputs.ravel(), flat(dx))
        own = np.searchsorted(found, START, side="right")
        out["embed"] = np.zeros((CLASSES + 1, WIDTH), dx.dtype)
        out["embed"][found[:own]] = by_code[:own]
        if own < len(found):
            out["embed"][TAIL] += by_code[own:].sum(axis=0)
            if rare:
                rare.step("embed", found[own:] - START - 1, by_code[own:], share)
        return float(loss), out

    def train(
        self, inputs: np.ndarray, targets: np.ndarray, wanted: np.ndarray, adam: Adam | None = None, passes: int = EPOCHS,
        fall: float = 0.9, rare: Rare | None = None,
    ) -> None:
        """Adam over shuffled windows; the step's length falls by a share of it until the end."""
        adam = adam or Adam(self.weights)
        random, step = np.random.default_rng(9), 0
        steps, whole = passes * -(-len(inputs) // STEP_WINDOWS), wanted[:, : WINDOW - SCORED].any(axis=1)
        for _ in range(passes):
            order = random.permutation(len(inputs))
            for low in range(0, len(order), STEP_WINDOWS):
                at = order[low : low + STEP_WINDOWS]
                at = at[np.argsort(~whole[at], kind="stable")]
                n, slopes = int(wanted[at].sum()), None
                for few in np.split(at, range(_WINDOWS, len(at), _WINDOWS)):
                    _, part = self.slopes(inputs[few], targets[few], wanted[few], rare, adam.rate / STEP, n)
                    slopes = {k: slopes[k] + d for k, d in part.items()} if slopes else part
                step += 1
                adam.step(slopes, 1 - fall * step / steps)


def _classes(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > START, TAIL, codes)


def _squares(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows)


def _unwanted(wanted: np.ndarray) -> int:
    """How many first positions of the windows are only seen by later ones."""
    return 0 if wanted[:, : WINDOW - SCORED].any() else WINDOW - SCORED


def _tame(logits: np.ndarray) -> bool:
    """Whether exponentials of all of them can be summed up as they are."""
    return not logits.size or bool(logits.max() < 40 and logits.min() > -40)


class Adam:
    """Steps of weights down their slopes, by running means of these and of their squares."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float = STEP) -> None:
        self.weights, self.rate, self.steps = weights, rate, 0
        self.mean, self.square = np.zeros((2, sum(v.size for v in weights.values())), np.float32)

    def step(self, slopes: dict[str, np.ndarray], share: float = 1.0) -> None:
        self.steps += 1
        slope, low = np.concatenate([slopes[name].ravel() for name in self.weights]), 0
        self.mean += 0.1 * (slope - self.mean)
        self.square += 0.01 * (slope**2 - self.square)
        mean, square = self.mean / (1 - 0.9**self.steps), self.square / (1 - 0.99**self.steps)
        moved = (self.rate * share * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)
        for weight in self.weights.values():
            weight -= moved[low : low + weight.size].reshape(weight.shape)
            low += weight.size


def windows_of(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets, which positions to score, and the sequence of each window.

    Windows begin every ``SCORED`` positions; all but a sequence's first leave out the positions
    that the one before has scored. Positions beyond the end aren't wanted.
    """
    lengths = np.array([len(s) for s in sequences])
    counts = 1 + np.maximum(0, -(-(lengths - WINDOW) // SCORED))
    owner = np.repeat(np.arange(len(sequences)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    bounds = np.cumsum(lengths) - lengths
    flat = np.concatenate([*sequences, np.zeros(WINDOW, np.int64)])
    before = np.concatenate([[START], flat[:-1]])
    before[bounds] = START
    inside = SCORED * number[:, None] + np.arange(WINDOW)
    at = bounds[owner][:, None] + inside
    wanted = (inside < lengths[owner][:, None]) & ((number[:, None] == 0) | (np.arange(WINDOW) >= WINDOW - SCORED))
    at = np.minimum(at, len(flat) - 1)
    return before[at], np.where(wanted, flat[at], 0), wanted, owner


@dataclass
class Model:
    classes: Classes
    attention: Attention
    vocabulary: str

    def scores(self, words: Words) -> np.ndarray:
        """Natural log probability of each text with its end."""
        spelled = _spelled(words, self.vocabulary)
        found = self.of_sequences([_coded(*self.classes.cut(ids), bool(self.attention.members)) for ids in spelled])
        if not self.attention.members:
            found += [self.classes.share[ids].sum() for ids in spelled]
        return found

    def of_sequences(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each sequence."""
        inputs, targets, wanted, owner = windows_of(sequences)
        order = np.argsort(~wanted[:, : WINDOW - SCORED].any(axis=1), kind="stable")
        found = [
            self.attention.log_probabilities(inputs[few], targets[few], wanted[few])
            for few in np.split(order, range(_WINDOWS, len(order), _WINDOWS))
        ]
        return np.bincount(np.repeat(owner[order], wanted[order].sum(axis=1)), np.concatenate(found), minlength=len(sequences))


def class_sequences(training: DataFrame, classes: Classes, vocabulary: str) -> DataFrame:
    """``place, classes, members`` of every text: classes a byte each, and the rare ids' numbers.

    ``place`` is a hash of the row.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, words in text_chunks(batch.column("text"), lower=True):
                spelled = _spelled(words, vocabulary)
                places = batch.column("place").slice(first, last - first)
                columns = [places, *_cut_columns([classes.cut(d) for d in spelled])]
                yield pa.RecordBatch.from_arrays(columns, ["place", "classes", "members"])

    return training.select(F.xxhash64("id", "text").alias("place"), "text").mapInArrow(cut, "place long, classes binary, members binary")


def _cut_columns(cut: list[tuple[bytes, bytes]]) -> list[pa.Array]:
    return [pa.array([row[side] for row in cut], pa.binary()) for side in (0, 1)]


def _coded(classes: bytes, members: bytes, whole: bool) -> np.ndarray:
    cut = np.frombuffer(classes, np.uint8).astype(np.int64)
    return codes(cut, np.frombuffer(members, "<u4")) if whole else cut


def _grouped(batches: Iterator[pa.RecordBatch], whole: bool = False) -> Iterator[list[np.ndarray]]:
    """Sequences of the rows, about as many at a time as may be held; ``whole`` ones tell rare ids apart."""
    group: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for cut, members in zip(batch.column("classes"), batch.column("members")):
            group.append(_coded(cut.as_py(), members.as_py(), whole))
            size += len(group[-1])
            if size >= _SUBWORDS:
                yield group
                group, size = [], 0
    if group:
        yield group


def pair_counts(sequences: DataFrame) -> tuple[np.ndarray, int]:
    """How often each class follows each, and the number of windows, over all sequences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, windows = np.zeros((CLASSES + 1) * CLASSES, np.int64), 0
        for group in _grouped(batches):
            after = np.concatenate(group)
            before = np.concatenate([[START], after[:-1]])
            lengths = np.array([len(s) for s in group])
            before[np.cumsum(lengths) - lengths] = START
            found += np.bincount(before * CLASSES + after, minlength=len(found))
            windows += int((1 + np.maximum(0, -(-(lengths - WINDOW) // SCORED))).sum())
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(found[at], windows))], ["pair", "n"])

    rows = sequences.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pair, n = rows["pair"].to_numpy(), rows["n"].to_numpy()
    counts = np.zeros((CLASSES + 1) * CLASSES, np.int64)
    counts[pair[pair >= 0]] = n[pair >= 0]
    return counts.reshape(-1, CLASSES), int(n[pair < 0].sum())


def train_attention(sequences: DataFrame, attention: Attention, windows: int) -> None:
    """Train on every window of the sequences, once if they are many.

    Each round takes the sequences of one residue, or all of a small table several times. The tasks
    go on from the same weights, and the next round begins with the mean of what they arrive at; what
    belongs to a rare id counts by how often a task met it.
    """
    tasks, small = max(1, windows // TASK_WINDOWS), windows < LEAST_WINDOWS
    passes = -(-LEAST_WINDOWS // (ROUNDS * windows)) if small else 1
    names = list(attention.weights)
    for number in range(ROUNDS):
        held = sequences.sparkSession.sparkContext.broadcast(attention)
        rate = STEP * (1 - 0.9 * number / ROUNDS)

        def learn(batches: Iterator[pa.RecordBatch], held=held, rate=rate) -> Iterator[pa.RecordBatch]:
            own = copy.deepcopy(held.value)
            adam, seen, whole = Adam(own.weights, rate), 0, own.members is not None
            rare = Rare(own.members) if whole else None
            for group in _grouped(batches, whole) if passes == 1 else [[s for g in _grouped(batches, whole) for s in g]]:
                if group:
                    inputs, targets, wanted, _ = windows_of(group)
                    own.train(inputs, targets, wanted, adam, passes, fall=0, rare=rare)
                    seen += len(inputs)
            if seen:
                flat = np.concatenate([own.weights[k].ravel() for k in names])
                yield _reported("weights", np.arange(len(flat)), seen, flat.reshape(-1, 1))
            for name in rare.tables if rare else ():
                at = np.flatnonzero(rare.met[name])
                moved = rare.tables[name][at] - getattr(held.value.members, name)[at]
                yield _reported(name, at, rare.met[name][at], moved)

        mine = sequences if small else sequences.filter(F.pmod("place", F.lit(ROUNDS)) == number)
        dealt = mine.repartition(tasks, "place").sortWithinPartitions("place", "classes", "members")
        sums = [F.sum(c).alias(c) for c in ("n", *_REPORTED)]
        rows = dealt.mapInArrow(learn, _REPORT).groupBy("name", "at").agg(*sums).toArrow().sort_by("at")
        held.unpersist()
        found = {name: rows.filter(pc.equal(rows["name"], name)) for name in ("weights", "tree", "embed")}
        if len(found["weights"]):
            flat, low = _means(found["weights"], 1).ravel(), 0
            for name, old in attention.weights.items():
                attention.weights[name] = flat[low : low + old.size].reshape(old.shape).astype(np.float32)
                low += old.size
        for name in ("tree", "embed") if attention.members else ():
            table = getattr(attention.members, name)
            table[found[name]["at"].to_numpy()] += _means(found[name], table.shape[1]).astype(np.float32)


#: What a task arrives at: rows of a table, times how much they count.
_REPORTED = [f"x{k}" for k in range(WIDTH + 1)]
_REPORT = "name string, at long, n long, " + ", ".join(f"{c} double" for c in _REPORTED)


def _reported(name: str, at: np.ndarray, n: np.ndarray | int, rows: np.ndarray) -> pa.RecordBatch:
    n = np.broadcast_to(np.asarray(n, np.int64), at.shape)
    filled = np.zeros((len(at), len(_REPORTED)))
    filled[:, : rows.shape[1]] = rows * n[:, None]
    columns = [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int64)), pa.array(n), *map(pa.array, filled.T.copy())]
    return pa.RecordBatch.from_arrays(columns, ["name", "at", "n", *_REPORTED])


def _means(rows: pa.Table, width: int) -> np.ndarray:
    return np.stack([rows[c].to_numpy() for c in _REPORTED[:width]], axis=1) / rows["n"].to_numpy()[:, None]


def train_model(training: DataFrame, counts: DataFrame, vocabulary: str) -> Model:
    """Classes, their pairs and the weights, from all training documents."""
    each = subword_counts(counts, vocabulary)
    with scratch(training.sparkSession):
        classes = Classes.from_counts(each)
        return _trained(saved(class_sequences(training, classes, vocabulary), "class-sequences"), each, classes, vocabulary)


def _trained(sequences: DataFrame, each: np.ndarray, classes: Classes, vocabulary: str) -> Model:
    found, windows = pair_counts(sequences)
    pairs = found + 1.0 / CLASSES
    attention = Attention(np.log(pairs / pairs.sum(axis=1, keepdims=True)), Members(each[classes.of == TAIL]))
    if windows:
        train_attention(sequences, attention, windows)
    return Model(classes, attention, vocabulary)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are the words, lower-cased A-Z, and one end. ``base_score`` is that of smoothed counts of
    the training tokens, ``score`` the model's; both are base-10 logarithms. A null text is empty and
    has the end alone. Null ids train. Repeated rows are scored each. Without training documents
    all counts are zero. An empty table gives an empty result. Other columns are not read.

    Each text is cut into subwords once, which training and scoring read.
    """
    vocabulary = vocabulary or tokens.vocabulary_path()
    id_type = docs.schema[id_col].dataType.simpleString()
    read = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), in_training(id_col).alias("training")
    )
    counts = saved(word_counts(read.filter("training").select("text")), "word-counts")
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count_if((F.col("n") > 0)), F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0))
    ).first()
    train_tokens, distinct, ends = (int(x) for x in sums)
    each = subword_counts(counts, vocabulary)
    classes = Classes.from_counts(each)
    frequent = counts.filter("word is not null").orderBy(F.desc("n"), "hash").limit(FREQUENT).select("hash", "n").toArrow()
    order = np.argsort(frequent["hash"].to_numpy().view(np.uint64))
    held = docs.sparkSession.sparkContext.broadcast(
        (classes, frequent["hash"].to_numpy().view(np.uint64)[order], frequent["n"].to_numpy()[order])
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, hashes, n = held.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, last, words in text_chunks(batch.column("text"), lower=True):
                rows = batch.slice(first, last - first)
                at = np.searchsorted(hashes, words.hashes)
                at[at == len(hashes)] = 0
                known = hashes[at] == words.hashes if len(hashes) else np.zeros(len(at), bool)
                logs = np.where(known, np.log10(n[at] + 1), 0) if len(hashes) else np.zeros(len(at))
                total = np.concatenate([[0.0], np.cumsum(logs)])
                seen = np.concatenate([[0], np.cumsum(known)])
                lengths, lists = np.diff(words.bounds), np.searchsorted(np.flatnonzero(~known), words.bounds)
                rare = pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), pa.array(words.hashes[~known].view(np.int64)))
                spelled = _spelled(words, vocabulary)
                columns = [
                    pa.array(np.arange(row, row + len(rows))), rows.column("id"), rows.column("training"), rows.column("place"),
                    pa.array(lengths + 1), pa.array(seen[words.bounds[1:]] - seen[words.bounds[:-1]] + (ends > 0)),
                    pa.array(total[words.bounds[1:]] - total[words.bounds[:-1]] + np.log10(ends + 1)), rare,
                    *_cut_columns([classes.cut(d) for d in spelled]),
                ]
                row += len(rows)
                names = ["row", "id", "training", "place", "n_tokens", "known", "logs", "rare", "classes", "members"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = (
        f"row long, id {id_type}, training boolean, place long, n_tokens long, known long, logs double, rare array<long>, "
        "classes binary, members binary"
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = learnt.value
        for batch in batches:
            # cut into ranges of rows with about as many subwords as may be held
            runs = np.cumsum(pc.binary_length(batch.column("classes")).to_numpy()) // _SUBWORDS
            bounds = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(batch)] if len(batch) else [0]
            for low, high in zip(bounds[:-1], bounds[1:]):
                rows = batch.slice(low, high - low)
                group = [_coded(c.as_py(), m.as_py(), True) for c, m in zip(rows.column("classes"), rows.column("members"))]
                scores = pa.array(model.of_sequences(group) / np.log(10))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-2], scores], [*rows.schema.names[:-2], "score"])

    scored_schema = f"row long, id {id_type}, training boolean, n_tokens long, known long, logs double, rare array<long>, score double"
    with scratch(docs.sparkSession):
        spelled = saved(read.withColumn("place", F.xxhash64("id", "text")).mapInArrow(cut, schema), "spelled")
        model = _trained(spelled.filter("training").select("place", "classes", "members"), each, classes, vocabulary)
        learnt = docs.sparkSession.sparkContext.broadcast(model)
        scored = result(spelled.drop("place").mapInArrow(score, scored_schema), "scored")
    lookups = scored.select("row", F.explode("rare").alias("hash"))
    more = lookups.join(counts.filter("word is not null").select("hash", "n"), "hash").groupBy("row").agg(
        F.count(F.lit(1)).alias("more_known"), F.sum(F.log10(F.col("n") + 1)).alias("more_logs")
    )
    whole = scored.drop("rare").join(more, "row", "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    base = logs - F.col("n_tokens") * F.log10(F.lit(float(train_tokens + distinct + 1)))
    return whole.select(
        F.col("id").alias("doc_id"), (~F.col("training")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
