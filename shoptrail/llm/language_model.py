"""Language-model scores: a gated recurrent network over words with a class-factored output softmax.

The most frequent words are dealt to classes of equal size; P(word) = P(class | state) * P(word | class, state).
All other words fall into classes by their first and last byte, whose share the network learns; inside such a
class a word has (c + 1) / (N + V + 1) from its count c, and (unseen) 1 / (N + V + 1), with the class's sums of
counts N and of distinct words V. So every text has a probability and the counts of all words are used.

Training is truncated backpropagation in numpy. After a short common start every task trains on its part of the
documents, with gradients from every token of them, and the parameters are averaged by tokens. The state is carried across the windows of a document and set to zero
at its start, in training and in scoring, so a text's score is the likelihood of the complete text.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import slices, split_words, written

HIDDEN = 16
HEAD_CLASSES, CLASS_SIZE = 40, 50
FIRST_GROUPS, TAIL_CLASSES = 8, 24

# Words whose counts every task holds at most, all above some count; the counts of rarer words are joined by a shuffle.
LISTED_WORDS = 131_072

WINDOW, LANES, RATE = 16, 512, 0.1

# Gradients are taken in each BACKPROP_EVERY-th window: in all of them, so that every token is learnt from.
BACKPROP_EVERY = 1

# The common start of all tasks is trained on this many documents at most, the first by hash of their ids.
WARM_DOCS, WARM_LANES, WARM_EVERY, WARM_RATE = 1200, 32, 2, 0.2

# Text in a task's memory at once: as long as many documents, so that a long one can share its steps.
SLICE_BYTES = 16_000_000


# --- the network ----------------------------------------------------------------------------------


@dataclass
class Network:
    """``inputs``: by symbol, what it adds to the gates; ``turn``: state to gates; then class and word outputs."""

    inputs: np.ndarray
    turn: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray
    word_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.turn, self.classes, self.class_bias, self.words, self.word_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()]).astype(np.float32)

    def over(self, flat: np.ndarray) -> "Network":
        """A network of this shape whose values are those of ``flat``, without a copy."""
        ends = np.cumsum([a.size for a in self.arrays()])
        return Network(*(part.reshape(a.shape) for part, a in zip(np.split(flat, ends[:-1]), self.arrays())))

    def of(self, flat: np.ndarray) -> "Network":
        """A network of this shape with other values."""
        return self.over(flat.copy())


SYMBOLS = HEAD_CLASSES * CLASS_SIZE + TAIL_CLASSES
START = SYMBOLS


def fresh(head_counts: np.ndarray, tail_counts: np.ndarray, hidden: int = HIDDEN) -> Network:
    """Small random weights; biases give every symbol its share of the counts. Unused places have none."""
    rng = np.random.default_rng(7)
    counts = np.zeros(HEAD_CLASSES * CLASS_SIZE)
    counts[: len(head_counts)] = head_counts + 1.0
    counts = counts.reshape(HEAD_CLASSES, CLASS_SIZE)
    log = lambda x: np.where(x > 0, np.log(np.maximum(x, 1e-9)), -1e9).astype(np.float32)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    class_counts = np.concatenate((counts.sum(1), tail_counts + 1.0))
    return Network(
        small(SYMBOLS + 1, 3 * hidden), small(hidden, 3 * hidden), small(hidden, HEAD_CLASSES + TAIL_CLASSES) * 0.1,
        log(class_counts / class_counts.sum()), small(HEAD_CLASSES, hidden, CLASS_SIZE) * 0.1,
        log(counts / np.maximum(counts.sum(1, keepdims=True), 1)),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _run(net: Network, symbols: np.ndarray, keep: np.ndarray, state: np.ndarray, trace: bool):
    """States after each step of (steps, lanes) symbols. ``keep`` is 0 where a document starts.

    Inside, and in the trace, lanes are the last axis, so that gates are blocks without gaps.
    """
    hidden = state.shape[1]
    states = np.empty((*symbols.shape, hidden), np.float32)
    turn, state = np.ascontiguousarray(net.turn.T), np.ascontiguousarray(state.T)
    traced = []
    for t in range(len(symbols)):
        added = np.ascontiguousarray(net.inputs[symbols[t]].T)
        before = state * keep[t]
        turned = turn @ before
        gates, offer = added[: 2 * hidden], added[2 * hidden :]
        gates += turned[: 2 * hidden]
        _sigmoid(gates)
        reset, update = gates[:hidden], gates[hidden:]
        offer += reset * turned[2 * hidden :]
        np.tanh(offer, out=offer)
        state = before - offer
        state *= update
        state += offer
        states[t] = state.T
        if trace:
            traced.append((before, reset, update, offer, turned[2 * hidden :]))
    return states, state.T, traced


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Sums over the first axis, added in the order in which numpy adds a row: by eights, then these, then the rest."""
    whole = len(x) // 8 * 8
    sums = x[:8] + x[8:16]
    for i in range(16, whole, 8):
        sums += x[i : i + 8]
    while len(sums) > 1:
        sums = sums[::2] + sums[1::2]
    for row in x[whole:]:
        sums[0] += row
    return sums[0]


def _chosen(logits: np.ndarray, at: np.ndarray, learn: bool) -> np.ndarray:
    """Log probability of place ``at`` of each column; to learn, ``logits`` become the gradient for them."""
    columns = np.arange(len(at))
    logits -= logits.max(0)
    own = logits[at, columns]
    np.exp(logits, out=logits)
    total = _column_sums(logits)
    if learn:
        logits /= total
        logits[at, columns] -= 1
    return own - np.log(total)


def _outputs(net: Network, states: np.ndarray, targets: np.ndarray, grads: Network | None = None):
    """Log probability of each target symbol (of a tail class: of the class), and the gradient for the states.

    For probabilities tokens are the last axis and all words of the head one array, so that each step runs over long rows.
    """
    learn = grads is not None
    head = targets < HEAD_CLASSES * CLASS_SIZE
    target_class = np.where(head, targets // CLASS_SIZE, targets - HEAD_CLASSES * (CLASS_SIZE - 1)).astype(np.uint8)
    # Sorted by class, each class's tokens are one block, and those of the head come first.
    order = np.argsort(target_class, kind="stable")
    states, targets, target_class = states[order], targets[order], target_class[order]
    ends = np.searchsorted(target_class, np.arange(HEAD_CLASSES + 1))
    turned = np.ascontiguousarray(states.T)
    logits = net.classes.T @ turned
    logits += net.class_bias[:, None]
    logs = _chosen(logits, target_class, learn)
    back = None
    if learn:
        own = np.ascontiguousarray(logits.T)
        grads.classes += states.T @ own
        grads.class_bias += own.sum(0)
        back = own @ net.classes.T
    blocks = [(k, slice(ends[k], ends[k + 1])) for k in range(HEAD_CLASSES) if ends[k] < ends[k + 1]]
    logits = np.empty((CLASS_SIZE, ends[-1]), logits.dtype)
    for k, block in blocks:
        np.matmul(net.words[k].T, turned[:, block], out=logits[:, block])
        logits[:, block] += net.word_bias[k][:, None]
    logs[: ends[-1]] += _chosen(logits, targets[: ends[-1]] % CLASS_SIZE, learn)
    for k, block in blocks if learn else []:
        own = np.ascontiguousarray(logits[:, block].T)
        grads.words[k] += states[block].T @ own
        grads.word_bias[k] += own.sum(0)
        back[block] += own @ net.words[k].T
    out = np.empty_like(logs)
    out[order] = logs
    if learn:
        unsorted = np.empty_like(back)
        unsorted[order] = back
        back = unsorted
    return out, back


def _back(net: Network, symbols, keep, traced, back: np.ndarray, grads: Network) -> None:
    """Backpropagation through the steps of one window."""
    steps, lanes, hidden = back.shape
    from_gates, added = np.empty((3 * hidden, lanes), np.float32), np.empty((steps, 3 * hidden, lanes), np.float32)
    later = np.zeros((hidden, lanes), np.float32)
    for t in reversed(range(steps)):
        before, reset, update, offer, turned = traced[t]
        later += back[t].T
        d, d_reset, d_update, d_offer = later, added[t, :hidden], added[t, hidden : 2 * hidden], added[t, 2 * hidden :]
        rest = 1 - update
        np.multiply(d * rest, 1 - offer * offer, out=d_offer)
        np.multiply(d * (before - offer), update * rest, out=d_update)
        np.multiply(d_offer * turned, reset * (1 - reset), out=d_reset)
        from_gates[: 2 * hidden] = added[t, : 2 * hidden]
        np.multiply(d_offer, reset, out=from_gates[2 * hidden :])
        grads.turn += before @ from_gates.T
        later = (d * update + net.turn @ from_gates) * keep[t]
    flat = symbols.ravel()
    order = np.argsort(flat.astype(np.uint16), kind="stable")
    ordered = flat[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    grads.inputs[ordered[starts]] += np.add.reduceat(added.transpose(0, 2, 1).reshape(-1, 3 * hidden)[order], starts)


def _lanes(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Deals documents to lanes, longest first to the shortest lane: (steps, lanes) of token places, -1 after a
    lane's end, and the lanes' lengths, falling."""
    total, longest = int(lengths.sum()), int(lengths.max())
    n = max(1, min(most, total // longest, len(lengths)))
    starts = np.cumsum(lengths) - lengths
    heap, dealt = [(0, i) for i in range(n)], [[] for _ in range(n)]
    for doc in np.argsort(-lengths, kind="stable").tolist():
        used, lane = heapq.heappop(heap)
        dealt[lane].append(doc)
        heapq.heappush(heap, (used + int(lengths[doc]), lane))
    dealt.sort(key=lambda docs: -int(lengths[docs].sum()))
    filled = np.array([int(lengths[docs].sum()) for docs in dealt])
    places = np.full((n, filled[0]), -1, np.int32)
    for i, docs in enumerate(dealt):
        places[i, : filled[i]] = np.concatenate([np.arange(starts[d], starts[d] + lengths[d]) for d in docs])
    return np.ascontiguousarray(places.T), filled


def _windows(symbols: np.ndarray, lengths: np.ndarray, lanes: int, steps: int) -> Iterator[tuple]:
    """Windows of all lanes that go on: token places, inputs, ``keep`` and the lanes' number."""
    places, filled = _lanes(lengths, lanes)
    first = np.zeros(len(symbols), bool)
    first[np.cumsum(lengths) - lengths] = True
    inputs = np.concatenate((np.array([START], np.int32), symbols[:-1]))
    inputs[first] = START
    t = 0
    while t < len(places):
        n = int((filled > t).sum())
        size = steps * max(1, lanes // n)  # few lanes take more steps, so that outputs stay in large blocks
        at = places[t : t + size, :n]
        yield at, inputs[at], (~first[at]).astype(np.float32), n
        t += size


def train(
    net: Network, symbols: np.ndarray, lengths: np.ndarray, memory: np.ndarray, every: int = BACKPROP_EVERY, rate: float = RATE, lanes: int = LANES
) -> Network:
    """One run over some documents (flat symbols, their lengths). ``memory`` sums squared gradients, in place."""
    if not len(lengths):
        return net
    # Values, gradients and squares are flat, so that a window's step is a few operations on long arrays kept for all windows.
    values = net.flat()
    gradients, buffer = np.empty_like(values), np.empty_like(values)
    net, grads = net.over(values), net.over(gradients)
    state = None
    for i, (at, inputs, keep, n) in enumerate(_windows(symbols, lengths, lanes, WINDOW)):
        state = np.zeros((n, net.turn.shape[0]), np.float32) if state is None else state[:n]
        learn = i % every == 0
        states, state, traced = _run(net, inputs, keep, state, learn)
        if not learn:
            continue
        real = (at >= 0).ravel()
        gradients.fill(0)
        _, back = _outputs(net, states.reshape(-1, states.shape[2])[real], symbols[at.ravel()[real]], grads)
        whole = np.zeros((real.size, states.shape[2]), np.float32)
        whole[real] = back
        _back(net, inputs, keep, traced, whole.reshape(states.shape), grads)
        gradients /= max(1, int(real.sum()))
        memory += np.multiply(gradients, gradients, out=buffer)
        np.sqrt(np.add(memory, 1e-10, out=buffer), out=buffer)
        gradients *= rate
        gradients /= buffer
        values -= gradients
    return net


def log_probabilities(net: Network, symbols: np.ndarray, lengths: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """Natural log probability of each document's symbols."""
    if not len(lengths):
        return np.zeros(0)
    out = np.zeros(len(symbols), np.float32)
    state = None
    for at, inputs, keep, n in _windows(symbols, lengths, lanes, 2 * WINDOW):
        state = np.zeros((n, net.turn.shape[0]), np.float32) if state is None else state[:n]
        states, state, _ = _run(net, inputs, keep, state, False)
        real = (at >= 0).ravel()
        places = at.ravel()[real]
        out[places], _ = _outputs(net, states.reshape(-1, states.shape[2])[real], symbols[places])
    ends = np.cumsum(lengths)
    return np.add.reduceat(out, ends - lengths, dtype=np.float64)


# --- words, counts and documents ------------------------------------------------------------------


@dataclass
class LanguageModel:
    """The network with what tasks need of the counts. ``words`` are the listed ones, most frequent first; the
    first ``HEAD_CLASSES * CLASS_SIZE - 1`` of them are symbols of their own, after symbol 0, a text's end."""

    net: Network
    words: list[str]
    counts: np.ndarray
    ends: int
    tokens: int
    distinct: int
    tail_logs: np.ndarray


HEAD = HEAD_CLASSES * CLASS_SIZE - 1


def _tail_class(words: pa.Array) -> np.ndarray:
    """By the first byte and by a comma, a full stop or something else at the end; alike for equal words."""
    if not len(words):
        return np.zeros(0, np.int64)
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8)
    first, last = data[at[:-1]], data[at[1:] - 1]
    return (first % FIRST_GROUPS) * 3 + np.select([last == 44, last == 46], [0, 1], 2).astype(np.int64)


def _tokens(texts: pa.Array, words: pa.Array):
    """Symbols of some texts, their lengths, the place among the listed ``words`` (-1: not listed; end: -2) of each
    token, the words, and where each text's words start and end."""
    found, at = split_words(texts)
    listed = pc.fill_null(pc.index_in(found, value_set=words), -1).to_numpy(zero_copy_only=False)
    head = (listed >= 0) & (listed < HEAD)
    symbol = np.where(head, listed + 1, HEAD + 1 + _tail_class(found)).astype(np.int32)
    n_words = at[1:] - at[:-1]
    places = np.arange(len(found)) + np.repeat(np.arange(len(n_words)), n_words)
    symbols, known = np.zeros(len(found) + len(n_words), np.int32), np.full(len(found) + len(n_words), -2, np.int32)
    symbols[places], known[places] = symbol, listed
    return symbols, n_words + 1, known, found, at


def word_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``n``: how often each word stands in the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE_BYTES):
            counted = pc.value_counts(split_words(batch.column("text"))[0])
            yield pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _averaged(parts: DataFrame, at_once: int = 16) -> tuple[float, np.ndarray | None]:
    """The average of the rows (``tokens``, ``net`` as bytes), weighted by tokens; summed in a tree of tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, total = 0.0, None
        for batch in batches:
            for n, net in zip(batch.column("tokens").to_pylist(), batch.column("net")):
                values = np.frombuffer(net.as_buffer(), np.float64)
                tokens, total = tokens + n, values.copy() if total is None else total + values
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([total.tobytes()], pa.binary())], ["tokens", "net"])

    parts = written(parts, "networks")
    while (n := parts.count()) > at_once:
        dealt = parts.repartition(-(-n // at_once), F.xxhash64("net"))
        parts = written(dealt.mapInArrow(add, parts.schema), "networks")
        if parts.count() >= n:
            break
    rows = sorted(((r["tokens"], bytes(r["net"])) for r in parts.collect()))
    tokens = sum(r[0] for r in rows)
    return tokens, sum(np.frombuffer(r[1], np.float64) for r in rows) / tokens if tokens else None


def _trained(docs: DataFrame, net: Network, words: list[str], lanes: int, every: int, rate: float) -> Network:
    """``net`` trained by each task on its documents, averaged."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, memory, tokens, listed = net, np.zeros_like(net.flat()), 0.0, pa.array(words, pa.string())
        for batch in slices(batches, limit=SLICE_BYTES):
            symbols, lengths = _tokens(batch.column("text"), listed)[:2]
            pa.default_memory_pool().release_unused()
            own, tokens = train(own, symbols, lengths, memory, every, rate, lanes), tokens + float(len(symbols))
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([tokens]), pa.array([(own.flat().astype(np.float64) * tokens).tobytes()], pa.binary())], ["tokens", "net"]
            )

    _, average = _averaged(docs.select("text").mapInArrow(learn, "tokens double, net binary"))
    return net if average is None else net.of(average.astype(np.float32))


def fit(docs: DataFrame) -> tuple[LanguageModel, DataFrame]:
    """A model of the texts of ``docs`` (``doc_id``, ``text``; null: empty), and the table of all word counts."""
    counts = written(word_counts(docs), "word-counts")
    # The least count that at most LISTED_WORDS words reach, from the number of words by count.
    above, least = 0, 0
    for r in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        above += r["count"]
        if above > LISTED_WORDS:
            least = r["n"] + 1
            break
    top = sorted(counts.filter(F.col("n") >= least).collect(), key=lambda r: (-r["n"], r["word"]))
    words, listed = [r["word"] for r in top], np.array([r["n"] for r in top], np.int64)
    ends = docs.count()

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, n = _tail_class(batch.column("word")), batch.column("n").to_numpy()
            sums = [np.bincount(kinds, n, TAIL_CLASSES).astype(np.int64), np.bincount(kinds, minlength=TAIL_CLASSES)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(TAIL_CLASSES)), *map(pa.array, sums)], ["kind", "n", "v"])

    sums = counts.mapInArrow(classify, "kind bigint, n bigint, v bigint").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    tail_n, tail_v = np.zeros(TAIL_CLASSES, np.int64), np.zeros(TAIL_CLASSES, np.int64)
    for r in sums.collect():
        tail_n[r["kind"]], tail_v[r["kind"]] = r["n"], r["v"]
    tokens, distinct = int(tail_n.sum()) + ends, int(tail_v.sum()) + (ends > 0)
    head = pa.array(words[:HEAD], pa.string())
    tail_n -= np.bincount(_tail_class(head), listed[:HEAD], TAIL_CLASSES).astype(np.int64)
    tail_v -= np.bincount(_tail_class(head), minlength=TAIL_CLASSES)
    net = fresh(np.concatenate(([ends], listed[:HEAD])), tail_n)
    first = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(WARM_DOCS)
    warm = docs.select("doc_id", "text").join(F.broadcast(first), "doc_id", "left_semi")
    # One text of each id comes to the task that warms up, so at most so many; all are searched where they are.
    warm = warm.groupBy("doc_id").agg(F.min_by(F.struct("text"), F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    warm = warm.select("text").repartition(1).sortWithinPartitions(F.xxhash64("text"))
    net = _trained(warm, net, words, WARM_LANES, WARM_EVERY, WARM_RATE)
    net = _trained(docs, net, words, LANES, BACKPROP_EVERY, RATE)
    return LanguageModel(net, words, listed, ends, tokens, distinct, np.log(tail_n + tail_v + 1.0)), counts


def score(docs: DataFrame, model: LanguageModel, counts: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of each row of ``docs``.

    Scores are log10 probabilities of the complete text and its end: by the words' counts with one added, and by the
    model. A null or empty text is its end alone. Rows are scored one by one, whatever their ids.
    """
    end_log = np.log(model.ends + 1.0)
    # Products of matrices may round a column otherwise beside others; texts without words score alike in any batch.
    end_alone = log_probabilities(model.net, np.zeros(1, np.int32), np.ones(1, np.int64))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, logs = pa.array(model.words, pa.string()), np.log(model.counts + 1.0)
        logs = np.concatenate((logs, [end_log, 0.0]))  # at -2 the end, at -1 words that are not listed
        for batch in slices(batches, limit=SLICE_BYTES):
            symbols, lengths, listed, found, at = _tokens(batch.column("text"), words)
            pa.default_memory_pool().release_unused()
            starts = np.cumsum(lengths) - lengths
            sums = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
            tail = symbols > HEAD
            own = log_probabilities(model.net, symbols, lengths)
            own[lengths == 1] = end_alone
            own -= sums(np.where(tail, model.tail_logs[np.maximum(symbols - HEAD - 1, 0)], 0.0))
            log = logs[listed]
            rare = listed[listed != -2] == -1
            places = np.concatenate(([0], np.cumsum(rare)))[at].astype(np.int32)
            rare_words = pa.ListArray.from_arrays(pa.array(places), found.filter(pa.array(rare)))
            known = sums(((listed >= 0) | ((listed == -2) & (model.ends > 0))).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(sums(log)),
                 pa.array(own + sums(np.where(tail, log, 0.0))), rare_words],
                ["doc_id", "n_tokens", "n_known", "base", "own", "rare"],
            )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint, n_known bigint, base double, own double, rare array<string>"
    rows = docs.select("doc_id", "text").mapInArrow(run, schema)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    # Words beyond the listed ones are rare, so no key of this join is hot but one that no training text has.
    rare = rows.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    log = F.log(F.coalesce("n", F.lit(0)) + 1) * F.col("times")
    found = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(log).alias("rare_log"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    base = F.col("base") + zero("rare_log") - F.col("n_tokens") * float(np.log(model.tokens + model.distinct + 1.0))
    return rows.drop("rare").join(found, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + zero("rare_known")).alias("n_known"), F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (base / np.log(10)).alias("base_score"), ((F.col("own") + zero("rare_log")) / np.log(10)).alias("score"),
    )
