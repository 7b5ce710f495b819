"""Score texts for toxicity with a bidirectional gated recurrent network and attention pooling.

A word enters the network as its own embedding, if the fitted rows hold it often enough, beside
the sum of embeddings of its character n-grams (3 to 5 bytes, with marks at both ends). Windows of
``WINDOW`` words, each ``OVERLAP`` words into its predecessor, cover the whole text; every window
gets a logit from the network's attention-pooled states, and a logistic model over the two largest logits
gives the text's score, so the length of a text is no feature. Both are fitted in numpy on the driver, on a bounded
sample of labelled rows: at most ``SAMPLE`` rows of each class, by the order of a hash of their ids, with their whole
texts and all windows. The first ``WARM`` epochs give each window its text's label, a text's windows weighing as
much as one; after them a toxic text is learned by its best window only, and a clean one by its best and another.
Classes are weighed back to their shares among all labelled rows.

Equal texts score equal, whatever else is scored with them: matrix products are exact sums of rounded numbers, and other
sums run in an order that depends on the text alone.

Nulls: a NULL text counts as empty. An empty text has no window; its score comes from the
network's bias alone. Labels other than 0 and 1 are left out; of a repeated id the largest label
counts, and its first row by place is fitted on. Without labelled rows of both classes every text scores the share of toxic
labels (0 without labels). Repeated rows score alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmart.llm.common import PLACE, placed, text_of

WINDOW = 96
OVERLAP = 24
SAMPLE = 3000
#: Epochs in which all windows carry their text's label.
WARM = 2
HIDDEN = 8
WIDTH = 8
GRAM_BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
WORDS = 8000
EPOCHS = 7
BATCH = 256
#: A small sample is gone through more often, in smaller batches.
LEAST_STEPS = 240
CHUNK = 1024
#: Both sides of matrix products are rounded to multiples of 1 / GRID; windows are filled up to a multiple of ROWS.
GRID = 1 << 20
ROWS = 8
CACHE_WORDS = 150_000
PROJECTED = 16_384


def tokens(text: str) -> list[bytes]:
    return text.lower().encode().split()


def windows(count: int, size: int = WINDOW, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Bounds of the windows over ``count`` words; the last one ends with the text."""
    starts = range(0, max(1, count - overlap), size - overlap) if count else ()
    return [(at, min(at + size, count)) for at in starts]


def grams(words: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the n-grams' buckets in the order of words, and their number in each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    text = np.frombuffer(b"".join(b"\x02" + word + b"\x03" for word in words), np.uint8).astype(np.uint32)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(text))
    for n in GRAMS:
        count = max(0, len(text) - n + 1)
        mixed = np.zeros(count, np.uint32)
        for k in range(n):
            mixed = (mixed ^ text[k : k + count]) * np.uint32(0x01000193)
        mixed ^= mixed >> np.uint32(15)
        whole = left[: len(mixed)] >= n
        yield (mixed[whole] % GRAM_BUCKETS).astype(np.int32), np.maximum(lengths - n + 1, 0)


def _sums(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows, ``counts`` of them each; a sum depends on its own rows only."""
    out = np.zeros((len(counts), rows.shape[1]), np.float32)
    some = np.flatnonzero(counts)
    if len(some):
        out[some] = np.add.reduceat(rows, (np.cumsum(counts) - counts)[some], axis=0)
    return out


def _times(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Matrix product of both sides rounded to multiples of 1 / ``GRID``.

    Products and sums of such numbers are exact in 8-byte floats (to 2^13 in magnitude), so a row's
    result depends on no order of summation, and on no other row.
    """
    return ((np.rint(rows * GRID, dtype=np.float64) @ np.rint(weights * GRID, dtype=np.float64)) / GRID**2).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """The recurrent network over rows of word inputs."""

    def __init__(self, vocabulary: Sequence[bytes], seed: int = 7):
        draw = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        self.ids = {word: at + 1 for at, word in enumerate(vocabulary)}
        h, d = HIDDEN, 2 * WIDTH
        self.p = {
            "word": normal(len(self.ids) + 1, WIDTH, scale=0.1),
            "gram": normal(GRAM_BUCKETS, WIDTH, scale=0.1),
            "in": normal(d, 6 * h, scale=d**-0.5),
            "in_bias": np.zeros(6 * h, np.float32),
            "forward": normal(h, 3 * h, scale=h**-0.5),
            "backward": normal(h, 3 * h, scale=h**-0.5),
            "attend": normal(2 * h, h, scale=(2 * h) ** -0.5),
            "attend_bias": np.zeros(h, np.float32),
            "query": normal(h, scale=h**-0.5),
            "out": normal(2 * h, scale=(2 * h) ** -0.5),
            "out_bias": np.zeros(1, np.float32),
        }
        self.p["word"][0] = 0

    def inputs(self, words: Sequence[bytes]) -> np.ndarray:
        """Input vector of each word."""
        own = self.p["word"][[self.ids.get(word, 0) for word in words]]
        total, count = np.zeros((len(words), WIDTH), np.float32), np.zeros(len(words))
        for buckets, counts in grams(words):
            total += _sums(self.p["gram"][buckets], counts)
            count += counts
        return np.concatenate([own, total / np.sqrt(np.maximum(count, 1))[:, None]], axis=1, dtype=np.float32)

    def projected(self, words: Sequence[bytes]) -> np.ndarray:
        """Input of each word to the gates of both directions; some words at a time, to save memory."""
        out = np.zeros((len(words), 6 * HIDDEN), np.float32)
        for at in range(0, len(words), PROJECTED):
            out[at : at + PROJECTED] = _times(self.inputs(words[at : at + PROJECTED]), self.p["in"]) + self.p["in_bias"]
        return out

    @staticmethod
    def _step(x: np.ndarray, h: np.ndarray, weights: np.ndarray, times: Callable = np.matmul) -> tuple[np.ndarray, ...]:
        size = h.shape[1]
        g = times(h, weights)
        zr = 1 / (1 + np.exp(-(x[:, : 2 * size] + g[:, : 2 * size])))
        z, r = zr[:, :size], zr[:, size:]
        n = np.tanh(x[:, 2 * size :] + r * g[:, 2 * size :])
        return n + z * (h - n), z, r, n, g[:, 2 * size :]

    def logits(self, table: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Logit of each window; ``at`` (window, step) are rows of ``table``, windows longest first."""
        wanted = len(at)
        if short := -wanted % ROWS:
            at = np.concatenate([at, np.zeros((short, at.shape[1]), at.dtype)])
            lengths = np.concatenate([lengths, np.zeros(short, lengths.dtype)])
        count, steps = at.shape
        h = HIDDEN
        states = np.zeros((steps, count, 2 * h), np.float32)
        active = np.searchsorted(-lengths, -np.arange(steps), "left")
        state = np.zeros((count, h), np.float32)
        for t in range(steps):
            k = active[t]
            state[:k] = self._step(table[at[:k, t], : 3 * h], state[:k], self.p["forward"], _times)[0]
            states[t, :k, :h] = state[:k]
        state = np.zeros((count, h), np.float32)
        for t in reversed(range(steps)):
            k = active[t]
            state[:k] = self._step(table[at[:k, t], 3 * h :], state[:k], self.p["backward"], _times)[0]
            states[t, :k, h:] = state[:k]
        mid = np.tanh(_times(states.reshape(-1, 2 * h), self.p["attend"]) + self.p["attend_bias"])
        weight = (mid * self.p["query"]).sum(axis=1).reshape(steps, count)
        inside = np.arange(steps)[:, None] < lengths[None, :]
        weight = np.where(inside, weight, np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0)) * inside
        total, pooled = np.zeros(count, np.float32), np.zeros((count, 2 * h), np.float32)
        for t in range(steps):
            total += weight[t]
            pooled += weight[t][:, None] * states[t]
        pooled /= np.maximum(total, np.float32(1e-9))[:, None]
        return (pooled * self.p["out"]).sum(axis=1)[:wanted] + self.p["out_bias"][0]

    def gradients(self, x: np.ndarray, lengths: np.ndarray, truth: np.ndarray, rate: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weighted log loss, and of the projected inputs ``x`` (step, window, 6h)."""
        p, h = self.p, HIDDEN
        steps, count = x.shape[:2]
        inside = (np.arange(steps)[:, None] < lengths[None, :]).astype(np.float32)
        states, kept = np.zeros((steps, count, 2 * h), np.float32), {}
        for name, part, order in (("forward", 0, range(steps)), ("backward", 1, range(steps - 1, -1, -1))):
            state = np.zeros((count, h), np.float32)
            for t in order:
                new, z, r, n, g = self._step(x[t, :, part * 3 * h : (part + 1) * 3 * h], state, p[name])
                kept[name, t] = state, z, r, n, g
                state = np.where(inside[t][:, None] > 0, new, state)
                states[t, :, part * h : (part + 1) * h] = state * inside[t][:, None]
        mid = np.tanh(states @ p["attend"] + p["attend_bias"])
        weight = np.where(inside > 0, mid @ p["query"], -1e9)
        weight = np.exp(weight - weight.max(axis=0)) * inside
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbd->bd", weight, states)
        logit = pooled @ p["out"] + p["out_bias"][0]

        d_logit = ((sigmoid(logit) - truth) * rate / rate.sum()).astype(np.float32)
        out = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = np.einsum("bd,tbd->tb", d_pooled, states)
        d_states = weight[:, :, None] * d_pooled[None]
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        out["query"] = np.einsum("tb,tbd->d", d_score, mid)
        d_mid = d_score[:, :, None] * p["query"] * (1 - mid**2)
        out["attend"] = np.einsum("tbi,tbj->ij", states, d_mid)
        out["attend_bias"] = d_mid.sum(axis=(0, 1))
        d_states += d_mid @ p["attend"].T
        d_x = np.zeros_like(x)
        for name, part, order in (("forward", 0, range(steps - 1, -1, -1)), ("backward", 1, range(steps))):
            carry, total = np.zeros((count, h), np.float32), np.zeros_like(p[name])
            for t in order:
                own = inside[t][:, None]
                d = (carry + d_states[t, :, part * h : (part + 1) * h]) * own
                state, z, r, n, g = kept[name, t]
                d_n = d * (1 - z) * (1 - n**2)
                d_z = d * (state - n) * z * (1 - z)
                d_r = d_n * g * r * (1 - r)
                d_g = np.concatenate([d_z, d_r, d_n * r], axis=1)
                d_x[t, :, part * 3 * h : (part + 1) * 3 * h] = np.concatenate([d_z, d_r, d_n], axis=1)
                total += state.T @ d_g
                carry = d * z + d_g @ p[name].T + carry * (1 - own)
            out[name] = total
        return out, d_x


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            scale = self.rate * (1 - 0.99**self.t) ** 0.5 / (1 - 0.9**self.t)
            params[k] -= (scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)


class Bags:
    """Windows of the fitted texts as numbers of their distinct words."""

    def __init__(self, texts: Iterable[Sequence[bytes]]):
        place: dict[bytes, int] = {}
        self.windows: list[np.ndarray] = []
        owner: list[int] = []
        self.held: dict[bytes, int] = {}
        count = 0
        for at, words in enumerate(texts):
            count += 1
            row = np.fromiter((place.setdefault(word, len(place)) for word in words), np.int32, len(words))
            for word in set(words):
                self.held[word] = self.held.get(word, 0) + 1
            for a, b in windows(len(words)):
                self.windows.append(row[a:b])
                owner.append(at)
        self.words = list(place)
        self.owner = np.array(owner, np.int64)
        self.size = np.bincount(self.owner, minlength=count)

    def common(self) -> list[bytes]:
        return sorted((word for word, n in self.held.items() if n >= 3), key=lambda word: (-self.held[word], word))[:WORDS]

    def logits(self, net: Network) -> np.ndarray:
        return _logits(net, net.projected(self.words), self.windows)


def _logits(net: Network, table: np.ndarray, flat: Sequence[np.ndarray]) -> np.ndarray:
    """Logit of each window, a row of numbers of rows of ``table``."""
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    order = np.argsort(-lengths, kind="stable")
    out = np.empty(len(flat))
    for start in range(0, len(order), CHUNK):
        some = order[start : start + CHUNK]
        at = np.zeros((len(some), lengths[some[0]]), np.int64)
        for i, w in enumerate(some):
            at[i, : lengths[w]] = flat[w]
        out[some] = net.logits(table, at, lengths[some])
    return out


def _best(logits: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The window with the largest logit of each text that has one."""
    order = np.lexsort((logits, owner))
    return order[np.flatnonzero(np.append(np.diff(owner[order]) > 0, True))] if len(order) else order


def fit_network(texts: Iterable[Sequence[bytes]], toxic: np.ndarray, rate: np.ndarray, epochs: int, seed: int = 7) -> Network:
    """Fit on all windows of the texts; in the end a toxic text's best window carries its label. ``rate`` weighs the texts."""
    bags = Bags(texts)
    net = Network(bags.common(), seed)
    own = np.array([net.ids.get(word, 0) for word in bags.words], np.int64)
    parts = list(grams(bags.words)) if bags.words else []
    ends = [np.cumsum(counts) for _, counts in parts]
    total = np.maximum(sum(counts for _, counts in parts), 1) if parts else np.ones(0)
    draw = np.random.default_rng(seed)
    every = np.arange(len(bags.owner))
    adam = Adam(net.p, 0.01)
    batch = min(BATCH, max(32, len(toxic) // 12))
    epochs = max(epochs, -(-LEAST_STEPS * batch // max(1, len(toxic)))) if batch < BATCH else epochs
    warm = max(1, min(WARM * epochs // EPOCHS, epochs))
    for epoch in range(epochs):
        adam.rate = 0.01 * (1 - epoch / epochs) + 0.001
        weight = rate[bags.owner] / bags.size[bags.owner]
        rows = every
        if epoch >= warm:
            best = _best(bags.logits(net), bags.owner)
            more = every[draw.random(len(every)) * bags.size[bags.owner] < 1]
            rows = np.union1d(best, more[toxic[bags.owner[more]] == 0])
            weight = rate[bags.owner]
        order = draw.permutation(rows)
        for start in range(0, len(order), batch):
            some = order[start : start + batch]
            lengths = np.array([len(bags.windows[w]) for w in some])
            at = np.zeros((len(some), lengths.max()), np.int64)
            for i, w in enumerate(some):
                at[i, : lengths[i]] = bags.windows[w]
            used, where = np.unique(at, return_inverse=True)
            where = where.reshape(at.shape)
            pieces = []
            vectors = np.zeros((len(used), 2 * WIDTH), np.float32)
            vectors[:, :WIDTH] = net.p["word"][own[used]]
            for (buckets, counts), end in zip(parts, ends, strict=True):
                n = counts[used]
                spots = np.repeat(end[used] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pieces.append((buckets[spots], np.repeat(np.arange(len(used)), n)))
                vectors[:, WIDTH:] += _sums(net.p["gram"][buckets[spots]], n)
            scale = (1 / np.sqrt(total[used])).astype(np.float32)[:, None]
            vectors[:, WIDTH:] *= scale
            table = vectors @ net.p["in"] + net.p["in_bias"]
            grads, d_x = net.gradients(table[where.T], lengths, toxic[bags.owner[some]], weight[some])
            flat, spot = d_x.reshape(-1, d_x.shape[2]), where.T.ravel()
            by = np.argsort(spot, kind="stable")
            d_table = _sums(flat[by], np.bincount(spot, minlength=len(used)))
            grads["in"], grads["in_bias"] = vectors.T @ d_table, d_table.sum(axis=0)
            d_vectors = d_table @ net.p["in"].T
            grads["word"] = np.zeros_like(net.p["word"])
            np.add.at(grads["word"], own[used], d_vectors[:, :WIDTH])
            grads["word"][0] = 0
            d_gram = d_vectors[:, WIDTH:] * scale
            grads["gram"] = np.zeros_like(net.p["gram"])
            for buckets, word in pieces:
                np.add.at(grads["gram"], buckets, d_gram[word])
            adam.step(net.p, grads)
    return net


class Scorer:
    """Logits of all windows of texts; keeps the inputs of the words it has met, up to ``CACHE_WORDS``."""

    def __init__(self, net: Network):
        self.net, self.ids, self.table = net, {}, np.zeros((0, 6 * HIDDEN), np.float32)

    def logits(self, texts: Sequence[Sequence[bytes]]) -> list[np.ndarray]:
        if len(self.ids) > CACHE_WORDS:
            self.ids, self.table = {}, self.table[:0]
        ids = self.ids
        known = len(ids)
        rows = [np.fromiter((ids.setdefault(word, len(ids)) for word in words), np.int64, len(words)) for words in texts]
        if len(ids) > known:
            fresh = list(ids)[known:]
            self.table = np.concatenate([self.table, self.net.projected(fresh)])
        bounds = [windows(len(row)) for row in rows]
        out = _logits(self.net, self.table, [row[a:b] for row, own in zip(rows, bounds, strict=True) for a, b in own])
        ends = np.cumsum([len(own) for own in bounds])
        bias = np.array([float(self.net.p["out_bias"][0])])
        return [out[end - len(own) : end] if own else bias for own, end in zip(bounds, ends, strict=True)]


def features(logits: np.ndarray) -> list[float]:
    """What the final model sees of a text's window logits: the two largest."""
    top = np.sort(np.clip(logits, -12, 12))[::-1]
    return [1.0, top[0], top[min(1, len(top) - 1)]]


def fit_logistic(x: np.ndarray, truth: np.ndarray, rate: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    hold = np.full(x.shape[1], ridge)
    hold[0] = 1e-6
    for _ in range(50):
        p = sigmoid(x @ w)
        slope = x.T @ (rate * (p - truth)) + hold * w
        curve = (x * (rate * p * (1 - p))[:, None]).T @ x + np.diag(hold + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, net: Network | None, weights: np.ndarray | None, share: float):
        self.net, self.weights, self.share = net, weights, share

    def scorer(self):
        if self.net is None:
            return lambda texts: np.full(len(texts), self.share)
        inner = Scorer(self.net)
        return lambda texts: sigmoid((np.array([features(own) for own in inner.logits(texts)]).reshape(-1, 3) * self.weights).sum(axis=1))


def fit(texts: Sequence[str], toxic: Sequence[int], share: float, epochs: int = EPOCHS) -> Model:
    """Fit on texts with labels, of which a share ``share`` is toxic among all labelled rows.

    The network learns from four texts in five and the final model from the fifth, so the latter
    sees logits as they are on new texts.
    """
    truth = np.array(toxic, np.float64)
    if not 0 < truth.sum() < len(truth):
        return Model(None, None, share)
    rate = np.where(truth == 1, share / truth.mean(), (1 - share) / (1 - truth.mean()))
    last = np.zeros(len(texts), bool)
    for label in (0, 1):
        last[np.flatnonzero(truth == label)[::5]] = True
    if truth[last].sum() in (0, last.sum()) or truth[~last].sum() in (0, (~last).sum()):
        last[:] = True
        first = last
    else:
        first = ~last
    some = np.flatnonzero(first)
    net = fit_network((tokens(texts[i]) for i in some), truth[some].astype(np.float32), np.sqrt(rate[some]).astype(np.float32), epochs)
    rest = np.flatnonzero(last)
    scorer = Scorer(net)
    x = np.array([features(scorer.logits([tokens(texts[i])])[0]) for i in rest])
    return Model(net, fit_logistic(x, truth[rest], rate[rest]), share)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> Model:
    """Fit a model on labelled rows of ``docs`` that are not held out, at most ``sample`` of each class."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    drawn = F.xxhash64("doc_id")
    classes = [known.filter(F.col("toxic") == label).orderBy(drawn, "doc_id").limit(sample) for label in (0, 1)]
    rows = classes[0].unionByName(classes[1]).select(F.col("doc_id").alias("_id"), "toxic")
    texts = placed(docs, F.col("doc_id").cast("long").alias("_doc"), text_of().alias("_text"))
    # At most 2 * sample pairs of numbers are broadcast, and one text for each comes back.
    found = texts.join(F.broadcast(rows), F.col("_doc") == F.col("_id"))
    first = found.groupBy("_doc", "toxic").agg(F.min_by("_text", F.struct(*PLACE)).alias("_text"))
    collected = sorted(first.select("_doc", "_text", "toxic").collect())
    return fit([row["_text"] for row in collected], [row["toxic"] for row in collected], share, epochs)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and place of each row of ``docs``; the model, of bounded size, goes along with the task's function."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = scorer([tokens(text) for text in part.column("_text").to_pylist()])
                columns = [part.column("doc_id"), *map(part.column, PLACE), pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *PLACE, "score"])

    rows = placed(docs, F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    return rows.mapInArrow(mapped, "doc_id long, _file string, _row long, score double")
