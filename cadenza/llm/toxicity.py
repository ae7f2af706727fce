"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the sum of an embedding of the word and those of its character n-grams over the root of their number, both
hashed, so that unseen forms of a known stem are recognised. Two recurrent layers read a window of words in either direction, attention
weighs their states, and a document's score is that of its most toxic window.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import in_batches, read, whole_row

WINDOW, STRIDE = 48, 36
#: Hash buckets of words and of n-grams, width of an input, width of a state.
WORDS, GRAMS, WIDTH, STATE = 1 << 14, 1 << 15, 16, 8
#: Bounds of the training sample: documents of either label, their characters, and windows of each by its label.
TOXIC, CLEAN, CHARS, WINDOWS = 600, 1800, 12_000, {1: 40, 0: 40}
#: At least so many passes over the sample and so many updates.
EPOCHS, UPDATES = 4, 120
#: Standard errors by which a feature must be commoner in toxic documents to start with an embedding.
SURE = 3.0
#: One labelled document in so many sets the bias; a clean one above the threshold weighs as much as FALSE toxic ones below.
CALIBRATION, FALSE = 5, 3.0
BATCH, RATE, SEED = 192, 0.01, 7
#: Windows of a clean document used in an epoch: those that look most toxic, and others at random.
HARD, EASY = 3, 2
#: Words and n-grams of fewer training documents keep their embedding of zero, like unseen ones.
SPREAD = 3
THRESHOLD = 0.7
#: Windows scored at once, and distinct words remembered in a task.
SCORED, KNOWN = 2048, 200_000
#: Letters of the longest word read as one, of the pieces of a longer one, and those shared by neighbours: more than an n-gram has.
LONGEST, PIECE, OVERLAP = 24, 12, 8
_WORD = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    """Words in order; a run of more than LONGEST letters, as in text without blanks, is cut at underscores, and what is still
    longer gives overlapping pieces that cover it."""
    words = _WORD.findall((text or "").lower())
    if not words or max(map(len, words)) <= LONGEST:
        return words
    return [p for w in words for p in ([w] if len(w) <= LONGEST else _pieces(w))]


def _pieces(run: str) -> Iterator[str]:
    for w in filter(None, run.split("_")):
        if len(w) <= LONGEST:
            yield w
        else:
            yield from (w[i : i + PIECE] for i in range(0, len(w) - OVERLAP, PIECE - OVERLAP))


def window_starts(n: int) -> range:
    """Overlapping windows over n words, the last one perhaps shorter; one, empty, without words."""
    return range(0, max(n - (WINDOW - STRIDE), 1), STRIDE)


def hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each word; buckets of all their n-grams (three to five letters, ends marked) and where each's begin."""
    grams, starts = [], []
    for w in words:
        starts.append(len(grams))
        b = f"^{w}$".encode()
        grams += [crc32(b[i : i + k]) for k in (3, 4, 5) for i in range(max(1, len(b) - k + 1))]
    own = [crc32(w.encode()) for w in words]
    return np.asarray(own) % WORDS, np.asarray(grams) % GRAMS, np.asarray(starts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Network:
    """Weights by name: word and gram embeddings, input w, recurrent u and bias b of both directions, attention a, output o and c."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int = SEED) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        out = {"word": np.zeros((WORDS, WIDTH), np.float32), "gram": np.zeros((GRAMS, WIDTH), np.float32), "a": draw(2 * STATE), "o": draw(2 * STATE), "c": np.full(1, -2, np.float32)}
        for d in "fb":
            out |= {f"w{d}": draw(WIDTH, 3 * STATE), f"u{d}": draw(STATE, 3 * STATE), f"b{d}": np.zeros(3 * STATE, np.float32)}
        return cls(out)

    def inputs(self, words: list[str]) -> np.ndarray:
        own, grams, starts = hashed(words)
        sums = np.add.reduceat(self.weights["gram"][grams], starts, axis=0)
        counts = np.diff(np.append(starts, len(grams)))
        return self.weights["word"][own] + sums / np.sqrt(counts)[:, None].astype(np.float32)

    def projected(self, x: np.ndarray) -> np.ndarray:
        p = self.weights
        return np.concatenate([x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"]], axis=1)

    def _read(self, gates: np.ndarray, mask: np.ndarray, direction: str, keep: bool):
        """States (T, B, STATE) over gates (T, B, 3 STATE); with keep, what the way back needs as well."""
        u, s = self.weights[f"u{direction}"], STATE
        length, batch = mask.shape
        h = np.zeros((batch, s), np.float32)
        out, trace = np.empty((length, batch, s), np.float32), {}
        for t in range(length) if direction == "f" else range(length - 1, -1, -1):
            g, m = gates[t], h @ u
            zr = _sigmoid(g[:, : 2 * s] + m[:, : 2 * s])
            z, r = zr[:, :s], zr[:, s:]
            n = np.tanh(g[:, 2 * s :] + r * m[:, 2 * s :])
            new = n + z * (h - n)
            new *= mask[t][:, None]
            if keep:
                trace[t] = (h, z, r, n, m[:, 2 * s :])
            out[t] = h = new
        return out, trace

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Probabilities of windows: gates (T, B, 6 STATE), mask (T, B)."""
        p, s = self.weights, 3 * STATE
        hf, tf = self._read(gates[:, :, :s], mask, "f", keep)
        hb, tb = self._read(gates[:, :, s:], mask, "b", keep)
        h = np.concatenate([hf, hb], axis=2)
        score = np.where(mask > 0, h @ p["a"], np.float32(-1e9))
        weight = np.exp(score - score.max(axis=0))
        weight *= mask
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbs->bs", weight, h)
        prob = _sigmoid(pooled @ p["o"] + p["c"])
        return prob, (h, weight, pooled, tf, tb)

    def backward(self, gates: np.ndarray, mask: np.ndarray, kept: tuple, error: np.ndarray):
        """Gradients of the weights and of the gates; error is that of the logits."""
        h, weight, pooled, tf, tb = kept
        p, s = self.weights, STATE
        grad = {"c": np.asarray([error.sum()]), "o": pooled.T @ error}
        d_pooled = error[:, None] * p["o"]
        d_weight = np.einsum("bs,tbs->tb", d_pooled, h)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["a"] = np.einsum("tb,tbs->s", d_score, h)
        d_h = weight[:, :, None] * d_pooled + d_score[:, :, None] * p["a"]
        d_gates = np.empty_like(gates)
        for direction, trace, part, at in (("f", tf, slice(0, s), 0), ("b", tb, slice(s, 2 * s), 3 * s)):
            u = p[f"u{direction}"]
            d_u, back = np.zeros_like(u), np.zeros_like(d_h[0, :, part])
            steps = range(len(mask))
            for t in reversed(steps) if direction == "f" else steps:
                before, z, r, n, m = trace[t]
                d = (d_h[t, :, part] + back) * mask[t][:, None]
                d_n = d * (1 - z) * (1 - n * n)
                d_r = d_n * m * r * (1 - r)
                d_z = d * (before - n) * z * (1 - z)
                d_m = np.concatenate([d_z, d_r, d_n * r], axis=1)
                d_gates[t, :, at : at + 3 * s] = np.concatenate([d_z, d_r, d_n], axis=1)
                back = d * z + d_m @ u.T
                d_u += before.T @ d_m
            grad[f"u{direction}"] = d_u
        return grad, d_gates


def _pad(rows: list[np.ndarray], none: int) -> tuple[np.ndarray, np.ndarray]:
    """(T, B) places of words, none beyond a window's end, and the mask."""
    at = np.full((len(rows), WINDOW), none, np.int64)
    for i, r in enumerate(rows):
        at[i, : len(r)] = r
    return np.ascontiguousarray(at.T), np.ascontiguousarray((at.T != none).astype(np.float32))


def train(texts: list[str], labels: list[int], seed: int = SEED) -> Network:
    """Adam on windows with their document's label, then a bias from documents that were not trained on.

    Features that are surely commoner in toxic documents start with that in their embedding. Of a toxic document the windows
    that look toxic count, by those features at first and by the network later; of a clean one the worst and some others.
    One document in CALIBRATION of either label is kept out, and the bias is set so that THRESHOLD parts those best.
    """
    place = {y: 0 for y in set(labels)}
    fitted, judged = [], []
    for i, y in enumerate(labels):
        place[y] += 1
        (fitted if place[y] % CALIBRATION else judged).append(i)
    net = _fit([texts[i] for i in fitted], [labels[i] for i in fitted], seed)
    found = np.asarray(list(Scorer(net)([texts[i] for i in judged])), np.float64)
    truth = np.asarray([labels[i] for i in judged], bool)
    if truth.any() and not truth.all():
        net.weights["c"] -= np.float32(_parting(_logit(found), truth) - _logit(np.float64(THRESHOLD)))
    return net


def _logit(x: np.ndarray) -> np.ndarray:
    return np.log(x + 1e-7) - np.log(1 - x + 1e-7)


def _parting(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the gap between scores that loses least: of toxic documents below it, and FALSE as much of clean ones above."""
    order = np.argsort(scores, kind="stable")
    s, t = scores[order], toxic[order]
    missed = np.append(0, np.cumsum(t)) / t.sum()
    wrong = np.append((~t).sum(), (~t).sum() - np.cumsum(~t)) / (~t).sum()
    edges = np.concatenate([[s[0] - 1], s, [s[-1] + 1]])
    loss = missed + FALSE * wrong
    best = np.flatnonzero(loss <= loss.min() + 1e-9)
    widest = best[np.argmax(np.diff(edges)[best])]
    return float((edges[widest] + edges[widest + 1]) / 2)


def _fit(texts: list[str], labels: list[int], seed: int) -> Network:
    rng, net = np.random.default_rng(seed), Network.new(seed)
    place: dict[str, int] = {}
    windows, owner = [], []
    for d, text in enumerate(texts):
        at = np.asarray([place.setdefault(w, len(place)) for w in tokens(text)], np.int64)
        starts = list(window_starts(len(at)))
        if len(starts) > WINDOWS[labels[d]]:
            starts = sorted(rng.choice(starts, WINDOWS[labels[d]], replace=False).tolist())
        for s in starts:
            if len(at[s : s + WINDOW]):
                windows.append(at[s : s + WINDOW])
                owner.append(d)
    if not windows:
        return net
    owner, y = np.asarray(owner), np.asarray(labels, np.float32)[np.asarray(owner)]
    words = list(place)
    own, grams, starts = hashed(words)
    counts = np.diff(np.append(starts, len(grams)))
    scale = (1 / np.sqrt(counts)).astype(np.float32)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
    none = len(words)
    groups = np.split(np.arange(len(windows)), np.flatnonzero(np.diff(owner)) + 1)
    in_docs = [np.unique(np.concatenate([windows[i] for i in g])) for g in groups]
    word_docs, gram_docs = np.zeros(WORDS, np.int32), np.zeros(GRAMS, np.int32)
    for ids in in_docs:
        word_docs[np.unique(own[ids])] += 1
        gram_docs[np.unique(grams[_spans(starts, counts, ids)])] += 1
    word_known, gram_known = (word_docs >= SPREAD).astype(np.float32), (gram_docs >= SPREAD).astype(np.float32)
    toxic = np.asarray([y[g[0]] for g in groups]) == 1
    word_z = _excess([own[i] for i in in_docs], toxic, WORDS)
    gram_z = _excess([grams[_spans(starts, counts, i)] for i in in_docs], toxic, GRAMS)
    net.weights["word"][:, 0], net.weights["gram"][:, 1] = word_z, gram_z
    told = word_z[own] + np.add.reduceat(gram_z[grams], starts) * scale
    probs = np.asarray([max(0.0, told[w].max()) for w in windows], np.float32)
    hinted, epoch, step = probs, 0, 0
    while epoch < EPOCHS or step < UPDATES:
        if epoch:
            probs = _probabilities(net, words, windows)
        use = np.zeros(len(windows), bool)
        for mine, is_toxic in zip(groups, toxic, strict=True):
            own_probs = probs[mine]
            if is_toxic:  # a document without any of those features teaches nothing
                use[mine[own_probs >= 0.9 * own_probs.max()] if hinted[mine].max() > 0 else []] = True
            else:
                use[mine[np.argsort(-own_probs, kind="stable")[:HARD]]] = True
                use[rng.choice(mine, min(EASY, len(mine)), replace=False)] = True
        epoch += 1
        order = rng.permutation(np.flatnonzero(use))
        positive = max(1.0, min(2.0, (y[order] == 0).sum() / 2 / max(1, (y[order] == 1).sum())))
        for k in range(0, len(order), BATCH):
            pick = order[k : k + BATCH]
            at, mask = _pad([windows[i] for i in pick], none)
            seen, inverse = np.unique(at, return_inverse=True)
            inverse = inverse.reshape(at.shape)
            seen = seen[seen != none]
            x = net.weights["word"][own[seen]] + _sum_grams(net.weights["gram"], grams, starts, counts, seen) * scale[seen, None]
            gates = np.concatenate([net.projected(x), np.zeros((1, 6 * STATE), np.float32)])[inverse]
            prob, kept = net.forward(gates, mask, keep=True)
            grad, d_gates = net.backward(gates, mask, kept, (prob - y[pick]) * np.where(y[pick] == 1, np.float32(positive), np.float32(1)) / len(pick))
            flat = np.zeros((len(seen) + 1, 6 * STATE), np.float32)
            np.add.at(flat, inverse.ravel(), d_gates.reshape(-1, 6 * STATE))
            flat = flat[: len(seen)]
            d_x = np.zeros_like(x)
            for d, part in (("f", flat[:, : 3 * STATE]), ("b", flat[:, 3 * STATE :])):
                grad[f"w{d}"], grad[f"b{d}"] = x.T @ part, part.sum(axis=0)
                d_x += part @ net.weights[f"w{d}"].T
            step += 1
            for name, g in grad.items():
                _adam(net.weights[name], moments[name], g, step)
            _adagrad(net.weights["word"], moments["word"][1], own[seen], d_x * word_known[own[seen], None])
            flat_grams = grams[_spans(starts, counts, seen)]
            of_gram = np.repeat(np.arange(len(seen)), counts[seen])
            d_gram = (d_x * scale[seen, None])[of_gram] * gram_known[flat_grams, None]
            _adagrad(net.weights["gram"], moments["gram"][1], flat_grams, d_gram)
    return net


def _excess(docs: list[np.ndarray], toxic: np.ndarray, size: int) -> np.ndarray:
    """By how many standard errors beyond SURE each feature's share of toxic documents exceeds that of clean ones."""
    hits = np.zeros((2, size))
    for ids, label in zip(docs, toxic, strict=True):
        hits[int(label), np.unique(ids)] += 1
    n = np.maximum(np.asarray([(~toxic).sum(), toxic.sum()]), 1)
    share, both = hits / n[:, None], hits.sum(axis=0) / n.sum()
    z = (share[1] - share[0]) / np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / n).sum())
    return np.clip((z - SURE) / SURE, 0, 3).astype(np.float32)


def _probabilities(net: Network, words: list[str], windows: list[np.ndarray]) -> np.ndarray:
    table = np.concatenate([net.projected(net.inputs(words)), np.zeros((1, 6 * STATE), np.float32)])
    parts = (_pad(windows[k : k + SCORED], len(words)) for k in range(0, len(windows), SCORED))
    return np.concatenate([net.forward(table[at], mask)[0] for at, mask in parts])


def _spans(starts: np.ndarray, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places of all n-grams of some words, one word after the other."""
    sizes = counts[words]
    return np.repeat(starts[words] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _sum_grams(table, grams, starts, counts, seen) -> np.ndarray:
    sizes = counts[seen]
    return np.add.reduceat(table[grams[_spans(starts, counts, seen)]], np.cumsum(sizes) - sizes, axis=0)


def _adam(w: np.ndarray, moments: tuple, g: np.ndarray, step: int) -> None:
    m, v = moments
    m += 0.1 * (g - m)
    v += 0.001 * (g * g - v)
    w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def _adagrad(w: np.ndarray, total: np.ndarray, rows: np.ndarray, g: np.ndarray) -> None:
    some, inverse = np.unique(rows, return_inverse=True)
    sums = np.zeros((len(some), w.shape[1]), np.float32)
    np.add.at(sums, inverse, g)
    total[some] += sums * sums
    w[some] -= 0.05 * sums / (np.sqrt(total[some]) + 1e-6)


class Scorer:
    """Scores of whole texts; remembers the projected inputs of words."""

    def __init__(self, net: Network) -> None:
        self.net, self.place, self.table = net, {}, np.zeros((1, 6 * STATE), np.float32)

    def _places(self, texts: list[list[str]]) -> list[np.ndarray]:
        new = [w for w in dict.fromkeys(w for t in texts for w in t) if w not in self.place]
        if len(self.place) + len(new) > KNOWN:
            self.place, self.table = {}, self.table[:1]
            new = list(dict.fromkeys(w for t in texts for w in t))
        if new:
            self.place.update(zip(new, range(len(self.place) + 1, len(self.place) + len(new) + 1), strict=True))
            parts = [self.net.projected(self.net.inputs(new[i : i + 8192])) for i in range(0, len(new), 8192)]
            self.table = np.concatenate([self.table, *parts])
        return [np.fromiter(map(self.place.__getitem__, t), np.int64, len(t)) for t in texts]

    def __call__(self, texts: list[str | None]) -> Iterator[float]:
        """A text's score is that of its most toxic window; without words 0."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(tokens(text))
            size += len(held[-1])
            if size > SCORED * STRIDE:
                yield from self._some(held)
                held, size = [], 0
        if held:
            yield from self._some(held)

    def _some(self, texts: list[list[str]]) -> list[float]:
        windows, owner = [], []
        for i, at in enumerate(self._places(texts)):
            for s in window_starts(len(at)) if len(at) else ():
                windows.append(at[s : s + WINDOW])
                owner.append(i)
        out = np.zeros(len(texts))
        for k in range(0, len(windows), SCORED):
            at, mask = _pad(windows[k : k + SCORED], 0)
            prob, _ = self.net.forward(self.table[at], mask)
            np.maximum.at(out, np.asarray(owner[k : k + SCORED]), prob.astype(np.float64))
        return out.tolist()


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(place, doc_id, text, toxic): a hash sample of at most TOXIC and CLEAN labelled documents that have a text.

    They have up to CHARS characters, as a part of a longer one need not show what its label says; only where a label has no
    such document, CHARS characters of longer ones are taken, from a hashed place on.
    """
    size = F.length("text")
    usable = docs.select("doc_id", size.alias("size")).where("size > 0").join(labels.select("doc_id", "toxic"), "doc_id")
    chosen = None
    for label, most in ((1, TOXIC), (0, CLEAN)):
        some = usable.where(F.col("toxic") == label)
        short = some.where(F.col("size") <= CHARS)
        some = (some if short.isEmpty() else short).select("doc_id", "toxic", (F.col("size") <= CHARS).alias("short"))
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = some if chosen is None else chosen.unionByName(some)
    place = F.xxhash64("doc_id")
    start = F.pmod(place, F.greatest(size - CHARS + 1, F.lit(1))).cast("int") + 1
    return (
        docs.select("doc_id", "text")
        .where(size > 0)
        .join(F.broadcast(chosen.distinct()), "doc_id")
        .where((size <= CHARS) | ~F.col("short"))
        .select(place.alias("place"), "doc_id", F.col("text").substr(start, F.lit(CHARS)).alias("text"), "toxic")
        .orderBy("place", "doc_id", "text")
        .limit(TOXIC + CLEAN)
    )


def learn(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Trained on training_rows in one task of an executor; None without documents of both labels."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["place"], r["doc_id"], r["text"], r["toxic"]) for b in batches for r in b.to_pylist())
        if len({r[3] for r in rows}) == 2:
            net = train([r[2] for r in rows], [r[3] for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net.weights)], pa.binary())], names=["weights"])

    found = training_rows(docs, labels).mapInArrow(fit, "weights binary").collect()  # one task: the sample is bounded
    return Network(pickle.loads(found[0]["weights"])) if found else None


def toxicity_scores(docs: DataFrame, net: Network | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) for each row of docs.

    score, from 0 to 1, is that of the most toxic of all overlapping windows of the whole text; texts that are null or have
    no words, and all texts without a network, score 0. predicted is 1 from THRESHOLD. Repeated rows are scored each.
    An empty table gives none. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        scorer = Scorer(net) if net else None
        for b in batches:
            scores = list(scorer(b["text"])) if scorer else [0.0] * len(b["text"])
            yield {"doc_id": b["doc_id"], "score": scores, "predicted": [int(s >= THRESHOLD) for s in scores]}

    return in_batches(rows, work, f"doc_id {kind}, score double, predicted int")


def _held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    net = learn(docs, read(spark, sf_dir, "labels").where(~_held_out()))
    found = toxicity_scores(docs, net)
    return found.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def toxicity_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows predicted toxic go; each is judged by its own text."""
    net = learn(docs, read(spark, sf_dir, "labels").where(~_held_out()))
    if net is None:
        return docs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for b in batches:
            texts = b.column("row").field("text").to_pylist()
            yield b.filter(pa.array([s < THRESHOLD for s in scorer(texts)], pa.bool_()))

    rows = docs.select(whole_row(docs))
    return rows.mapInArrow(work, rows.schema).select("row.*")
