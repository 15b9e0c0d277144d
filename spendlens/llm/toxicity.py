"""Toxicity by subword bags averaged into a linear softmax, trained jointly in numpy.

A text is read in bags of a few words. The character n-grams of a bag's words,
with a blank as mark at both ends of a word, have vectors; their average goes
through a linear layer with two outputs and a softmax. Vectors and layer are
trained together. A misspelling never seen shares most n-grams with the word it
stands for.

Every character that is no letter, mark or digit parts words, in any script. A
bag holds few words and few n-grams, and a run without parting characters is cut
into overlapping pieces, so no bag grows with its text.

Labels are given per document while a few words make it toxic. So a document
scores as its most toxic bag, and training alternates: pick the worst bags of
each toxic document under the present model, then fit those against all bags of
the other documents. The length of a document does not thin out its score.

Averages and the layer are linear, so for scoring a vector boils down to one
number per n-gram: its part of the difference of the two outputs.
"""

from __future__ import annotations

import heapq
import unicodedata
import warnings
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import held_out, mixed, replacing

#: Bounds of the training sample: documents of either class, and bags of one, taken
#: from all over its text. Scores, in contrast, always read whole texts.
SAMPLE_DOCS = 2000
SAMPLE_BAGS = 128

#: Hash buckets of n-grams, length of their vectors, n-gram lengths.
BUCKETS = 1 << 18
DIM = 8
LENGTHS = (3, 4, 5, 6)

#: Words and n-grams in a bag; characters of a piece of a long run, and its overlap.
BAG_WORDS = 8
BAG_GRAMS = 320
RUN = 40
OVERLAP = max(LENGTHS)

#: Bags with fewer n-grams are filled up with zero vectors: a lone word decides less.
LEAST_GRAMS = 48

#: Starting value of the squared gradients: damps n-grams seen a few times only.
DAMPING = 1e-2
RATE = 1.0

#: A document is called toxic from this score on.
THRESHOLD = 0.7

#: Characters of text taken at a time.
_PART = 1 << 16


class _Letters(dict):
    """For each character its lower-case letter, itself if a mark or digit, else a blank."""

    def __missing__(self, code: int) -> int:
        char = chr(code)
        low = char.lower()
        self[code] = 32 if unicodedata.category(char)[0] not in "LMN" else ord(low) if len(low) == 1 else code
        return self[code]


_LETTERS = _Letters()

#: N-grams of a word with a blank at both ends, by its length.
_GRAMS = [sum(max(0, size + 3 - n) for n in LENGTHS) for size in range(RUN + 1)]


def words(text: str) -> Iterator[str]:
    """Words of a text in lower case, long runs in pieces; one said again at once counts once.

    Takes some characters at a time, so a long text is never held in another form.
    """
    carry, last = "", None
    for i in range(0, len(text), _PART):
        part = carry + text[i : i + _PART].translate(_LETTERS)
        found = part.split()
        # A word that may go on waits for the next part, but for its full pieces.
        carry = found.pop() if found and not part[-1].isspace() and i + _PART < len(text) else ""
        while len(carry) > RUN + OVERLAP:
            found.append(carry[:RUN])
            carry = carry[RUN - OVERLAP :]
        for word in found:
            if len(word) <= RUN:
                if word != last:
                    yield word
                last = word
                continue
            for j in range(0, len(word) - OVERLAP, RUN - OVERLAP):
                piece = word[j : j + RUN]
                if piece != last:
                    yield piece
                last = piece


def bags(text: str) -> Iterator[list[str]]:
    """The words of a text, bag by bag; a last bag of few words goes with the one before."""
    ready, bag, grams = None, [], 0
    for word in words(text):
        more = _GRAMS[len(word)]
        if bag and (len(bag) == BAG_WORDS or grams + more > BAG_GRAMS):
            if ready:
                yield ready
            ready, bag, grams = bag, [], 0
        bag.append(word)
        grams += more
    if ready and 2 * len(bag) < BAG_WORDS:
        yield ready + bag
    else:
        yield from filter(None, (ready, bag))


def hashed(parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of bags: the bucket and the bag of each."""
    sizes = np.array([len(b) for b in parts], np.int64)
    flat = f" {' '.join(w for b in parts for w in b)} "
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = codes == 32
    # A character belongs to the word that began before it.
    begins = blank & np.append(~blank[1:], False)
    bag_of_word = np.repeat(np.arange(len(parts)), sizes)
    word = np.cumsum(begins) - 1
    blanks = np.cumsum(blank)
    h = codes.astype(np.uint64)
    buckets, bag = [], []
    for n in range(2, max(LENGTHS) + 1):
        if len(codes) < n:
            break
        h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :].astype(np.uint64)
        if n not in LENGTHS:
            continue
        # No blank but at the ends.
        inside = blanks[n - 2 : len(codes) - 1] - blanks[: len(codes) - n + 1] == 0
        at = np.flatnonzero(inside)
        spot = mixed(h[at] ^ np.uint64(n)) >> np.uint64(65 - BUCKETS.bit_length())
        buckets.append(spot.astype(np.int32))
        bag.append(bag_of_word[word[at]].astype(np.int32))
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(buckets), np.concatenate(bag)


def in_parts(texts: Iterable[Iterable[list[str]]]) -> Iterator[tuple[list[list[str]], list[int]]]:
    """Bags of several texts in order, about ``_PART`` characters at a time, and each bag's text."""
    held, owner, size = [], [], 0
    for number, text in enumerate(texts):
        for bag in text:
            held.append(bag)
            owner.append(number)
            size += sum(map(len, bag))
            if size >= _PART:
                yield held, owner
                held, owner, size = [], [], 0
    if held:
        yield held, owner


def sorted_bags(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams' buckets bag by bag, where each bag starts, and the text of each bag."""
    buckets, sizes, of_text = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], []
    for part, owner in in_parts((bag.split() for bag in text) for text in texts):
        bucket, bag = hashed(part)
        buckets.append(bucket[np.argsort(bag, kind="stable")])
        sizes.append(np.bincount(bag, minlength=len(part)))
        of_text += owner
    start = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    return np.concatenate(buckets), start, np.array(of_text, np.int64)


@dataclass
class Model:
    """Per bucket its part of the logit, and the bias; without vectors a constant."""

    parts: np.ndarray | None
    bias: float

    def score(self, texts: Iterable[str]) -> np.ndarray:
        """Probability of label 1 for each text, that of its most toxic bag."""
        worst: list[float] = []

        def listed() -> Iterator[Iterator[list[str]]]:
            for text in texts:
                worst.append(-np.inf)
                yield bags(text)

        for part, owner in in_parts(listed()):
            if self.parts is None:
                continue
            bucket, bag = hashed(part)
            logit = self.bias + _means(self.parts[bucket], bag, len(part))
            for number, value in zip(owner, logit.tolist()):
                if value > worst[number]:
                    worst[number] = value
        logits = np.array(worst)
        logits = np.where(np.isfinite(logits), logits, self.bias)
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def _means(values: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
    count = np.maximum(np.bincount(bag, minlength=n), LEAST_GRAMS)
    return np.bincount(bag, weights=values, minlength=n) / count


def train(texts: list[list[str]], labels: list[int], rounds: int = 6, seed: int = 7) -> Model:
    """Fit vectors and layer on texts given by their bags, words parted by blanks.

    With one class only, or no texts, the model is a constant.
    """
    y = np.asarray(labels, np.int64)
    if len(set(labels)) < 2:
        return Model(None, 6.0 if len(labels) and y[0] == 1 else -6.0)
    bucket, start, text = sorted_bags(texts)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer = rng.uniform(-0.5, 0.5, (2, DIM)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_vectors, seen_layer, seen_bias = np.full(BUCKETS, DAMPING), 1e-6, 1e-6

    def fit(chosen: np.ndarray, target: np.ndarray) -> None:
        nonlocal vectors, layer, bias, seen_layer, seen_bias
        mix = rng.permutation(len(chosen))
        for i in range(0, len(mix), 256):
            part = chosen[mix[i : i + 256]]
            want = target[mix[i : i + 256]]
            length = start[part + 1] - start[part]
            inner = np.repeat(np.arange(len(part)), length)
            ids = bucket[np.repeat(start[part] - np.cumsum(length) + length, length)
                         + np.arange(length.sum())]
            mean = np.zeros((len(part), DIM), np.float32)
            if len(ids):
                filled = np.flatnonzero(length)
                edges = (np.cumsum(length) - length)[filled]
                mean[filled] = np.add.reduceat(vectors[ids], edges, axis=0)
                mean[filled] /= np.maximum(length[filled, None], LEAST_GRAMS)
            logit = mean @ layer.T + bias
            logit -= logit.max(axis=1, keepdims=True)
            p = np.exp(logit)
            p /= p.sum(axis=1, keepdims=True)
            gap = p[:, 1] - want
            direction = layer[1] - layer[0]
            # All n-grams of a bag share one gradient, a multiple of the layer's direction.
            unique, slot = np.unique(ids, return_inverse=True)
            pull = np.bincount(slot, weights=(gap / np.maximum(length, LEAST_GRAMS))[inner], minlength=len(unique))
            seen_vectors[unique] += pull * pull
            vectors[unique] -= (RATE * pull / np.sqrt(seen_vectors[unique]))[:, None] * direction
            slope = (gap[:, None] * mean).mean(axis=0)
            seen_layer += float(slope @ slope)
            step = 0.1 * slope / np.sqrt(seen_layer)
            layer = layer + np.stack([step, -step])
            level = float(gap.mean())
            seen_bias += level * level
            bias = bias + np.array([1, -1], np.float32) * (0.1 * level / np.sqrt(seen_bias))

    def present() -> Model:
        return Model(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))

    def bag_logits(model: Model) -> np.ndarray:
        found = []
        for a in range(0, len(text), 1 << 14):
            ends = start[a : a + (1 << 14) + 1]
            values = model.parts[bucket[ends[0] : ends[-1]]]
            bag = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            found.append(model.bias + _means(values, bag, len(ends) - 1))
        return np.concatenate(found)

    every, toxic = np.arange(len(text)), y[text] == 1
    fit(every, y[text])
    clean = every[~toxic]
    for _ in range(rounds if len(clean) and len(clean) < len(every) else 0):
        logit = bag_logits(present())
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, text[toxic], logit[toxic])
        # Of a toxic document the worst bag counts, and others the model is as sure about.
        sure = every[toxic & ((logit >= worst[text]) | (logit > 3))]
        chosen = np.concatenate([clean, np.repeat(sure, max(1, len(clean) // (4 * len(sure))))])
        fit(chosen, (y[text[chosen]] == 1).astype(np.int64))
    model = present()
    return Model(model.parts.astype(np.float32), model.bias)


def some_bags(text: str, most: int) -> list[str]:
    """Up to ``most`` bags from all over a text, chosen by the hash of their place."""
    held: list[tuple[int, int, str]] = []
    for i, bag in enumerate(bags(text)):
        place = int(mixed(np.array([i + 1], np.uint64))[0])
        if len(held) < most:
            heapq.heappush(held, (-place, i, " ".join(bag)))
        elif -held[0][0] > place:
            heapq.heapreplace(held, (-place, i, " ".join(bag)))
    return [bag for _, _, bag in sorted(held, key=lambda h: h[1])]


def _some_bags_udf(most: int):
    @F.arrow_udf("array<string>")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([some_bags(t.as_py() or "", most) for t in texts], pa.list_(pa.string()))

    return compute


def sample(
    docs: DataFrame, labels: DataFrame, docs_per_class: int, bags_per_doc: int = SAMPLE_BAGS,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> tuple[list[list[str]], list[int]]:
    """Bags and labels of up to ``docs_per_class`` labelled documents of either class.

    Ids are taken in the order of their hashes, whatever the length of a text; of each
    text up to ``bags_per_doc`` bags from all over it. That bounds what the driver holds
    to ``2 * docs_per_class * bags_per_doc`` bags. Rows without id or label are left out;
    an id that is labelled both ways is toxic; texts given twice count twice. Where
    one class is labelled but none of its documents is there, a warning says so.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).cast("bigint").alias("_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    )
    there = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    met = known.join(there.select("_id"), "_id")
    texts, found = [], []
    for label in (0, 1):
        ids = (
            met.where(F.col("_label") == label).select("_id").distinct()
            .orderBy(F.xxhash64("_id"), "_id").limit(docs_per_class)
        )
        chosen = [r["_id"] for r in ids.collect()]
        if not chosen:
            continue
        rows = (
            there.where(F.col("_id").isin(chosen))
            .select("_id", F.xxhash64("_text").alias("_hash"), _some_bags_udf(bags_per_doc)(F.col("_text")).alias("_bags"))
            .orderBy(F.xxhash64("_id"), "_id", "_hash").limit(docs_per_class).collect()
        )
        texts += [r["_bags"] for r in rows]
        found += [label] * len(rows)
    if len(set(found)) == 1:
        other = 1 - found[0]
        if not known.where(F.col("_label") == other).isEmpty():
            warnings.warn(f"no labelled document of class {other} is there to learn from", stacklevel=2)
    return texts, found


def _score_udf(model: Model):
    @F.arrow_udf("double")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.score(value.as_py() or "" for value in batch), pa.float64())

    return compute.asNondeterministic()


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """The model fitted on a bounded sample of the labelled rows that are not held out."""
    usable = labels.where(~held_out(id_col))
    return train(*sample(docs, usable, SAMPLE_DOCS, SAMPLE_BAGS, id_col, text_col, label_col))


def with_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` between 0 and 1, from the whole text alone.

    Null, empty and wordless texts get the score of the bias. Equal texts get
    equal scores and repeated rows stay. An existing ``score`` column is
    replaced, others are kept. Empty tables give no rows.
    """
    return replacing(docs, "score").withColumn("score", _score_udf(model)(F.col(text_col)))
