"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

A text is a sequence of lower-case words, one blank between them; whatever is no
letter or mark parts words. Features are its n-grams, hashed to buckets: the share of
a bucket among the text's n-grams, times its inverse document frequency. Frequencies
are counted over all documents that may be learnt from, whole texts.

Weights are fitted with follow-the-regularised-leader, one example at a time. Its
proximal step has an L1 and an L2 penalty, so most weights are exactly zero and no
step size needs tuning per n-gram. Examples are short passages from all over a
bounded sample of documents. A part of the sample is kept aside; the temperature
that divides all logits is the one with the least log loss there, which makes
scores probabilities.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import held_out, mixed, replacing

#: Bounds of the training sample: documents of all languages together, evenly, and
#: passages and characters of one. All else reads whole texts of all documents.
SAMPLE_DOCS = 2400
PASSAGES = 4
PASSAGE_CHARS = 200

#: One in so many sampled documents is kept aside for the temperature.
ASIDE = 5

BUCKETS = 1 << 17
LENGTHS = (1, 2, 3)

#: Follow-the-regularised-leader: step size and its smoothing, penalties, passes.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 0.05, 3

#: Brings the features of a passage to a length of about one.
SCALE = 10.0

#: Range of temperatures tried.
TEMPERATURES = (0.05, 20.0)

#: The prediction where there is no letter.
UNKNOWN = "und"

_BLANK = 32
#: Marks belong to words but are no letters.
_MARK = 1 << 31
#: Characters taken at a time.
_PART = 1 << 16


def alphabet() -> np.ndarray:
    """For each code point its lower-case letter, a flagged mark, or a blank."""
    table = np.full(sys.maxunicode + 1, _BLANK, np.uint32)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
        elif kind == "M":
            table[c] = c | _MARK
    return table


def pieces(text: str, table: np.ndarray) -> Iterator[np.ndarray]:
    """Code points of a text's words, one blank around each, some characters at a time.

    A piece but the first repeats the last ``max(LENGTHS) - 1`` of the one before.
    """
    tail = np.array([_BLANK], np.uint32)
    for i in range(0, max(1, len(text)), _PART):
        codes = table[np.frombuffer(text[i : i + _PART].encode("utf-32-le", "surrogatepass"), np.uint32)]
        if i + _PART >= len(text):
            codes = np.append(codes, np.uint32(_BLANK))
        blank = codes == _BLANK
        codes = codes[~(blank & np.append(tail[-1] == _BLANK, blank[:-1]))]
        piece = np.concatenate((tail, codes))
        if len(codes):
            yield piece
            tail = piece[1 - max(LENGTHS) :]


def buckets(parts: list[np.ndarray], again: np.ndarray) -> np.ndarray:
    """Bucket of the n-gram of each length that ends at each code point, BUCKETS for none.

    ``parts`` are pieces of texts; the first ``again`` code points of a piece were
    counted before. N-grams have no blank but at their ends, so none spans two texts.
    """
    codes = np.concatenate(parts)
    blank = codes == _BLANK
    codes = codes.astype(np.uint64)
    old = np.zeros(len(codes), bool)
    start = np.cumsum([0, *map(len, parts[:-1])])
    for i in range(max(LENGTHS) - 1):
        old[start[again > i] + i] = True
    found = np.full((len(LENGTHS), len(codes)), BUCKETS, np.int32)
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        if len(codes) < n:
            break
        # h[e] is the hash of the n code points from e on.
        h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        if n not in LENGTHS:
            continue
        bad = old[n - 1 :].copy()
        if n <= 2:
            bad |= blank[n - 1 :] & blank[: len(codes) - n + 1]
        for i in range(1, n - 1):
            bad |= blank[i : len(codes) - n + 1 + i]
        spot = (mixed(h ^ np.uint64(n)) >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int32)
        spot[bad] = BUCKETS
        found[LENGTHS.index(n), n - 1 :] = spot
    return found


def batched(texts: Iterable[str], table: np.ndarray) -> Iterator[tuple[list[int], list[np.ndarray], np.ndarray]]:
    """Pieces of the texts in order, about ``_PART`` code points at a time, with their texts' numbers."""
    owner, parts, again, size = [], [], [], 0
    for number, text in enumerate(texts):
        for nth, piece in enumerate(pieces(text, table)):
            owner.append(number)
            parts.append(piece)
            again.append(0 if nth == 0 else min(len(piece), max(LENGTHS) - 1))
            size += len(piece)
            if size >= _PART:
                yield owner, parts, np.array(again)
                owner, parts, again, size = [], [], [], 0
    if parts:
        yield owner, parts, np.array(again)


def document_counts(table: np.ndarray, texts: Iterable[str]) -> tuple[int, np.ndarray]:
    """Number of texts, and of those that hold each bucket."""
    df, held, n, present = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS + 1, bool), 0, -1

    def close() -> None:
        df[np.flatnonzero(held[:BUCKETS])] += 1
        held[:] = False

    def counted() -> Iterator[str]:
        nonlocal n
        for text in texts:
            n += 1
            yield text

    for owner, parts, again in batched(counted(), table):
        found = buckets(parts, again)
        ends = list(accumulate(map(len, parts)))
        for number, a, b in zip(owner, [0, *ends], ends):
            if number != present:
                close()
                present = number
            held[found[:, a:b]] = True
    close()
    return n, df


@dataclass
class Model:
    """Weights per bucket and language; inverse document frequencies and the scale are part of them."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    table: np.ndarray = field(default_factory=alphabet)

    def logits(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of each text, and whether it has a letter."""
        totals: dict[int, np.ndarray] = {}
        n = 0

        def counted() -> Iterator[str]:
            nonlocal n
            for text in texts:
                n += 1
                yield text

        for owner, parts, again in batched(counted(), self.table):
            found = buckets(parts, again)
            edges = np.cumsum([0, *map(len, parts[:-1])])
            codes = np.concatenate(parts)
            sums = np.zeros((len(codes), len(self.languages) + 2), np.float64)
            for row in found:
                sums[:, :-2] += self.weights[row]
                sums[:, -2] += row < BUCKETS
            sums[:, -1] = (codes != _BLANK) & (codes < _MARK)
            for number, total in zip(owner, np.add.reduceat(sums, edges, axis=0)):
                totals[number] = totals.get(number, 0) + total
        none = np.zeros(len(self.languages) + 2)
        whole = np.array([totals.get(i, none) for i in range(n)]).reshape(n, len(none))
        return whole[:, :-2] / np.maximum(1, whole[:, -2:-1]) + self.bias, whole[:, -1] > 0

    def predict(self, texts: Iterable[str]) -> tuple[list[str], np.ndarray]:
        """Language and its probability for each text; without a letter unknown, with 0."""
        logits, lettered = self.logits(texts)
        if not self.languages:
            return [UNKNOWN] * len(logits), np.zeros(len(logits))
        best = logits.argmax(axis=1)
        logits = (logits - logits.max(axis=1, keepdims=True)) / self.temperature
        score = 1 / np.exp(logits).sum(axis=1)
        names = [self.languages[i] if known else UNKNOWN for i, known in zip(best, lettered)]
        return names, np.where(lettered, score, 0.0)


def _features(text: str, table: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a short text, and their values."""
    found = [buckets([p], np.array([i and max(LENGTHS) - 1])) for i, p in enumerate(pieces(text, table))]
    ids, counts = np.unique(np.concatenate([f.ravel() for f in found]) if found else [BUCKETS], return_counts=True)
    ids, counts = ids[ids < BUCKETS], counts[ids < BUCKETS]
    return ids, SCALE * counts / max(1, counts.sum()) * idf[ids]


def _log_loss(logits: np.ndarray, y: np.ndarray, temperature: float) -> float:
    """Mean log loss when a language is right with (n + 1) / (n + languages) at most.

    That is the rule of succession: n examples without an error do not make one certain.
    """
    n, size = logits.shape
    scaled = logits / temperature
    scaled = scaled - scaled.max(axis=1, keepdims=True)
    log_p = scaled - np.log(np.exp(scaled).sum(axis=1, keepdims=True))
    want = np.full((n, size), 1 / (n + size))
    want[np.arange(n), y] = (n + 1) / (n + size)
    return float(-(want * log_p).sum(axis=1).mean())


def calibrated(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden sections on a logarithmic scale."""
    if not len(y):
        return 1.0
    low, high = np.log(TEMPERATURES)
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if _log_loss(logits, y, np.exp(a)) <= _log_loss(logits, y, np.exp(b)):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def train(samples: list[tuple[str, list[str]]], n_docs: int, df: np.ndarray, seed: int = 7) -> Model:
    """Fit the model on documents given as (language, passages).

    With one language every text is in it; without any, all are unknown.
    """
    languages = sorted({name for name, _ in samples})
    size = len(languages)
    table = alphabet()
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    nth: dict[str, int] = {}
    fitted, aside = [], []
    for name, passages in samples:
        nth[name] = nth.get(name, -1) + 1
        (aside if nth[name] % ASIDE == ASIDE - 1 else fitted).append((languages.index(name), passages))
    examples = [(y, *_features(p, table, idf)) for y, passages in fitted for p in passages]
    examples = [e for e in examples if len(e[1])]
    # One row per bucket seen in the sample, and one for the bias.
    used = np.unique(np.concatenate([e[1] for e in examples])) if examples else np.zeros(0, np.int64)
    examples = [(y, np.append(np.searchsorted(used, ids), len(used)), np.append(x, 1.0)) for y, ids, x in examples]
    z, n = np.zeros((len(used) + 1, size)), np.zeros((len(used) + 1, size))

    def weights(rows) -> np.ndarray:
        pull = np.sign(z[rows]) * L1 - z[rows]
        return np.where(np.abs(z[rows]) > L1, pull / ((BETA + np.sqrt(n[rows])) / ALPHA + L2), 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS if size > 1 else 0):
        for i in rng.permutation(len(examples)):
            y, rows, x = examples[i]
            w = weights(rows)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[y] -= 1
            gradient = x[:, None] * p
            step = (np.sqrt(n[rows] + gradient**2) - np.sqrt(n[rows])) / ALPHA
            z[rows] += gradient - step * w
            n[rows] += gradient**2
    fit = weights(slice(None))
    dense = np.zeros((BUCKETS + 1, size), np.float32)
    dense[used] = fit[:-1] * (SCALE * idf[used])[:, None]
    model = Model(languages, dense, fit[-1], table=table)
    if size > 1 and aside:
        apart = [(y, p) for y, passages in aside for p in passages]
        logits, lettered = model.logits(p for _, p in apart)
        model.temperature = calibrated(logits[lettered], np.array([y for y, _ in apart])[lettered])
    return model


def _learnable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    known = F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    return docs.where(known & ~held_out(id_col)).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )


def count_documents(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Document frequencies over whole texts, one small row per bucket and task."""
    table = alphabet()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = document_counts(table, (t.as_py() for batch in batches for t in batch.column(0)))
        met = np.flatnonzero(df)
        yield pa.record_batch(
            [pa.array(np.append(met, -1), pa.int32()), pa.array(np.append(df[met], n), pa.int64())], names=["bucket", "n"]
        )

    found = rows.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    df, total = np.zeros(BUCKETS, np.int64), 0
    met = found.toArrow()  # BUCKETS + 1 rows at most
    bucket, n = met.column("bucket").to_numpy(), met.column("n").to_numpy()
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    total = int(n[bucket < 0].sum())
    return total, df


def sample(rows: DataFrame, docs: int) -> list[tuple[str, list[str]]]:
    """Language and passages of up to ``docs`` documents, evenly over the languages.

    Documents are taken in the order of hashes of id and text; passages start at hashed
    places of the whole text. With more languages than ``docs``, the most frequent count.
    """
    room = F.greatest(F.lit(1), F.length("text") - PASSAGE_CHARS + 1)
    places = F.transform(
        F.sequence(F.lit(1), F.lit(PASSAGES)), lambda i: F.pmod(F.xxhash64("id", i), room).cast("int") + 1
    )
    passages = F.transform(F.array_distinct(places), lambda p: F.substring(F.col("text"), p, F.lit(PASSAGE_CHARS)))
    hashed = rows.withColumn("h", F.xxhash64("id", "text"))
    counted = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least"))
    names = counted.orderBy(F.desc("n"), "lang").limit(docs).collect()
    if not names:
        return []
    # Up to this hash a language has about four times the rows wanted, and one at least.
    most = max(1, docs // len(names))
    low, span = -(1 << 63), 1 << 64
    cuts = [(r["lang"], max(r["least"], min(low + span * 4 * most // r["n"], low + span - 1))) for r in names]
    cut = F.broadcast(rows.sparkSession.createDataFrame(cuts, "lang string, cut bigint"))
    order = Window.partitionBy("lang").orderBy("h", "id", "passages")
    found = (
        hashed.join(cut, "lang").where(F.col("h") <= F.col("cut"))
        .select("id", "lang", "h", passages.alias("passages"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
        .orderBy("lang", "rank").collect()
    )
    return [(r["lang"], r["passages"]) for r in found]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model from the documents that are not held out and have an id, a text and a language."""
    rows = _learnable(docs, id_col, text_col, lang_col)
    return train(sample(rows, SAMPLE_DOCS), *count_documents(rows))


def with_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` between 0 and 1, from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0. Equal texts get
    equal predictions and repeated rows stay. Columns of these names are replaced,
    others are kept. Empty tables give no rows.
    """
    kind = "struct<lang_pred:string,score:double>"

    @F.arrow_udf(kind)
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = model.predict(t.as_py() or "" for t in batch)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"]
            )

    kept = replacing(docs, "lang_pred", "score")
    if "lang_pred" == text_col or "score" == text_col:
        raise ValueError(f"the text column {text_col!r} has the name of an output")
    scored = kept.withColumn("lang_pred", compute.asNondeterministic()(F.col(text_col)))
    return scored.withColumn("score", F.col("lang_pred.score")).withColumn("lang_pred", F.col("lang_pred.lang_pred"))
