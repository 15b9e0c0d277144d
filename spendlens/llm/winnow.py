"""Benchmark decontamination by winnowing.

Texts become words; every k consecutive words are a gram with a 64-bit hash. Of
each w consecutive grams the rightmost smallest hash is kept as a fingerprint. A
span of k + w - 1 words shared by a document and a benchmark item has the same
smallest gram on both sides, so a shared window of that length always shares a
fingerprint: joining fingerprints misses nothing. With k = 5 and w = 6 the
guarantee holds for 10 words. An item with fewer words is one gram of its own
length, looked for at every word of the documents.

A hit carries the words around it on both sides. It is extended: each window of
10 words that covers the gram is compared word by word, so hashes only propose.

Documents drop fingerprints that no benchmark gram can have by a bit set of
bounded size, shipped with the task. With a benchmark too large for it more
fingerprints reach the join; the rows stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import encoded, matched, mixed, stored, text_key

#: Words of a window, and of a gram inside it.
WINDOW = 10
GRAM = 5

#: Bits of the proposal filter at most (2 MB); it never grows with the data.
FILTER_BITS = 1 << 24

#: Bytes of text hashed at a time.
_PART = 1 << 20

# A-z, 0-9 and every byte above 127 belong to words, A-Z in lower case.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    up[1:], down[1:] = _MULTIPLIER, inverse
    return np.cumprod(up), np.cumprod(down)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in bytes where blanks part the words."""
    edge = np.diff(np.concatenate(([False], data != 32, [False])).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, starts, ends, powers) -> np.ndarray:
    """A 64-bit hash of each word: its bytes as a polynomial, mixed. Some bytes at a time."""
    letters = mixed(np.arange(1, 257, dtype=np.uint64))
    hashes = np.zeros(len(starts), np.uint64)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), _PART)), len(starts)))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        part = data[starts[a] : ends[b - 1]]
        up, down = powers if len(part) < len(powers[0]) else _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(letters[part] * up[: len(part)], out=sums[1:])
        begin, end = starts[a:b] - starts[a], ends[a:b] - starts[a]
        hashes[a:b] = mixed((sums[end] - sums[begin]) * down[begin])
    return hashes


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total = total * _MULTIPLIER + words[i : i + count]
    return mixed(total ^ np.uint64(n))


def winnowed(grams: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Indices of the rightmost smallest gram in each window of words of one text."""
    count = len(owner) - window + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    least = grams[:count].copy()
    where = np.arange(count)
    for i in range(1, len(grams) - count + 1):
        other = grams[i : i + count]
        where = np.where(other <= least, np.arange(i, i + count), where)
        least = np.minimum(least, other)
    inside = owner[:count] == owner[window - 1 :]
    chosen = np.zeros(len(grams), bool)
    chosen[where[inside]] = True
    return np.flatnonzero(chosen)


class Grams:
    """Finds the fingerprints of texts.

    ``lengths`` are the lengths below ``window`` at which every gram of a text is
    kept; None keeps, as for items, only the gram that is a whole short text.
    ``bits`` is the filter a fingerprint must pass.
    """

    def __init__(self, window: int, gram: int, lengths=None, bits: bytes | None = None) -> None:
        self.window, self.gram, self.lengths = window, gram, lengths
        self.bits = None if bits is None else np.frombuffer(bits, np.uint8)
        self.powers = _powers(2 * _PART)

    def passing(self, h: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(h), bool)
        spot = (h >> np.uint64(65 - (8 * len(self.bits)).bit_length())).astype(np.int64)
        return (self.bits[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1

    def of(self, texts) -> Iterator[tuple[int, list]]:
        """Number of words and fingerprints of each text, about a megabyte at a time.

        A fingerprint is (words of the gram, words of the window, hash, the gram's
        place in its surroundings, the surroundings, its places in the text).
        """
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text) + 1
            if size >= _PART:
                yield from self._batch(held)
                held, size = [], 0
        if held:
            yield from self._batch(held)

    def _batch(self, texts: list[bytes]) -> list[tuple[int, list]]:
        data = np.frombuffer(b" ".join(texts).translate(_WORD_BYTES) + b" ", np.uint8)
        first = np.cumsum([0] + [len(t) + 1 for t in texts])
        starts, ends = word_spans(data)
        owner = np.searchsorted(first, starts, side="right") - 1
        sizes = np.bincount(owner, minlength=len(texts))
        base = np.cumsum(sizes) - sizes
        words = word_hashes(data, starts, ends, self.powers)
        found: list[dict] = [{} for _ in texts]

        def keep(chosen, grams, n: int, window: int) -> None:
            chosen = chosen[self.passing(grams[chosen])]
            text = owner[chosen]
            low = np.maximum(base[text], chosen - (window - n))
            high = np.minimum(base[text] + sizes[text], chosen + window)
            for t, i, a, b in zip(*(x.tolist() for x in (text, chosen, low, high))):
                near = b" ".join(bytes(data[starts[a] : ends[b - 1]]).split()).decode()
                gram = (n, window, int(grams[i].view(np.int64)), i - a, near)
                found[t].setdefault(gram, []).append(i - int(base[t]))

        grams = gram_hashes(words, self.gram)
        keep(winnowed(grams, owner, self.window), grams, self.gram, self.window)
        whole = self.lengths is None
        for n in range(1, self.window) if whole else self.lengths:
            grams = gram_hashes(words, n)
            chosen = np.flatnonzero(owner[: len(grams)] == owner[n - 1 :])
            if whole:
                chosen = chosen[sizes[owner[chosen]] == n]
            keep(chosen, grams, n, n)
        return [
            (n, [(*g, places) for g, places in grams.items()])
            for n, grams in zip(sizes.tolist(), found)
        ]


_FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("grams", pa.list_(pa.struct([
            ("n", pa.int32()), ("w", pa.int32()), ("h", pa.int64()), ("at", pa.int32()),
            ("near", pa.string()), ("places", pa.list_(pa.int64())),
        ]))),
    ]
)
_FOUND_SQL = (
    "struct<n_words: bigint, grams: array<struct<n: int, w: int, h: bigint, at: int, "
    "near: string, places: array<bigint>>>>"
)
_NAMES = ("n", "w", "h", "at", "near", "places")


def _grams_udf(**options):
    @F.arrow_udf(_FOUND_SQL)
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = Grams(**options)
        for batch in batches:
            rows = [
                {"n_words": n, "grams": [dict(zip(_NAMES, g)) for g in grams]}
                for n, grams in finder.of(encoded(batch))
            ]
            yield pa.array(rows, _FOUND)

    return compute.asNondeterministic()


def _filter(grams: DataFrame, bits: int) -> bytes:
    """A bit set of the hashes' leading bits. At most ``bits / 32768`` rows of 4 KB come here."""
    # Positions count from one, so that bitmaps begin at multiples of their size.
    spot = F.shiftrightunsigned("h", 64 - (bits.bit_length() - 1)) + 1
    rows = (
        grams.groupBy(F.bitmap_bucket_number(spot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bitmap"))
        .collect()
    )
    size = min(bits // 8, 4096)
    whole = bytearray(bits // 8)
    for row in rows:
        start = (row["bucket"] - 1) * 4096
        whole[start : start + size] = bytes(row["bitmap"])[:size]
    return bytes(whole)


def _same_windows(near, at, item_near, item_at, n, w):
    """Starts, relative to the gram, of the windows over it that are equal on both sides."""
    mine, theirs = F.split(near, " "), F.split(item_near, " ")

    def equal(shift):
        a, b = at + shift, item_at + shift
        inside = (a >= 0) & (b >= 0) & (a + w <= F.size(mine)) & (b + w <= F.size(theirs))
        return F.when(inside, F.slice(mine, a + 1, w) == F.slice(theirs, b + 1, w)).otherwise(
            F.lit(False)
        )

    return F.filter(F.sequence(n - w, F.lit(0)), equal)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Benchmark windows found in each document.

    Words are runs of a-z, 0-9 and non-ASCII characters, with A-Z in lower case. A
    window is ``window`` consecutive words of an item, or a whole item of fewer.
    Returns ``id_col``, ``text_key``, ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``items`` (ids of the items found, as sorted
    strings), ``spans`` (start and end words of the hits) and ``contaminated``;
    one row for each row of ``docs``, repeated rows included.

    Null and empty texts have no words and no hits; items without words are no
    windows. Items with one text are all listed; an item row given twice counts
    once. An item without an id marks words but is not listed. Extra columns are
    ignored. No documents give no rows, no items give no hits.
    """
    items = stored(
        benchmark.select(
            F.col(item_col).cast("string").alias("item"),
            _grams_udf(window=window, gram=gram)(F.col(item_text_col)).alias("found"),
        )
        .select("item", F.explode("found.grams").alias("g"))
        .select("item", "g.n", "g.w", "g.h", F.col("g.at").alias("item_at"),
                F.col("g.near").alias("item_near"))
        .distinct(),
        "benchmark-grams",
    )
    lengths = [r["w"] for r in items.where(F.col("w") < window).select("w").distinct().collect()]
    bits = min(FILTER_BITS, max(1 << 16, 1 << (64 * items.count()).bit_length()))
    find = _grams_udf(window=window, gram=gram, lengths=lengths, bits=_filter(items, bits))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        text_key(text_col).alias("key"),
        find(F.col(text_col)).alias("found"),
    )
    grams = rows.select(
        "row", "id", "key", "found.n_words", F.explode_outer("found.grams").alias("g")
    ).select(
        "row", "id", "key", "n_words", "g.at", "g.near", "g.places",
        # Rows without a fingerprint keep apart from each other in the join.
        F.coalesce("g.n", F.lit(0)).alias("n"), F.coalesce("g.w", F.lit(0)).alias("w"),
        F.coalesce("g.h", F.xxhash64("row")).alias("h"),
    )
    windows = _same_windows(
        F.col("near"), F.col("at"), F.col("item_near"), F.col("item_at"), F.col("n"), F.col("w")
    )
    met = (
        grams.join(items, ["n", "w", "h"], "left")
        .withColumn("shifts", F.when(F.col("item_near").isNotNull(), windows))
        .withColumn("shifts", F.when(F.size("shifts") > 0, F.col("shifts")))
    )
    spans = F.flatten(
        F.transform(
            "places",
            lambda p: F.transform(
                "shifts",
                lambda s: F.struct((p + s).alias("start"), (p + s + F.col("w")).alias("end")),
            ),
        )
    )
    by_row = met.groupBy("row").agg(
        *[F.any_value(c).alias(c) for c in ("id", "key", "n_words")],
        F.array_sort(
            F.collect_set(F.when(F.col("shifts").isNotNull(), F.col("item")))
        ).alias("items"),
        F.array_sort(
            F.array_distinct(F.flatten(F.collect_list(F.when(F.col("shifts").isNotNull(), spans))))
        ).alias("spans"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["upto"], x["start"]))).alias("n"),
            F.greatest(a["upto"], x["end"]).alias("upto"),
        ),
        lambda a: a["n"],
    )
    return by_row.select(
        F.col("id").alias(id_col), F.col("key").alias("text_key"), "n_words",
        covered.alias("n_hit"), "items", "spans", (F.size("spans") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones, all columns and repeated rows kept.

    Rows are matched by id and text, null ids included. See ``contamination`` for
    what counts.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = contamination(docs, benchmark, **options).where("contaminated")
    dirty = found.select(
        F.col(id_col).cast("bigint").alias("id"), F.col("text_key").alias("key")
    ).distinct()
    return matched(docs, dirty, "left_anti", id_col, text_col)
