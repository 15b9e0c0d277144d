"""Near-duplicates by SimHash fingerprints and pivot distance tables.

The distance of a fingerprint to a fixed reference (pivot) differs by at most d
between two fingerprints that are d bits apart. Each distinct fingerprint
carries its table of distances to sixteen pivots, computed once. Inside a
bucket, fingerprints are sorted by the first coordinate, pairs whose tables
differ by more than d in any coordinate are discarded, and the bits of the
survivors are compared.

Buckets keep this exact without comparing all pairs: of eight bytes, d differing
bits touch at most d, so two linked fingerprints agree on some choice of 8 - d
bytes. Each choice is one bucket key. A bucket leaves 8 * d bits open, so it
holds at most 2^16 distinct fingerprints at d = 2, whatever the data: copies are
collapsed before, and no key can outgrow a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import LOWER, encoded, matched, mixed, stored, text_key
from spendlens.llm.components import components

#: References whose distances are tabled; eight to a 64-bit word.
PIVOTS = 16


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_per_shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    total, n, part = np.zeros(64, np.int64), len(words) - k + 1, 1 << 14
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, n)
    for i in range(0, n, part):
        octets = hashes[i : i + part].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.int64)[0])


def fingerprint_udf(words_per_shingle: int):
    @F.arrow_udf("bigint")
    def compute(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [fingerprint(t, words_per_shingle) for t in encoded(batch)]
            yield pa.array(found, pa.int64())

    return compute


def _references() -> list[int]:
    """Fixed pivots: mixed counters, so about half the bits differ between any two."""
    return mixed(np.arange(1, PIVOTS + 1, dtype=np.uint64)).view(np.int64).tolist()


def pivot_tables(fps: DataFrame) -> DataFrame:
    """Add the distances to all pivots, packed by bytes into ``t0`` and ``t1``."""
    packed = []
    for part in (_references()[:8], _references()[8:]):
        word = F.lit(0).cast("bigint")
        for i, ref in enumerate(part):
            distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(ref))).cast("bigint")
            word = word.bitwiseOR(F.shiftleft(distance, 56 - 8 * i))
        packed.append(word)
    return fps.withColumn("t0", packed[0]).withColumn("t1", packed[1])


def _masks(distance: int) -> list[int]:
    """For each choice of 8 - distance bytes, the signed mask that keeps them."""
    whole = (1 << 64) - 1
    masks = []
    for left_out in combinations(range(8), distance):
        mask = whole
        for byte in left_out:
            mask &= ~(0xFF << (8 * byte))
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def bucket_links(
    bucket: np.ndarray, fp: np.ndarray, tables: np.ndarray, distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """Connect the rows of each bucket: pairs (row, a row it is connected to).

    Rows come sorted by bucket and first coordinate. A row is compared with
    those after it while bucket and first coordinate allow. The result is one
    star per connected set of each bucket, never all of its pairs.
    """
    root = np.arange(len(fp))
    active = np.arange(len(fp))
    first = tables[:, 0]

    def join(left: np.ndarray, right: np.ndarray) -> None:
        while True:
            low = np.minimum(root[left], root[right])
            if (root[left] == low).all() and (root[right] == low).all():
                return
            np.minimum.at(root, root[left], low)
            np.minimum.at(root, root[right], low)
            while ((step := root[root]) != root).any():
                root[:] = step

    left, right, held, k = [], [], 0, 0
    while len(active):
        k += 1
        active = active[active + k < len(fp)]
        other = active + k
        near = (bucket[active] == bucket[other]) & (first[other] - first[active] <= distance)
        active = active[near]
        other = active + k
        gap = np.abs(tables[active] - tables[other]).max(axis=1, initial=0)
        i, j = active[gap <= distance], other[gap <= distance]
        same = np.bitwise_count(fp[i] ^ fp[j]) <= distance
        left.append(i[same])
        right.append(j[same])
        held += int(same.sum())
        if held > 1 << 20:
            join(np.concatenate(left), np.concatenate(right))
            left, right, held = [], [], 0
    if held:
        join(np.concatenate(left), np.concatenate(right))
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return linked, root[linked]


def _link_batches(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def links(rows: np.ndarray) -> pa.RecordBatch:
            start = np.flatnonzero(
                np.r_[True, (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])]
            )
            size = np.diff(np.r_[start, len(rows)])
            bucket = np.repeat(np.arange(len(start)), size)
            shared = np.repeat(size > 1, size)
            rows, bucket = rows[shared], bucket[shared]
            octets = np.ascontiguousarray(rows[:, 3:5]).astype(">i8").view(np.uint8)
            tables = octets.reshape(len(rows), PIVOTS).astype(np.int16)
            fp = np.ascontiguousarray(rows[:, 2])
            one, other = bucket_links(bucket, fp.view(np.uint64), tables, distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[one]), pa.array(fp[other])], names=["u", "v"]
            )

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            rows = rows if held is None else np.concatenate((held, rows))
            if not len(rows):
                continue
            # The last bucket may go on in the next batch.
            open_ = (rows[:, 0] == rows[-1, 0]) & (rows[:, 1] == rows[-1, 1])
            cut = int(np.argmax(open_))
            held = rows[cut:]
            if cut:
                yield links(rows[:cut])
        if held is not None and len(held):
            yield links(held)

    return run


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Links ``u``, ``v`` that connect distinct fingerprints ``fp`` at most ``distance`` bits
    apart, directly or through others of the same bucket."""
    choices = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias("choice"),
                     F.col("fp").bitwiseAND(F.lit(mask)).alias("kept"))
            for i, mask in enumerate(_masks(distance))
        ]
    )
    return (
        pivot_tables(fps.select("fp"))
        .select(F.explode(choices).alias("key"), "fp", "t0", "t1")
        .select("key.choice", "key.kept", "fp", "t0", "t1")
        .repartition("choice", "kept")
        .sortWithinPartitions("choice", "kept", "t0", "t1", "fp")
        .mapInArrow(_link_batches(distance), "u bigint, v bigint")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    words_per_shingle: int = 3,
    distance: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprint and component of every document.

    Returns ``id_col``, ``text_key``, ``fp`` and ``component_id``, one row for
    each row of ``docs``: the smallest id reachable over links of at most
    ``distance`` differing bits. Null or empty texts and texts without words have
    fingerprint zero and link like any other; equal fingerprints are linked.
    Repeated rows come back as often as given. Rows without an id take part in
    linking but name no component: it is null where no member has an id. Extra
    columns are ignored. Empty tables give no rows.
    """
    rows = stored(
        docs.select(
            F.col(id_col).cast("bigint").alias(id_col),
            text_key(text_col).alias("text_key"),
            fingerprint_udf(words_per_shingle)(F.col(text_col)).alias("fp"),
        ),
        "fingerprints",
    )
    by_fp = rows.groupBy("fp").agg(F.min(id_col).alias("first_id"))
    rooted = components(links(by_fp, distance))
    named = by_fp.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(id_col, "text_key", "fp", "component_id")


def one_of_each(
    docs: DataFrame,
    words_per_shingle: int = 3,
    distance: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest id.

    A row without an id stays only where no row of its group has one. Of rows
    that repeat id and text one stays. All columns are kept.
    """
    found = near_duplicates(docs, words_per_shingle, distance, id_col, text_col)
    order = F.struct(
        F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), "text_key"
    )
    group = F.coalesce("component_id", "fp")
    keep = (
        found.groupBy(F.col("component_id").isNull().alias("unnamed"), group.alias("group"))
        .agg(F.min(order).alias("kept"))
        .select("kept.id", F.col("kept.text_key").alias("key"))
    )
    return matched(docs, keep, "left_semi", id_col, text_col, once=True)
