"""Line dedup by a sharded minimal perfect hash.

Distinct line keys that occur in several documents go into shards by their
hash. Each shard is a minimal perfect hash (levels of bit sets; a key sits in
the first level where no other key shares its bit) that indexes three arrays:
a 64-bit fingerprint, the number of documents and the smallest document id. The
lines of the documents are never joined: their 128-bit hashes are dealt to the
shards and stream past the arrays of one shard at a time, so memory does not
depend on how often a line occurs. Each shard is held ``SALTS`` times and a
document picks the copy by its id, so a line that is in every document is probed
by that many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import LOWER, encoded, fresh, mixed, replacing, stored

#: Keys per shard aimed at, and the least number of shards.
SHARD_KEYS = 1 << 12
LEAST_SHARDS = 256

#: Copies of each shard.
SALTS = 16

#: Bits per key in each level, and levels; keys left after the last are kept as they are.
_SPARSE = 2
_LEVELS = 48

# White space stripped at both ends of a line.
_BLANK = b" \t\n\v\f\r"


def line_keys(text: bytes, least_chars: int) -> list[bytes | None]:
    """The key of each line of a text, None for lines too short to count."""
    keys = []
    for line in text.translate(LOWER).split(b"\n"):
        key = line.strip(_BLANK)
        long = len(key) >= 4 * least_chars or (
            len(key) >= least_chars and len(key.decode("utf-8", "surrogatepass")) >= least_chars
        )
        keys.append(key if long else None)
    return keys


def key_hash(key: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(key)
    return _signed(digest >> 64), _signed(digest & 0xFFFFFFFFFFFFFFFF)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _distinct_keys(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, high, low = [], [], []
            for text in encoded(batch.column("text")):
                keys = set(line_keys(text, least_chars)) - {None}
                sizes.append(len(keys))
                for a, b in map(key_hash, keys):
                    high.append(a)
                    low.append(b)
            whose = [np.repeat(batch.column(c).to_numpy(), sizes) for c in ("id", "row")]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, whose), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
                names=["id", "row", "h", "f"],
            )

    return run


def build_shard(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimal perfect hash of distinct 64-bit keys: level sizes, bits, and each key's index.

    Raises if two keys are equal.
    """
    sizes, bits, place = [], [], np.full(len(h), -1, np.int64)
    left, base = np.arange(len(h)), 0
    while len(left):
        if len(sizes) == _LEVELS:
            raise ValueError("equal hashes in one shard")
        size = max(64, _SPARSE * len(left))
        spot = _spots(h[left], len(sizes), size)
        alone = np.bincount(spot, minlength=size) == 1
        placed = alone[spot]
        rank = np.cumsum(alone) - 1
        place[left[placed]] = base + rank[spot[placed]]
        base += int(placed.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~placed]
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    return np.array(sizes, np.int64), flat, place


def _spots(h: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)
    return (mixed(h.view(np.uint64) ^ seed) % np.uint64(size)).astype(np.int64)


def find(h: np.ndarray, sizes: np.ndarray, bits: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Index of each hash, -1 where no level has its bit; a stranger may get an index."""
    place = np.full(len(h), -1, np.int64)
    left, base = np.arange(len(h)), 0
    for level, size in enumerate(sizes.tolist()):
        if not len(left):
            break
        spot = base + _spots(h[left], level, size)
        hit = bits[spot]
        place[left[hit]] = rank[spot[hit]]
        left = left[~hit]
        base += size
    return place


def both_halves(h: np.ndarray, f: np.ndarray) -> np.ndarray:
    """What a shard is built on: shards are dealt by ``h``, so keys with one ``h`` meet
    there, and the other half of their hashes tells them apart."""
    return (mixed(f.view(np.uint64)) ^ h.view(np.uint64)).view(np.int64)


_SHARD = "shard int, sizes binary, bits binary, fingerprints binary, counts binary, owners binary"


def _shard_of_keys(table: pa.Table) -> pa.Table:
    sizes, bits, place = build_shard(
        both_halves(table.column("h").to_numpy(), table.column("f").to_numpy())
    )
    order = np.argsort(place)
    arrays = [table.column(c).to_numpy()[order].tobytes() for c in ("f", "n_docs", "owner")]
    row = [sizes.tobytes(), np.packbits(bits).tobytes(), *arrays]
    return pa.table(
        [pa.array([table.column("shard")[0].as_py()], pa.int32())]
        + [pa.array([value], pa.binary()) for value in row],
        names=["shard", "sizes", "bits", "fingerprints", "counts", "owners"],
    )


def line_index(lines: DataFrame) -> DataFrame:
    """One row per shard, with the arrays, of the keys that several documents hold."""
    keys = stored(
        lines.groupBy("h", "f")
        .agg(F.min("id").alias("owner"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n_docs"))
        .where("owner < last")
        .select("h", "f", "owner", "n_docs"),
        "line-keys",
    )
    shards = max(LEAST_SHARDS, -(-keys.count() // SHARD_KEYS))
    shard = F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int")
    return (
        keys.withColumn("shard", shard)
        .groupBy("shard")
        .applyInArrow(_shard_of_keys, _SHARD)
        .withColumn("shards", F.lit(shards))
    )


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard copy, the arrays of each copy before its probes."""
    at, arrays = None, None
    for batch in batches:
        slot = batch.column("slot").to_numpy()
        is_index = batch.column("is_index").to_numpy(zero_copy_only=False)
        begin = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | is_index[1:] | is_index[:-1]])
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(slot)]):
            if is_index[a]:
                at = slot[a]
                sizes, bits, fp, counts, owners = (
                    np.frombuffer(batch.column(c)[a].as_py(), t)
                    for c, t in (("sizes", np.int64), ("bits", np.uint8),
                                 ("fingerprints", np.int64), ("counts", np.int64),
                                 ("owners", np.int64))
                )
                flat = np.unpackbits(bits, count=int(sizes.sum())).astype(bool)
                arrays = (sizes, flat, np.cumsum(flat) - 1, fp, counts, owners)
                continue
            if slot[a] != at:
                continue  # no recurring key in this shard
            sizes, flat, rank, fp, counts, owners = arrays
            h, f, ids, rows = (
                batch.column(c).slice(a, b - a).to_numpy() for c in ("h", "f", "id", "row")
            )
            place = find(both_halves(h, f), sizes, flat, rank)
            known = np.flatnonzero(place >= 0)
            known = known[fp[place[known]] == f[known]]
            spot = place[known]
            out = known[(counts[spot] >= 2) & (owners[spot] != ids[known])]
            if len(out):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[out]), pa.array(rows[out]), pa.array(h[out])],
                    names=["id", "row", "h"],
                )


def repeated_lines(lines: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """``id``, ``row``, ``h`` of each line key that a document other than its owner holds."""
    shard = F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int")
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    probes = lines.select((shard * SALTS + salt).alias("slot"), F.lit(False).alias("is_index"), "*")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    held = index.withColumn("copy", copies).select(
        (F.col("shard") * SALTS + F.col("copy")).alias("slot"),
        F.lit(True).alias("is_index"),
        "sizes", "bits", "fingerprints", "counts", "owners",
    )
    return (
        probes.unionByName(held, allowMissingColumns=True)
        .repartition("slot")
        .sortWithinPartitions("slot", F.desc("is_index"))
        .mapInArrow(_probe, "id bigint, row bigint, h bigint")
    )


def _apply_udf(least_chars: int):
    @F.arrow_udf("struct<text string, n_lines bigint, n_dropped bigint>")
    def compute(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drops in batches:
            kept, lines, dropped = [], [], []
            for text, drop in zip(encoded(texts), drops):
                gone = set(drop.as_py() or ())
                parts = text.split(b"\n")
                stay = parts
                if gone:
                    keys = line_keys(text, least_chars)
                    stay = [
                        p for p, k in zip(parts, keys) if k is None or key_hash(k)[0] not in gone
                    ]
                kept.append(b"\n".join(stay))
                lines.append(len(parts))
                dropped.append(len(parts) - len(stay))
            yield pa.StructArray.from_arrays(
                [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()),
                 pa.array(dropped, pa.int64())],
                names=["text", "n_lines", "n_dropped"],
            )

    return compute.asNondeterministic()


def dedup_lines(
    docs: DataFrame, least_chars: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with repeated lines gone from ``text_col``; adds ``n_lines`` and ``n_dropped``.

    A line's key is the line without ASCII white space at its ends and with A-Z
    in lower case. Keys of at least ``least_chars`` characters that two or more
    documents hold lose their lines everywhere but in the document with the
    smallest id. ``n_lines`` counts the lines before. Shorter keys stay.

    Null and empty texts are one empty line; the text comes back empty. Rows that
    share an id are one document: a line they share is kept in each of them. A
    row without an id is a document of its own, told from others by its text and
    placed after ids below 2^62. A text whose lines all go becomes empty. Columns called ``n_lines`` or ``n_dropped`` are
    replaced, all others are kept. Empty tables give no rows.
    """
    text_hash = F.xxhash64(text_col)
    unnamed = F.lit(1 << 62) + F.pmod(text_hash, F.lit(1 << 62))
    whose = F.coalesce(F.col(id_col).cast("bigint"), unnamed)
    lines = docs.select(
        whose.alias("id"), text_hash.alias("row"), F.col(text_col).alias("text")
    ).mapInArrow(_distinct_keys(least_chars), "id bigint, row bigint, h bigint, f bigint")
    index = stored(line_index(lines), "line-index")
    shards = index.agg(F.max("shards")).first()[0] or LEAST_SHARDS
    rows = replacing(docs, "n_lines", "n_dropped")
    whose_name, hash_name, id_name, row_name, drops_name, done_name = fresh(
        rows, "_whose", "_hash", "_id", "_row", "_drops", "_done"
    )
    drops = (
        repeated_lines(lines, index.drop("shards"), shards)
        .groupBy(F.col("id").alias(id_name), F.col("row").alias(row_name))
        .agg(F.collect_set("h").alias(drops_name))
    )
    met = rows.withColumns({whose_name: whose, hash_name: text_hash}).join(
        drops.hint("shuffle_hash"),
        (F.col(whose_name) == F.col(id_name)) & (F.col(hash_name) == F.col(row_name)),
        "left",
    )
    done = met.withColumn(
        done_name, _apply_udf(least_chars)(F.col(text_col), F.col(drops_name))
    )
    columns = [
        F.col(done_name)["text"].alias(c) if c.lower() == text_col.lower() else F.col(c)
        for c in rows.columns
    ]
    result = F.col(done_name)
    return done.select(
        *columns, result["n_lines"].alias("n_lines"), result["n_dropped"].alias("n_dropped")
    )
