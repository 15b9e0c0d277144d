"""Prefix trie of rebuilt conversations by composable fingerprints.

A sequence of turns stands for an element of a monoid: its length n, and the
polynomial H of its turns' hashes modulo a prime. Two sequences in a row are
(n1 + n2, H1 + r^n1 * H2). A conversation is rebuilt from the first turns of its
base and its own later turns; the fingerprint of each of its prefixes is combined
from prefix products of the two stored conversations. No rebuilt text is ever made.

Prefix products come from one scan over turns sorted by conversation. A conversation
may span many partitions: each holds products of its own part, and the parts before
are multiplied in afterwards, which the monoid allows.

Equal prefixes have equal fingerprints. The other way round is verified: turns with
one hash must be one role and text, and all members of a node must refer to the same
last turn. By the polynomial, equal fingerprints with equal last turns have equal
fingerprints one turn before, so this holds down to the root. A mismatch starts
over with other hashes.

Sums over subtrees need no walk. The smallest member of a node owns it, and owns
all nodes further down its path; so the first depth a conversation owns says where
its path becomes its own, and node sums are sums over members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import mixed, stored
from spendlens.plans.skew import hot_keys, lookup

#: Base conversations are those whose id this divides; heads have fewer turns than this.
GROUP = 5
HEADS = 9

#: The prime of all four lanes: products of two residues fit 64 bits.
PRIME = (1 << 31) - 1
LANES = range(4)

#: Fingerprints to try; one that shows a collision is given up.
ATTEMPTS = 3

_NODE = ("depth", "fa", "fb")


def bases(seed: int) -> list[int]:
    """The factor r of each lane."""
    spread = mixed(np.arange(1 + 4 * seed, 5 + 4 * seed, dtype=np.uint64))
    return [int(x) % (PRIME - 2) + 2 for x in spread]


def turn_hash(seed: int) -> tuple[Column, Column]:
    """Two 64-bit hashes of role and text."""
    return (F.xxhash64(F.lit(2 * seed), "role", "text"), F.xxhash64(F.lit(2 * seed + 1), "role", "text"))


def _turns(turns: DataFrame) -> DataFrame:
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


class _Powers:
    """r^e for whole arrays of e, from two tables."""

    def __init__(self, base: int) -> None:
        self.low = np.array([pow(base, e, PRIME) for e in range(1 << 12)], np.uint64)
        self.step, self.high = pow(base, 1 << 12, PRIME), [1]

    def of(self, e: np.ndarray) -> np.ndarray:
        while len(self.high) <= int(e.max()) >> 12:
            self.high.append(self.high[-1] * self.step % PRIME)
        high = np.array(self.high, np.uint64)[e >> 12]
        return self.low[e & 0xFFF] * high % np.uint64(PRIME)


_SCANNED = ("conv_id bigint, part int, pos bigint, " + ", ".join(f"h{k} bigint" for k in LANES)
            + ", pb bigint, nb bigint, ta bigint, tb bigint")


def _scan(factors: list[int]):
    """Prefix products of each conversation's turns within one sorted partition."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, prime = TaskContext.get().partitionId(), np.uint64(PRIME)
        powers = [_Powers(r) for r in factors]
        last, n, size, carried = None, 0, 0, [0] * len(factors)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, ta, tb, nb = (batch.column(i).to_numpy() for i in range(4))
            begins = np.append(True, conv[1:] != conv[:-1])
            start, run = np.flatnonzero(begins), np.cumsum(begins) - 1
            if conv[0] != last:
                n, size, carried = 0, 0, [0] * len(factors)
            first = run == 0

            def totals(values: np.ndarray, before: int) -> np.ndarray:
                up_to = np.cumsum(values)
                within = up_to - (up_to[start] - values[start])[run]
                within[first] += values.dtype.type(before)
                return within

            pos = np.arange(len(conv)) - start[run]
            pos[first] += n
            pb = totals(nb, size)
            a, b, low = ta.view(np.uint64), tb.view(np.uint64), np.uint64((1 << 31) - 1)
            pieces = (a & low, (a >> np.uint64(31)) & low, b & low, (b >> np.uint64(31)) & low)
            h = [totals(piece % prime * powers[k].of(pos) % prime, carried[k]) % prime
                 for k, piece in enumerate(pieces)]
            last, n, size, carried = conv[-1], int(pos[-1]) + 1, int(pb[-1]), [int(x[-1]) for x in h]
            columns = [conv, np.full(len(conv), part, np.int32), pos + 1, *[x.astype(np.int64) for x in h], pb, nb, ta, tb]
            names = ["conv_id", "part", "pos", *[f"h{k}" for k in LANES], "pb", "nb", "ta", "tb"]
            yield pa.record_batch([pa.array(c) for c in columns], names=names)

    return scan


def _power(base: int, e: Column) -> Column:
    """base^e modulo the prime, bit by bit."""
    squares = F.array(*[F.lit(pow(base, 1 << i, PRIME)).cast("bigint") for i in range(40)])
    bits = F.sequence(F.lit(0), F.lit(39))
    return F.aggregate(
        bits, F.lit(1).cast("bigint"),
        lambda acc, i: F.when(
            F.floor(e / F.pow(F.lit(2.0), i)).cast("bigint") % 2 == 1, acc * F.get(squares, i) % PRIME
        ).otherwise(acc),
    )


def _prefixes(turns: DataFrame, seed: int) -> DataFrame:
    """One row per turn: its number in its conversation, and the product up to it.

    Sorted by range, so a long conversation is spread over partitions; parts before a
    row's own are multiplied in. At most one conversation of a partition began
    before it, so there are no more such parts than partitions.
    """
    factors = bases(seed)
    ta, tb = turn_hash(seed)
    tie = F.concat("role", F.lit("\0"), "text")
    scanned = stored(
        turns.withColumn("tie", tie)
        .repartitionByRange("conv_id", "turn", F.left("tie", F.lit(48)))
        .sortWithinPartitions("conv_id", "turn", "tie")
        .select("conv_id", ta.alias("ta"), tb.alias("tb"), F.octet_length("text").cast("bigint").alias("nb"))
        .mapInArrow(_scan(factors), _SCANNED),
        "turn-prefixes",
    )
    lanes = [f"h{k}" for k in LANES]
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        scanned.groupBy("conv_id", "part")
        .agg(F.max(F.struct("pos", *lanes, "pb")).alias("m"))
        .withColumn("n", F.sum("m.pos").over(earlier))
    )
    moved = parts.select(
        "conv_id", "part", "n", "m.pb",
        *[F.col(f"m.h{k}") * _power(r, F.coalesce("n", F.lit(0))) % PRIME for k, r in enumerate(factors)],
    ).toDF("conv_id", "part", "n", "pb", *lanes)
    before = moved.select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("n").alias("_n"),
        F.sum("pb").over(earlier).alias("_pb"),
        *[(F.sum(h).over(earlier) % PRIME).alias(f"_{h}") for h in lanes],
        *[_power(r, F.col("n")).alias(f"_r{k}") for k, r in enumerate(factors)],
    ).where(F.col("_n") > 0)
    met = scanned.join(
        F.broadcast(before), (F.col("conv_id") == F.col("_conv")) & (F.col("part") == F.col("_part")), "left"
    )
    none = F.lit(0).cast("bigint")
    return met.select(
        "conv_id",
        (F.col("pos") + F.coalesce("_n", none)).alias("pos"),
        *[
            ((F.coalesce(f"_{h}", none) + F.coalesce(f"_r{k}", F.lit(1).cast("bigint")) * F.col(h)) % PRIME).alias(h)
            for k, h in enumerate(lanes)
        ],
        (F.col("pb") + F.coalesce("_pb", none)).alias("pb"),
        "nb", "ta", "tb",
    )


def _packed(lanes: Sequence[Column]) -> list[Column]:
    wide = [lane.cast("bigint") for lane in lanes]
    return [(wide[0] + wide[1] * (1 << 31)).alias("fa"), (wide[2] + wide[3] * (1 << 31)).alias("fb")]


def _plans(prefixes: DataFrame, seed: int) -> DataFrame:
    """Per conversation, how its rebuilt prefixes follow from stored ones.

    ``head`` has the prefixes of the base it begins with. An own turn at ``pos`` past
    ``skip`` stands at depth ``pos + shift``; its product is ``off + factor * h``.
    """
    lanes = [f"h{k}" for k in LANES]
    entry = F.struct("pos", *lanes, "pb", "nb", "ta", "tb")
    convs = stored(
        prefixes.groupBy("conv_id").agg(
            F.max("pos").alias("n"),
            F.max("pb").alias("bytes"),
            F.sort_array(F.collect_list(F.when(F.col("pos") < HEADS, entry))).alias("first"),
        ),
        "conversations",
    )
    number = F.col("conv_id").cast("string").cast("binary")
    base = convs.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.col("first").alias("head")
    )
    planned = (
        convs.withColumn("skip", F.crc32(number) % HEADS)
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
        .join(base, "base", "left")
        .withColumn("head", F.slice(F.coalesce("head", F.filter("first", lambda x: F.lit(False))), F.lit(1), F.col("skip").cast("int")))
        .withColumn("shift", F.size("head") - F.col("skip"))
        .withColumn("taken", F.greatest(F.lit(0), F.col("n") - F.col("skip")))
        .withColumn("length", F.size("head") + F.col("taken"))
        .withColumn("b", F.try_element_at("head", F.lit(-1)))
        .withColumn("c", F.get("first", F.col("skip").cast("int") - 1))
    )
    none = F.lit(0).cast("bigint")
    factors = [
        F.element_at(F.array(*[F.lit(pow(r, -e, PRIME)).cast("bigint") for e in range(HEADS)]),
                     (1 - F.col("shift")).cast("int"))
        for r in bases(seed)
    ]
    return stored(
        planned.select(
            "conv_id", "head", "skip", "shift", "length", "taken",
            (F.coalesce("b.pb", none) - F.coalesce("c.pb", none)).alias("move"),
            *[factor.alias(f"factor{k}") for k, factor in enumerate(factors)],
            *[
                F.pmod(F.coalesce(f"b.h{k}", none) - factor * F.coalesce(f"c.h{k}", none), F.lit(PRIME)).alias(f"off{k}")
                for k, factor in enumerate(factors)
            ],
        ),
        "plans",
    )


def _rebuilt(prefixes: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per rebuilt conversation and depth, the root included."""
    none = F.lit(0).cast("bigint")
    columns = ("conv_id", "length", "depth", "fa", "fb", "pb", "nb", "ta", "tb")
    length = F.col("length").cast("bigint").alias("length")
    root = plans.select("conv_id", length, *[none.alias(c) for c in columns[2:]])
    heads = plans.select("conv_id", length, F.explode("head").alias("t")).select(
        "conv_id", "length", F.col("t.pos").alias("depth"),
        *_packed([F.col(f"t.h{k}") for k in LANES]), "t.pb", "t.nb", "t.ta", "t.tb",
    )
    number = F.col("conv_id").cast("string").cast("binary")
    own = prefixes.where(F.col("pos") > F.crc32(number) % HEADS)
    met = lookup(own, plans.drop("head", "skip"), "conv_id", hot_keys(plans, "conv_id", "taken"), "pos")
    later = met.select(
        "conv_id", length, (F.col("pos") + F.col("shift")).cast("bigint").alias("depth"),
        *_packed([(F.col(f"off{k}") + F.col(f"factor{k}") * F.col(f"h{k}")) % PRIME for k in LANES]),
        (F.col("pb") + F.col("move")).alias("pb"), "nb", "ta", "tb",
    )
    return root.unionByName(heads).unionByName(later)


def _equal_turns(turns: DataFrame, seed: int) -> bool:
    """Whether all turns of one hash have one role and text."""
    ta, tb = turn_hash(seed)
    mixed_up = (
        turns.groupBy(ta.alias("ta"), tb.alias("tb"))
        .agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("role", "text") for f in (F.min, F.max)])
        .where("min_role <> max_role OR min_text <> max_text")
    )
    return mixed_up.isEmpty()


def _nodes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt rows and their nodes, with fingerprints that were verified."""
    for seed in range(ATTEMPTS):
        if not _equal_turns(turns, seed):
            continue
        prefixes = _prefixes(turns, seed)
        rows = stored(_rebuilt(prefixes, _plans(prefixes, seed)), "rebuilt")
        nodes = stored(
            rows.groupBy(F.struct(*_NODE).alias("node")).agg(
                F.min("conv_id").alias("owner"),
                F.count(F.lit(1)).alias("members"),
                F.max("length").alias("deepest"),
                F.min(F.struct("ta", "tb")).alias("turn"),
                F.max(F.struct("ta", "tb")).alias("other"),
            ),
            "nodes",
        )
        if nodes.where(F.col("turn") != F.col("other")).isEmpty():
            return rows, nodes
    raise ValueError(f"{ATTEMPTS} different fingerprints gave equal values to different prefixes")


_CHUNK = "depth bigint, fa bigint, fb bigint, first bigint, ids string"
_DIGEST = "depth bigint, fa bigint, fb bigint, ends_sha256 string"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conversation) rows as pieces of each node's list."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        rows = [
            (*node, (ids := [r[3] for r in run])[0], ",".join(map(str, ids)))
            for node, run in groupby(zip(*columns), key=lambda r: r[:3])
        ]
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows)], names=[*_NODE, "first", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its pieces in order."""
    node, digest = None, None
    for batch in batches:
        out = []
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:3] == node:
                digest.update(b",")
            else:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = row[:3], hashlib.sha256()
            digest.update(row[4].encode())
        if out:
            yield pa.record_batch([pa.array(c) for c in zip(*out)], names=[*_NODE, "ends_sha256"])
    if node is not None:
        yield pa.record_batch([pa.array([v]) for v in (*node, digest.hexdigest())], names=[*_NODE, "ends_sha256"])


def _ends(rows: DataFrame) -> DataFrame:
    """Digest of the ids of the conversations that end at each node.

    Sorted by range, so many tasks write the list of a node with very many ends. One
    task then reads its pieces, thousands of ids each, and holds one at a time.
    """
    order = (*_NODE, "conv_id")
    pieces = (
        rows.where(F.col("depth") == F.col("length")).select(*order)
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_listed, _CHUNK)
    )
    return pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(_digested, _DIGEST)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of rebuilt conversations.

    ``conversations`` has conv_id, turn, role, text; other columns are not read. Rows
    without an id belong to none. Turns are ordered by number, null first, then by
    role and text; each row is a turn, repeated or not. A null role or text is
    empty. Conversation c takes the first h turns of c - c % 5, remainders as in SQL, and
    its own after its first h; h is crc32(c as text) % 9.

    Returns for each distinct beginning of rebuilt conversations: conv_id (its smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. An empty table has no root.
    """
    rows, nodes = _nodes(_turns(conversations))
    named = rows.select(
        "conv_id", F.struct(*_NODE).alias("node"), "depth", "length", "pb", (F.col("pb") - F.col("nb")).alias("above")
    )
    placed = stored(
        lookup(named, nodes.select("node", "owner", "deepest"), "node", hot_keys(nodes, "node", "members"), "conv_id"),
        "placed",
    )
    owns = F.col("owner") == F.col("conv_id")
    convs = stored(
        placed.groupBy("conv_id").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(F.when(owns, F.struct("depth", "above"))).alias("own"),
            F.max(F.when(~owns, F.struct("depth", "owner"))).alias("last"),
            F.max(F.struct("depth", "pb")).alias("end"),
            F.max(owns & (F.col("depth") == F.col("length")) & (F.col("deepest") == F.col("depth"))).alias("leaf"),
        ).select(
            "conv_id", "n_rows",
            # From this depth on the path is the conversation's own.
            F.coalesce("own.depth", F.col("end.depth") + 1).alias("from_depth"),
            F.coalesce("own.above", "end.pb").alias("shared"),
            F.col("last.owner").alias("parent"),
            F.col("leaf").cast("bigint").alias("leaf"),
        ),
        "owners",
    )
    known = lookup(
        placed.select("conv_id", "node", "depth", "length", "above"), convs.drop("n_rows"), "conv_id",
        hot_keys(convs, "conv_id", "n_rows"), "depth",
    )
    owned = F.col("from_depth") <= F.col("depth")
    summed = known.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.max(F.when(owned & (F.col("depth") > 0),
                     F.when(F.col("from_depth") < F.col("depth"), F.col("conv_id")).otherwise(F.col("parent"))))
        .alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count(F.when((F.col("from_depth") <= F.col("depth") + 1) & (F.col("depth") < F.col("length")), 1)).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.when(owned, 0).otherwise(F.col("shared") - F.col("above"))).alias("saved_tokens"),
    )
    ends = _ends(rows).select(F.struct(*_NODE).alias("node"), "ends_sha256")
    return summed.join(ends, "node", "left").select(
        "conv_id", F.col("node.depth").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
