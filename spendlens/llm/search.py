"""Ranked lexical search by NRA: impact-sorted lists read in sequence, score intervals per document.

Documents are indexed in shards, each a bounded number of postings held by one
row: term, document and number of occurrences, and what the shard adds to the
corpus counts. An index row needs no shuffle, so a term that stands in every
document is no burden to one task.

Once the counts of the whole corpus are known, each shard is searched by itself.
The list of a term is sorted by what a posting adds to a score, highest first.
Lists are read from the top, level by level. A document's score lies between what
was read of it (lower) and that plus the next unread value of every list it was
not met in (upper); a document not met at all has the sum of all next values as
its upper end. Reading goes on until no other document can reach the k-th lower
end, ties included, and every document that can is known exactly. No document is
looked up by its number. The best of all shards are the best of the corpus.

Queries are taken in blocks of bounded size; one block's vocabulary and lists of
terms travel with the tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlens.llm.common import NO_ID, stored

#: ASCII characters but letters and digits part terms; A-Z become a-z; other bytes stay.
_TERMS = bytes(
    c if c > 127 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32
    for c in range(256)
)

#: Bytes of a text split at a time, postings of an index row, and of rows searched together.
PART = 1 << 20
SHARD_POSTINGS = 1 << 17
SEARCH_POSTINGS = 1 << 21

#: Queries and bytes of query text in a block.
BLOCK_ITEMS = 4096
BLOCK_BYTES = 8 << 20

_SHARD = (
    "n_docs bigint, n_terms bigint, ids array<bigint>, sizes array<bigint>, "
    "term array<int>, doc array<int>, tf array<bigint>"
)
_ARROW = pa.schema([
    ("n_docs", pa.int64()), ("n_terms", pa.int64()),
    ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
    ("term", pa.list_(pa.int32())), ("doc", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64())),
])


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text with repeats, in lists of bounded size."""
    start = 0
    while start < len(text):
        end = min(len(text), start + PART)
        # A part ends where a term cannot go on.
        while end < len(text) and _TERMS[text[end]] != 32:
            end += 1
        yield text[start:end].translate(_TERMS).split()
        start = end


class _Shard:
    """Postings of some documents, up to the terms that queries name."""

    def __init__(self) -> None:
        self.n_docs = self.n_terms = self.n_postings = 0
        self.ids, self.sizes, self.found = [], [], []

    def add(self, doc_id: int | None, text: bytes, vocabulary: dict[bytes, int]) -> None:
        n, counts = 0, Counter()
        for part in terms(text):
            n += len(part)
            counts.update(vocabulary[t] for t in part if t in vocabulary)
        self.n_docs += n > 0
        self.n_terms += n
        if counts:
            self.ids.append(NO_ID if doc_id is None else doc_id)
            self.sizes.append(n)
            self.found.append(counts)
            self.n_postings += len(counts)

    def row(self) -> pa.RecordBatch:
        doc = np.repeat(np.arange(len(self.found)), [len(c) for c in self.found])
        term = np.fromiter((t for c in self.found for t in c), np.int32, self.n_postings)
        tf = np.fromiter((n for c in self.found for n in c.values()), np.int64, self.n_postings)
        order = np.argsort(term, kind="stable")
        values = ([self.n_docs], [self.n_terms], [self.ids], [self.sizes],
                  [term[order]], [doc[order].astype(np.int32)], [tf[order]])
        return pa.record_batch([pa.array(v, f.type) for v, f in zip(values, _ARROW)], schema=_ARROW)


def index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Shards of the documents: counts, and postings of the vocabulary's terms by number."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                shard.add(doc_id.as_py(), text.as_py() or b"", vocabulary)
                if shard.n_postings >= SHARD_POSTINGS:
                    yield shard.row()
                    shard = _Shard()
        yield shard.row()

    read = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return read.mapInArrow(build, _SHARD)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the k best documents, by score and then by id.

    Each list has document numbers and what they score there, highest first, above 0.
    """
    low = np.zeros(len(ids), np.int64)
    met = np.zeros((len(lists), len(ids)), bool)
    at = np.zeros(len(lists), np.int64)
    following = np.array([score[0] for _, score in lists], np.int64)
    level = int(following.max(initial=0))
    #: Documents that can still be among the best; at first all.
    able = np.arange(len(ids))
    slot = able
    while True:
        level //= 2
        for i, (doc, score) in enumerate(lists):
            if not following[i]:
                continue
            end = int(np.searchsorted(-score, -level, "right"))
            place = slot[doc[at[i] : end]]
            kept = place >= 0
            low[place[kept]] += score[at[i] : end][kept]
            met[i, place[kept]] = True
            at[i], following[i] = end, score[end] if end < len(score) else 0
        theta = int(np.partition(low, len(low) - k)[len(low) - k]) if len(low) >= k else 0
        # With theta 0 fewer than k were met; a document not met must not reach the k-th.
        if following.any() and following.sum() >= theta:
            continue
        high = low + following @ ~met
        within = (high >= theta) & (high > 0)
        able, low, high, met = able[within], low[within], high[within], met[:, within]
        if (high == low).all():
            best = np.lexsort((ids[able], -low))[:k]
            return able[best], low[best]
        slot = np.full(len(ids), -1)
        slot[able] = np.arange(len(able))


def _search(queries: list[list[tuple[int, int]]], n_docs: int, n_terms: int, k: int):
    """Search function over index rows; a query lists term numbers and weights."""

    def found(shards: list[dict]) -> Iterator[pa.RecordBatch]:
        ids, doc, sizes, first = [], [], [], 0
        for s in shards:
            doc.append(s["doc"] + np.int64(first))
            ids.append(s["ids"])
            sizes.append(s["sizes"])
            first += len(s["ids"])
        ids, doc = np.concatenate(ids), np.concatenate(doc)
        term = np.concatenate([s["term"] for s in shards])
        tf = np.concatenate([s["tf"] for s in shards])
        m = 75 + 25 * np.concatenate(sizes) * n_docs // max(1, n_terms)
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
        order = np.lexsort((doc, -impact, term))
        term, doc, impact = term[order], doc[order], impact[order]
        out = [], [], []
        for number, query in enumerate(queries):
            lists = []
            for t, weight in query:
                a, b = np.searchsorted(term, [t, t + 1])
                b = a + int(np.searchsorted(-impact[a:b], 0))  # those above 0
                if b > a:
                    lists.append((doc[a:b], weight * impact[a:b]))
            if lists:
                best, score = nra(lists, ids, k)
                out[0].append(np.full(len(best), number))
                out[1].append(ids[best])
                out[2].append(score)
        if out[0]:
            query, doc_id, score = (np.concatenate(o) for o in out)
            yield pa.record_batch(
                [pa.array(query, pa.int64()), pa.array(doc_id, mask=doc_id == NO_ID), pa.array(score)],
                names=["query", "doc_id", "score"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append({c: batch.column(c)[i].values.to_numpy() for c in ("ids", "sizes", "term", "doc", "tf")})
                size += len(held[-1]["term"])
                if size >= SEARCH_POSTINGS:
                    yield from found(held)
                    held, size = [], 0
        if size:
            yield from found(held)

    return search


def _weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, first within parts, so that no task sees all shards' rows."""
    order = [F.desc("score"), F.coalesce("doc_id", F.lit(NO_ID))]
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    within = Window.partitionBy("query", F.pmod(F.xxhash64("doc_id"), F.lit(parts))).orderBy(*order)
    whole = Window.partitionBy("query").orderBy(*order)
    some = found.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def _block(spark: SparkSession, docs: DataFrame, rows: list, item_type, k: int, id_col: str, text_col: str) -> DataFrame:
    """Results of one block of queries, given as rows of (item_id, texts)."""
    named = [Counter(t for text in r["texts"] for part in terms(text.encode("utf-8", "surrogatepass")) for t in part)
             for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*named)))}
    shards = stored(index(docs, vocabulary, id_col, text_col), "search-index")
    total = shards.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    # One row for each term of the block at most.
    df = {r["t"]: r["df"] for r in shards.select(F.explode("term").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}
    n_docs = total["docs"] or 0
    weight = {t: _weight(n_docs, df[i]) for t, i in vocabulary.items() if i in df}
    queries = [
        [(vocabulary[t], n * weight[t]) for t, n in sorted(q.items()) if weight.get(t, 0) > 0] for q in named
    ]
    found = shards.mapInArrow(
        _search(queries, n_docs, total["terms"] or 0, k), "query bigint, doc_id bigint, score bigint"
    )
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                  f"query bigint, item_id {item_type}")
    return _best(found, k).join(names, "query").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 20,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank from 1, doc_id, score above 0.

    Every row of ``docs`` is a document of its own, repeated or not; rows that repeat an
    id and score alike take ranks next to each other. A null id comes after all others
    of its score. Null, empty and termless texts count in nothing and are never found.
    Rows of ``items`` that repeat an id are one query with the terms of all their
    different texts; a null id is a query like any other. An item without terms has no
    rows, and an empty table gives none. Columns besides id and text are not read.
    """
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    read = (
        items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
        .groupBy("item_id").agg(F.sort_array(F.collect_set("text")).alias("texts"))
    )
    size = read.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.aggregate("texts", F.lit(0).cast("bigint"), lambda a, t: a + F.octet_length(t))).alias("bytes"),
    ).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for b in range(blocks):
        rows = read.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        if rows:
            found = found.unionByName(_block(spark, docs, rows, kind, k, id_col, text_col))
    return found
