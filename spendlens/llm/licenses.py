"""License scans: MinHash bands over text windows find templates, shingles verify them.

Texts and templates become shingles of five words. A template with t shingles has
the size class c, the power of two with c / 2 < t <= c. Windows of 3c shingles that
begin every c shingles see any occurrence of up to 2c shingles whole. Where a share
of ``containment`` of the template is in such a window, the two sets have a Jaccard
similarity of at least ``containment * c / 2`` to ``3c + (1 - containment) * c / 2``,
about 0.13, so one-row bands collide with a probability of 1 - (1 - 0.13)^bands. The
number of bands follows from the probability asked for (``band_count``).

The hash family is h xor a constant: for hashes that are uniform the smallest
value falls on any element of a set alike, and constants that differ in their
leading bits start from different places.

A window can collide only where it holds a shingle that is the smallest of some
template of its class in some band. Those few shingles are known beforehand; windows
without one are never built. That changes no result, since such windows collide with
nothing.

A template of fewer than five words is one shingle of its own length. It needs no
bands: each place with its hash gives a window and is verified like the others. Its
size class is written as its number of words below zero.
"""

from __future__ import annotations

import math
from functools import reduce
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.common import mixed, stored

SHINGLE = 5
CONTAINMENT = 0.8

#: Probability that a window with a template collides with it in some band.
RETRIEVED = 0.999

#: Band minima that go into one scan as constants. More templates are looked for in several scans.
MINIMA_PER_SCAN = 20_000

# Wording of common license notices.
NOTICES = (
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy "
     "of this software and associated documentation files"),
    ("BSD-redistribution", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
)

#: Whole texts of common licenses, one file each.
TEXTS = Path(__file__).parent / "license_texts"


def known_texts() -> list[tuple[str, str]]:
    """Name and wording of the notices and of the whole licenses (``MIT-text`` and so on)."""
    files = sorted(TEXTS.glob("*.txt"))
    return [*NOTICES, *((f"{f.stem}-text", f.read_text(encoding="utf-8")) for f in files)]


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_texts(), "license string, text string")


def band_count(containment: float = CONTAINMENT, retrieved: float = RETRIEVED) -> int:
    """Bands of one row that collide with the probability asked for in the worst case."""
    least = containment / 2
    similarity = least / (3 + 0.5 - least)
    return math.ceil(math.log(1 - retrieved) / math.log(1 - similarity))


def _words(text: Column) -> Column:
    """Words in lower case: letters and digits of any script."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _shingles(words: Column, as_hash: bool, length: int = SHINGLE) -> Column:
    """Shingle hashes of ``words``, which must be a column or variable; texts of fewer words have none."""
    starts = F.when(
        F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)
    ).otherwise(F.array().cast("array<int>"))

    def parts(start: Column) -> list[Column]:
        return [words[start + k] for k in range(length)]

    if as_hash:
        return F.transform(starts, lambda i: F.xxhash64(*parts(i)))
    return F.transform(starts, lambda i: F.concat_ws(" ", *parts(i)))


def _shingles_of(words: Column, as_hash: bool, length: Column) -> Column:
    """The same with a length that differs by row: a hash of an array is that of its elements."""
    starts = F.when(
        F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)
    ).otherwise(F.array().cast("array<int>"))
    if as_hash:
        return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, length)))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, length), " "))


def _least(hashes: Column, constant: int) -> Column:
    least = F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(constant))))
    return least.bitwiseXOR(F.lit(constant))


def _bands(hashes: Column, bands: int) -> Column:
    """The smallest hash of each band, as the hash itself."""
    constants = mixed(np.arange(1001, 1001 + bands, dtype=np.uint64)).view(np.int64).tolist()
    return F.array(*[_least(hashes, c) for c in constants])


def _windows(places: Column, size_class: int) -> Column:
    """Windows of a class that hold one of the places."""
    c = size_class

    def over(place: Column) -> Column:
        last = F.floor(place / c)
        return F.sequence(F.greatest(F.lit(0).cast("bigint"), last - 2), last)

    numbers = F.array_distinct(F.flatten(F.transform(places, over)))
    return F.transform(
        numbers,
        lambda k: F.struct(F.lit(c).alias("size_class"), (k * c).cast("int").alias("start")),
    )


def _template_table(templates: DataFrame, bands: int, license_col: str, text_col: str) -> DataFrame:
    """Per template: class, shingles and band minima; of one of fewer than five words its one hash."""
    words = templates.select(
        F.col(license_col).cast("string").alias("license"), _words(F.col(text_col)).alias("words")
    ).where(F.size("words") > 0)
    # Written out, so that no use of a word splits its text again.
    words = stored(words.distinct(), "license-words")
    hashed = words.withColumn("length", F.least(F.size("words"), F.lit(SHINGLE))).select(
        "license",
        "length",
        F.array_distinct(_shingles_of(F.col("words"), False, F.col("length"))).alias("template"),
        _shingles_of(F.col("words"), True, F.col("length")).alias("hashes"),
    )
    short = F.col("length") < SHINGLE
    size = F.ceil(F.log2(F.size("template").cast("double"))).cast("int")
    return hashed.select(
        "license", "template",
        F.when(short, -F.col("length")).otherwise(F.pow(F.lit(2), size).cast("int")).alias("size_class"),
        F.when(short, F.col("hashes")).otherwise(_bands(F.col("hashes"), bands)).alias("minima"),
    )


def find_licenses(
    docs: DataFrame,
    templates: DataFrame,
    containment: float = CONTAINMENT,
    retrieved: float = RETRIEVED,
    id_col: str = "doc_id",
    text_col: str = "text",
    license_col: str = "license",
    template_text_col: str = "text",
) -> DataFrame:
    """Licenses found in each document.

    Returns ``id_col``, ``license``, ``containment`` (largest share of the template's
    shingles in one window) and ``first_word`` (first word of the first such window),
    one row for each document row and license found; documents without one give no
    row. Null and empty texts have no shingles. Templates with fewer than five words are
    found where all their words follow one another, those without words never.
    Templates that repeat count once; two texts under one name give the better of both.
    Repeated document rows are reported each, null ids too; they are told apart by their
    place in the scan, so a table that itself depends on a shuffle should be stored first.
    Extra columns are ignored. Empty tables give no rows.
    """
    bands = band_count(containment, retrieved)
    known = _template_table(templates, bands, license_col, template_text_col)
    # A template has one minimum per band at most. All texts of a name are in one scan.
    scans = max(1, math.ceil(known.count() * bands / MINIMA_PER_SCAN))
    found = [
        _scan(docs, known.where(F.pmod(F.xxhash64("license"), F.lit(scans)) == i), bands, containment, id_col, text_col)
        for i in range(scans)
    ]
    return reduce(DataFrame.unionByName, found)


def _scan(docs: DataFrame, known: DataFrame, bands: int, containment: float, id_col: str, text_col: str) -> DataFrame:
    """One look through all documents for the given templates."""
    minima: dict[int, set[int]] = {}
    for r in known.select("size_class", "minima").collect():
        minima.setdefault(r["size_class"], set()).update(r["minima"])
    every_minimum = sorted(set().union(*minima.values()))
    classes = sorted(c for c in minima if c > 0)
    lengths = sorted(-c for c in minima if c < 0)

    def marked(h: Column, among) -> Column:
        return h.isin(*sorted(among)) if among else F.lit(False)

    def places(hashes: Column, among) -> Column:
        found = F.transform(hashes, lambda h, i: F.when(marked(h, among), F.struct(i.alias("at"), h.alias("hash"))))
        return F.filter(found, lambda p: p.isNotNull())

    def of_class(c: int) -> Column:
        mine = F.filter("places", lambda p: marked(p["hash"], minima[c]))
        return F.transform(
            _windows(F.transform(mine, lambda p: p["at"]), c),
            lambda w: F.struct(w["size_class"].alias("size_class"), w["start"].alias("start"), F.lit(None).cast("bigint").alias("hash")),
        )

    def of_length(n: int) -> Column:
        # Windows of three shingles, as those of any one-shingle template.
        return F.transform(
            places(_shingles(F.col("words"), True, n), minima[-n]),
            lambda p: F.struct(F.lit(-n).alias("size_class"), F.greatest(F.lit(0), p["at"] - 2).alias("start"), p["hash"].alias("hash")),
        )

    words = docs.select(F.col(id_col), _words(F.col(text_col)).alias("words"))
    hashed = words.withColumn("hashes", _shingles(F.col("words"), True))
    none = F.array().cast("array<struct<size_class:int,start:int,hash:bigint>>")
    # The row number keeps later filters above this projection: texts are hashed once.
    placed = hashed.select(
        F.monotonically_increasing_id().alias("row"), id_col, "words", "hashes",
        places(F.col("hashes"), set().union(*[minima[c] for c in classes])).alias("places"),
        F.concat(none, *[of_length(n) for n in lengths]).alias("short"),
    )
    every = F.concat("short", *[of_class(c) for c in classes])
    whole = F.col("window.size_class") > 0
    n_shingles = F.when(whole, 3 * F.col("window.size_class")).otherwise(3)
    length = F.when(whole, SHINGLE).otherwise(-F.col("window.size_class"))
    windows = placed.where((F.size("places") > 0) | (F.size("short") > 0)).select(
        "row", id_col, "words", "hashes", F.explode(every).alias("window")
    ).select(
        "row", id_col, F.col("window.size_class").cast("int").alias("size_class"), "window.start",
        F.slice("words", F.col("window.start") + 1, n_shingles + length - 1).alias("words"),
        F.when(whole, _bands(F.slice("hashes", F.col("window.start") + 1, n_shingles), bands))
        .otherwise(F.array("window.hash"))
        .alias("minima"),
    )
    hit = F.filter(
        F.transform("minima", lambda m, j: F.struct(j.alias("band"), m.alias("least"))),
        lambda x: marked(x["least"], every_minimum),
    )
    bands_of = known.select("license", "template", "size_class", F.posexplode("minima").alias("band", "least"))
    candidates = (
        windows.select("row", id_col, "size_class", "start", "words", F.explode(hit).alias("hit"))
        .select("row", id_col, "size_class", "start", "words", "hit.band", "hit.least")
        .join(bands_of, ["size_class", "band", "least"])
        .groupBy("row", id_col, "size_class", "start", "words", "license", "template")
        .agg(F.count(F.lit(1)).alias("bands"))
    )
    length = F.when(F.col("size_class") > 0, SHINGLE).otherwise(-F.col("size_class"))
    shingles = _shingles_of(F.col("words"), False, length) if lengths else _shingles(F.col("words"), False)
    held = F.size(F.array_intersect(shingles, F.col("template")))
    verified = candidates.withColumn("held", held).where(
        F.col("held") * 100 >= round(containment * 100) * F.size("template")
    )
    return (
        verified.groupBy("row", id_col, "license")
        .agg(
            F.max(F.col("held") / F.size("template")).alias("containment"),
            F.min("start").cast("bigint").alias("first_word"),
        )
        .drop("row")
    )
