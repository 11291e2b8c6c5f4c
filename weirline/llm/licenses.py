"""License scans: MinHash bands over overlapping windows, then exact containment.

Texts become words (runs of letters and digits, in lower case) and five-word shingles.
Templates are grouped into sizes s (powers of two, at least their number of shingles);
windows of 2 s shingles start every s, so a template's place always lies whole in one.
The MinHash values of a window and a template agree with the probability of their
Jaccard similarity, which containment bounds from below (``least_jaccard``); the
number of bands makes a miss of all of them as unlikely as ``miss``. A pair that agrees in a
band is verified on the shingles themselves.

A window without a single shingle of any template can hold none, so windows are
pruned by a lookup in the set of template shingles before they are hashed; templates are
a fixed list, so that set is bounded. Everything is built-in Spark expressions.

Defined results: null and empty texts and those of fewer than five words match nothing;
a text of any length is read whole; repeated rows give rows of their own; null ids are
kept; a template of fewer words than a shingle is refused; an empty table gives no rows;
columns besides id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices by license.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may "
    "not use this file except in compliance with the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
    "License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under "
    "the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy "
    "of this software and associated documentation files (the \"Software\"), to deal in the "
    "Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
    "2.0.",
}


@dataclass(frozen=True)
class Settings:
    templates: Mapping[str, str] = field(default_factory=lambda: dict(NOTICES))
    shingle: int = 5
    containment: float = 0.8
    miss: float = 1e-4
    max_template_shingles: int = 20_000


def words(text: Column) -> Column:
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _shingles(words: str, k: int, make) -> Column:
    """``make`` of each run of k words; empty where there are fewer."""
    return F.when(
        F.size(words) >= k,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: make(F.slice(words, i, F.lit(k)))
        ),
    )


def least_jaccard(shingles: int, size: int, containment: float) -> float:
    """Least similarity of a window of 2 size shingles and a template it contains."""
    shared = math.ceil(containment * shingles - 1e-9)
    return shared / (2 * size + shingles - shared)


def bands(size: int, containment: float, miss: float) -> int:
    """Bands of one value each, so that all differ with probability ``miss`` at most."""
    least = min(least_jaccard(n, size, containment) for n in range(size // 2 + 1, size + 1))
    return math.ceil(math.log(miss) / math.log1p(-least)) if least < 1 else 1


def _signature(hashes: Column, n: int) -> Column:
    """MinHash values of ``n`` hash functions over an array of shingle hashes."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(seed))))

    return F.array(*(least(seed) for seed in range(n)))


def _likely(starts: Column, size: int, every: list[int]) -> Column:
    """Starts of windows that hold a shingle of some template."""
    return F.filter(
        starts, lambda i: F.exists(F.slice("hashes", i, F.lit(2 * size)), lambda h: h.isin(every))
    )


def _window(size: int, k: int):
    return lambda i: F.struct(
        F.lit(size).alias("size"),
        i.alias("start"),
        F.slice("hashes", i, F.lit(2 * size)).alias("window"),
        F.slice("words", i, F.lit(2 * size + k - 1)).alias("inside"),
    )


def _template_rows(spark, settings: Settings) -> DataFrame:
    rows = spark.createDataFrame(sorted(settings.templates.items()), "license string, notice string")
    rows = rows.withColumn("words", words(F.col("notice")))
    text = _shingles("words", settings.shingle, lambda s: F.concat_ws(" ", s))
    hashed = _shingles("words", settings.shingle, lambda s: F.xxhash64(s))
    return rows.select(
        "license", F.array_distinct(text).alias("wanted"), F.array_distinct(hashed).alias("hashes")
    )


def scan(
    docs: DataFrame, settings: Settings | None = None, *, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document and license found: ``doc_id, license, n_windows`` (that hold it)
    and ``containment`` (the largest of them)."""
    settings, spark, k = settings or Settings(), docs.sparkSession, (settings or Settings()).shingle
    known = _template_rows(spark, settings).collect()  # the fixed list of templates
    for row in known:
        if not row["hashes"]:
            raise ValueError(f"template {row['license']} has fewer than {k} words")
    every = sorted({h for row in known for h in row["hashes"]})
    if len(every) > settings.max_template_shingles:
        raise ValueError("too many template shingles")
    sizes = {row["license"]: 1 << (len(row["hashes"]) - 1).bit_length() for row in known}

    read = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        words(F.col(text_col)).alias("words"),
    )
    hashed = read.withColumn("hashes", _shingles("words", k, lambda s: F.xxhash64(s)))
    hits = hashed.where(F.exists("hashes", lambda h: h.isin(every)))

    # Windows of all sizes are cut out inside the row; only those that may match leave it.
    cuts, signature, rows = [], None, []
    for size in sorted(set(sizes.values())):
        starts = F.sequence(F.lit(1), F.size("hashes"), F.lit(size))
        cuts.append(F.transform(_likely(starts, size, every), _window(size, k)))
        here = _signature(F.col("w.window"), bands(size, settings.containment, settings.miss))
        of_size = F.col("w.size") == size
        signature = F.when(of_size, here) if signature is None else signature.when(of_size, here)
    for row in known:
        size = sizes[row["license"]]
        rows.append((size, row["license"], row["wanted"], row["hashes"]))
    templates = spark.createDataFrame(
        rows, "size int, license string, wanted array<string>, window array<long>"
    )
    templates = templates.select("license", "wanted", F.struct("size", "window").alias("w"))
    templates = templates.select(
        "license", "wanted", F.col("w.size").alias("size"),
        F.posexplode(signature).alias("band", "value"),
    )
    cut_out = hits.select("row", "doc_id", F.explode(F.concat(*cuts)).alias("w"))
    signed = cut_out.select(
        "row", "doc_id", "w.size", "w.start", "w.inside",
        F.posexplode(signature).alias("band", "value"),
    )
    met = signed.join(F.broadcast(templates), ["size", "band", "value"])  # the fixed list
    pairs = met.groupBy("row", "doc_id", "size", "start", "license").agg(
        F.first("inside").alias("inside"), F.first("wanted").alias("wanted")
    )
    shingles = _shingles("inside", k, lambda s: F.concat_ws(" ", s))
    share = F.size(F.array_intersect("wanted", shingles)) / F.size("wanted")
    return (
        pairs.select("row", "doc_id", "license", share.alias("share"))
        .where(F.col("share") >= settings.containment)
        .groupBy("row", "doc_id", "license")
        .agg(F.count(F.lit(1)).alias("n_windows"), F.max("share").alias("containment"))
        .drop("row")
    )


def oracle_sql(settings: Settings | None = None) -> str:
    """The same by brute force: containment of each template in each window."""
    settings, k = settings or Settings(), (settings or Settings()).shingle
    listed = ", ".join(
        "('{}', '{}')".format(*(s.replace("'", "''") for s in item))
        for item in sorted(settings.templates.items())
    )
    split = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    shingled = (
        "list_transform(range(1, len({0}) - {1} + 2), "
        "lambda i: array_to_string({0}[i : i + {1} - 1], ' '))"
    )
    return f"""
WITH notices(license, notice) AS (VALUES {listed}),
spelled AS (SELECT license, {split.format("notice")} AS w FROM notices),
templates AS (
    SELECT license, list_distinct({shingled.format("w", k)}) AS wanted FROM spelled
),
sized AS (
    SELECT license, wanted, CAST(pow(2, ceil(log2(len(wanted)))) AS BIGINT) AS size
    FROM templates
),
texts AS (
    SELECT row_number() OVER () AS row, doc_id, {split.format("text")} AS w FROM documents
),
shingles AS (
    SELECT row, doc_id, {shingled.format("w", k)} AS s FROM texts WHERE len(w) >= {k}
),
likely AS (
    SELECT * FROM shingles
    WHERE list_has_any(s, (SELECT list(x) FROM (SELECT unnest(wanted) AS x FROM templates)))
),
windows AS (
    SELECT row, doc_id, s, size, unnest(range(1, len(s) + 1, size)) AS start
    FROM likely, (SELECT DISTINCT size FROM sized)
),
shares AS (
    SELECT row, doc_id, license,
        len(list_intersect(wanted, s[start : start + 2 * windows.size - 1])) / len(wanted) AS share
    FROM windows JOIN sized ON windows.size = sized.size
)
SELECT doc_id, license, count(*) AS n_windows, max(share) AS containment
FROM shares WHERE share >= {settings.containment}
GROUP BY row, doc_id, license
"""
