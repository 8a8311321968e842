"""License scans: MinHash bands of overlapping windows retrieve templates, shingle containment verifies them."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Notices of common licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MIT": "Released under the MIT License",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
WORDS = 5
CONTAINED = (80, 100)
# A window is two neighbouring shingles, so windows overlap by one. One hash makes a band.
BANDS = 12
SEED = 23


def license_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _masks() -> list[int]:
    """One number for each band; ``hash ^ mask`` orders hashes in another way for each."""
    rng = random.Random(SEED)
    return [rng.getrandbits(64) - (1 << 63) for _ in range(BANDS)]


def _window_hashes(words: int) -> str:
    """SQL for the hashes of all runs of ``words`` words of the array ``_words``."""
    run = ", ".join(f"_words[i + {k}]" for k in range(words))
    return f"case when size(_words) >= {words} then transform(sequence(0, size(_words) - {words}), i -> xxhash64({run})) else array() end"


def _held(df: DataFrame, name: str, expression: str | Column) -> DataFrame:
    """Adds a column that is computed once a row.

    As the output of a generator it is not written out again inside a filter
    or a lambda that uses it, where it would be computed for each element.
    """
    value = F.expr(expression) if isinstance(expression, str) else expression
    return df.select("*", F.explode(F.array(value)).alias(name))


def _prepared(spark: SparkSession, templates: dict[str, str], words: int) -> list[tuple[str, list[str], list[int]]]:
    """(license, distinct shingles, shingle hashes) of each template. Templates are a fixed list, not data."""
    df = spark.createDataFrame(list(templates.items()), "license string, text string")
    df = _held(df, "_words", license_words(F.col("text"))).where(f"size(_words) >= {words}")
    runs = f"array_distinct(transform(sequence(1, size(_words) - {words - 1}), i -> array_join(slice(_words, i, {words}), ' ')))"
    return [tuple(r) for r in df.select("license", F.expr(runs), F.expr(_window_hashes(words))).collect()]


def license_scan(
    df: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    words: int = WORDS,
    contained: tuple[int, int] = CONTAINED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, license, containment, first_word): templates of which a text holds at least the share ``contained``.

    A text is the sequence of its lower-case runs of letters and digits, a
    shingle is a run of ``words`` of them. Windows of two neighbouring
    shingles, one at each place of the whole text, get one MinHash for each of
    12 bands. A window is retrieved if it shares a band with a window of a
    template, so a window that stands in a template is always retrieved; a
    template of one shingle lies in two windows of similarity 1/2, which both
    miss all bands with probability 3 ** -12. Around each retrieved window, as
    far as the template is long, the share of the template's distinct shingles
    that stand there is counted exactly. ``first_word`` is the place of the first
    of them.

    One row for each row of ``df`` and each template that it holds. Texts and
    templates shorter than a shingle match nothing. Rows stay where they are,
    nothing is shuffled, and all of it is SQL functions. Other columns are
    ignored, repeated rows each count.
    """
    spark = df.sparkSession
    part, whole = contained
    prepared = _prepared(spark, templates, words)
    if not prepared:
        return df.select(F.col(id_column)).limit(0).selectExpr(
            id_column, "'' as license", "0D as containment", "0L as first_word"
        )
    tests = []
    for m in _masks():
        keys = sorted({min(x ^ m for x in h[k : k + 2]) for *_, h in prepared for k in range(max(1, len(h) - 1))})
        tests.append(f"least(a ^ {m}L, b ^ {m}L) in ({', '.join(f'{k}L' for k in keys)})")
    rows = _held(df.select(F.col(id_column), F.col(text_column)), "_words", license_words(F.col(text_column)))
    rows = _held(rows.select(id_column, "_words"), "_hashes", _window_hashes(words))
    retrieved = f"zip_with(_hashes, slice(_hashes, 2, greatest(size(_hashes), 1)), (a, b) -> {' or '.join(tests)})"
    rows = _held(rows, "_hits", retrieved).where("array_contains(_hits, true)").drop("_hashes")
    runs = f"transform(sequence(1, size(_hits)), i -> array_join(slice(_words, i, {words}), ' '))"
    rows = _held(_held(rows, "_shingles", runs), "_at", "filter(sequence(1, size(_hits)), i -> _hits[i - 1])")
    known = F.array(
        *[F.struct(F.lit(k).alias("license"), F.array(*map(F.lit, own)).alias("_own")) for k, own, _ in prepared]
    )
    each = rows.select(id_column, "_shingles", "_at", F.explode(known).alias("t"))
    each = each.select(id_column, "_shingles", "_at", "t.license", "t._own")
    region = "sequence(greatest(1, p - size(_own)), least(size(_shingles), p + 1 + size(_own)))"
    found = (
        f"transform(_at, p -> transform(array(filter({region}, i -> array_contains(_own, _shingles[i - 1]))), "
        "f -> named_struct('n', size(array_distinct(transform(f, i -> _shingles[i - 1]))), 'first', array_min(f)))[0])"
    )
    each = _held(_held(each, "_found", found), "_good", f"filter(_found, x -> {whole} * x.n >= {part} * size(_own))")
    each = each.where("size(_good) > 0")
    return each.select(
        id_column,
        "license",
        F.expr("array_max(transform(_good, x -> x.n)) / size(_own)").alias("containment"),
        F.expr("array_min(transform(_good, x -> x.first)) - 1").cast("long").alias("first_word"),
    )


def oracle(templates: dict[str, str] = TEMPLATES, words: int = WORDS, contained: tuple[int, int] = CONTAINED) -> str:
    """The same in SQL, without retrieval: every place where a shingle of a template stands is looked at."""
    quoted = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in templates.items())
    split = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    runs = f"list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))"
    return f"""
        WITH t AS (SELECT license, list_distinct({runs}) AS own FROM (
                SELECT license, {split.format('text')} AS w FROM (VALUES {quoted}) v(license, text))),
        ts AS (SELECT license, own, unnest(own) AS shingle FROM t),
        d AS (SELECT doc_id, {runs} AS s FROM (SELECT doc_id, {split.format('text')} AS w FROM documents) WHERE len(w) >= {words}),
        p AS (SELECT doc_id, unnest(s) AS shingle, unnest(range(1, len(s) + 1)) AS p FROM d),
        a AS (SELECT doc_id, license, own, p.p FROM p JOIN ts ON p.shingle = ts.shingle),
        m AS (SELECT a.doc_id, a.license, a.p, len(a.own) AS n,
                len(list_distinct(list_intersect(a.own, d.s[greatest(1, a.p - len(a.own)):a.p + 1 + len(a.own)]))) AS k
              FROM a JOIN d ON a.doc_id = d.doc_id)
        SELECT doc_id, license, CAST(max(k) AS DOUBLE) / max(n) AS containment, min(p) - 1 AS first_word
        FROM m WHERE {contained[1]} * k >= {contained[0]} * n GROUP BY doc_id, license"""
