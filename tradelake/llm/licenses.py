"""Licence scans: TF-IDF cosine to notices and to full texts, then inheritance from ancestor folders.

Notices are compared with lines and with runs of sentences and lines, so that wrapped headers and
notices within a paragraph count; full texts with whole files and with what follows their first words.

Only DataFrame and SQL functions run on the rows.
"""

from __future__ import annotations

import itertools
import math
import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import packed, quoted, stored

#: Notices by licence, in words of our own; any number per licence.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This software is distributed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is made available under version 2.0 of the Apache License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Free software under the GNU GPL version 3 or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a three clause BSD style license."),
    ("MPL-2.0", "This file is subject to the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Apache License, Version 2.0, January 2004"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU General Public License, Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License, Version 3, 29 June 2007"),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "GNU Lesser General Public License, Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License, Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License, Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    *(
        (
            licence,
            f"This {what} is free software{stop} you can redistribute it and/or modify it under the terms of the GNU {kind}General"
            f" Public License as published by the Free Software Foundation{either} either version {version} of the License, or (at"
            " your option) any later version.",
        )
        for licence, what, stop, kind, either, version in (
            ("GPL-2.0", "program", ";", "", ";", "2"),
            ("GPL-3.0", "program", ":", "", ",", "3"),
            ("LGPL-2.1", "library", ";", "Lesser ", ";", "2.1"),
            ("LGPL-3.0", "library", ":", "Lesser ", ",", "3"),
            ("AGPL-3.0", "program", ":", "Affero ", ",", "3"),
        )
    ),
]
#: Cosine from which a line, or a run of sentences, states a template's licence.
LEAST = 0.8
#: Full texts by licence, without what varies: a title of choice and the holder.
BODIES = [(p.stem, p.read_text("utf-8")) for p in sorted(Path(__file__).with_name("licence_texts").glob("*.txt"))]
#: Cosine from which a text is a full licence.
LEAST_BODY = 0.9
#: First words of a full text, by which it is found inside a longer one.
OPENING = 6
#: What any licence may say besides: it counts if nothing else is stated.
WEAK = "proprietary"
#: Lines of lower-cased texts that name holders.
HOLDERS = r"(?m)^[^a-z0-9\n]*(?:copyright[ \t]+(?:\(c\)|©|[0-9]{4}|<|\[)|\(c\)|©|all rights reserved)[^\n]*$"
#: A version: one digit, perhaps a point and more.
VERSION = r"(?<![a-z0-9.])v?([0-9](?:\.[0-9]+)?)(?![a-z0-9])(?!\.[0-9])"
#: Names of files that speak for their folder and what is below it.
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)([.-][^/]*)?$"
WORD = "[a-z0-9]+"


def _words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def _versions(text: str) -> list[str]:
    return sorted({v.removesuffix(".0") for v in re.findall(VERSION, text.lower())})


def _plain(text: str) -> str:
    """Words of a text less the lines that name holders, with one blank between."""
    return " ".join(_words(re.sub(HOLDERS, "", text.lower())))


def _weights(templates: list[tuple[str, str]], idf: dict[str, float], *, damped: bool = False) -> list[dict[str, float]]:
    """Unit vectors of the templates; ``damped`` counts of words grow by their logarithm."""
    out = []
    for _, text in templates:
        words = _words(text)
        counts = {w: words.count(w) for w in words}
        vector = {w: (1 + math.log(c) if damped else c) * idf[w] for w, c in counts.items()}
        norm = math.sqrt(sum(x * x for x in vector.values()))
        out.append({w: x / norm for w, x in vector.items()})
    return out


def _anchors(vectors: list[dict[str, float]], least: float) -> list[str]:
    """Words one of which a line must have to reach ``least`` with any template.

    Of each template the heaviest words, until those left have a norm below ``least``: a line with
    none of them has a smaller cosine, whatever else it holds.
    """
    out: set[str] = set()
    for vector in vectors:
        rest = sum(x * x for x in vector.values())
        for w in sorted(vector, key=lambda w: (-vector[w], w)):
            if rest < least * least:
                break
            out.add(w)
            rest -= vector[w] ** 2
    return sorted(out)


def _any(words: list[str]) -> str:
    """Pattern of any of the words as a whole; by first letters, as Java tries branches one by one."""
    parts = []
    for two, some in itertools.groupby(sorted(words), lambda w: w[:2]):
        parts.append(two + "(?:" + "|".join(w[2:] for w in sorted(some, key=lambda w: (-len(w), w))) + ")")
    letters = itertools.groupby(parts, lambda x: x[0])
    return "(?<![a-z0-9])(?:" + "|".join(c + "(?:" + "|".join(x[1:] for x in some) + ")" for c, some in letters) + ")(?![a-z0-9])"


def _passages(most: int, pattern: str, vocabulary: list[str], ratio: float) -> F.Column:
    """Distinct lines of ``text``, and runs of sentences of up to ``most`` words, that match ``pattern``.

    A sentence ends at a stop or a line's end, so a run may start and end within lines.  Runs that
    start or end with a sentence without a word of the templates are left out: without it their
    cosines are larger.  So are passages with so many other words that no cosine can be reached: the
    square of their weight, one word each at least, must not pass ``ratio`` times the squared counts
    of the templates' words.
    """
    anchor, word = (f"'{x.replace(chr(92), chr(92) * 2)}'" for x in (pattern, _any(vocabulary)))
    sentence = f"struct(trim(s) as s, size(regexp_extract_all(s, '{WORD}', 0)) as n, s rlike {anchor} as a, s rlike {word} as v)"
    units = f"filter(transform(split(text, '\\\\n|(?<=[.!?])\\\\s+'), s -> {sentence}), x -> x.n > 0)"
    start = "struct(cast(null as string) as s, 0 as n, false as a, cast(array() as array<string>) as found)"
    longer = "concat_ws(' ', r.s, y.s)"
    step = (
        f"if(r.n + y.n > {most}, struct(r.s as s, {most} + 1 as n, r.a as a, r.found as found), struct({longer} as s, r.n + y.n as n,"
        f" r.a or y.a as a, if(y.v and (r.a or y.a), concat(r.found, array({longer})), r.found) as found))"
    )
    near = f"slice(u, i + 1, {most})"
    runs = f"if(x.v and exists({near}, y -> y.a), aggregate({near}, {start}, (r, y) -> {step}).found, cast(array() as array<string>))"
    windows = f"element_at(transform(array({units}), u -> flatten(transform(u, (x, i) -> {runs}))), 1)"
    lines = f"filter(transform(split(text, '\\\\n'), s -> trim(s)), s -> s rlike {anchor})"
    squares = "aggregate(array_distinct(h), 0L, (q, w) -> q + size(filter(h, o -> o = w)) * size(filter(h, o -> o = w)))"
    others = f"size(regexp_extract_all(s, '{WORD}', 0)) - size(h)"
    likely = f"element_at(transform(array(regexp_extract_all(s, {word}, 0)), h -> {others} <= {ratio!r}D * {squares}), 1)"
    return F.expr(f"filter(array_distinct(concat({lines}, {windows})), s -> {likely})")


def _full_texts(bodies: list[str]) -> F.Column:
    """``text`` as a whole in plain words, and of each full text what follows its first words, to its length."""
    plain = f"trim(regexp_replace(regexp_replace(text, '{HOLDERS.replace(chr(92), chr(92) * 2)}', ''), '[^a-z0-9]+', ' '))"
    after = []
    for opening, lengths in itertools.groupby(sorted(bodies, key=_opening), _opening):
        for length in sorted({len(x) for x in lengths}):
            after.append(f"transform(filter(split(t, '{opening}', -1), (s, k) -> k > 0), s -> concat('{opening}', left(s, {length - len(opening)})))")
    return F.expr(f"element_at(transform(array({plain}), t -> array_distinct(concat(array(t), {', '.join(after)}))), 1)")


def _opening(plain: str) -> str:
    return " ".join(plain.split()[:OPENING])


def _alike(
    passages: DataFrame,
    templates: list[tuple[str, str]],
    vectors: list[dict[str, float]],
    idf: dict[str, float],
    other: float,
    least: float,
    *,
    damped: bool = False,
) -> DataFrame:
    """``path, cosine, licence`` of passages ``path, of, at, s, versions`` that reach ``least``.

    A passage that names versions, none of which is the template's, doesn't state its licence.
    """
    key = ["path", "of", "at", "versions"]
    words = passages.select(*key, F.explode(F.regexp_extract_all("s", F.lit(WORD), F.lit(0))).alias("w"))
    counts = words.groupBy(*key, "w").agg(F.count(F.lit(1)).alias("tf"))
    # a row per word of the templates, with its part in each of them: bounded by the templates
    known = passages.sparkSession.createDataFrame(
        [(w, idf[w], [v.get(w, 0.0) for v in vectors]) for w in idf], "w string, idf double, parts array<double>"
    )
    tf = F.lit(1.0) + F.log("tf") if damped else F.col("tf")
    weighed = counts.join(F.broadcast(known), "w", "left").withColumn("x", tf * F.coalesce("idf", F.lit(other)))
    dots = [F.sum(F.col("x") * F.coalesce(F.element_at("parts", k + 1), F.lit(0.0))).alias(f"d{k}") for k in range(len(vectors))]
    scored = weighed.groupBy(*key).agg(F.sum(F.col("x") ** 2).alias("norm"), *dots)

    def cosine(k: int, text: str) -> F.Column:
        value = F.col(f"d{k}") / F.sqrt("norm")
        if damped or not (own := _versions(text)):
            return value
        named = F.split("versions", " ")
        return F.when((F.col("versions") == "") | F.arrays_overlap(named, F.array(*map(F.lit, own))), value)

    parts = (F.struct(cosine(k, text).alias("cosine"), F.lit(name).alias("licence")) for k, (name, text) in enumerate(templates))
    found = scored.select("path", F.explode(F.array(*parts)).alias("f")).where(F.col("f.cosine") >= least)
    return found.select("path", "f.cosine", "f.licence")


def stated(
    files: DataFrame,
    templates: list[tuple[str, str]],
    *,
    bodies: list[tuple[str, str]] | None = None,
    path_col: str = "path",
    text_col: str = "text",
    least: float = LEAST,
) -> DataFrame:
    """``path, licence`` of the files that state a template's licence or hold one of the ``bodies``.

    Every line of every text counts, and every run of sentences of up to one and a half times the
    longest template.  A text holds a body if all of it, or as much as the body is long from the body's first
    words on, reaches LEAST_BODY; lines that name holders are left out there, and counts of words are
    damped.  Document frequencies of the templates' words are taken over all texts; any other word
    weighs as one that a single text has.  Of several licences in a file the one of the largest
    cosine wins, then the first by name; WEAK comes after all others.
    """
    bodies = [(name, _plain(text)) for name, text in bodies or []]
    notice_words = {w for _, text in templates for w in _words(text)}
    vocabulary = sorted(notice_words | {w for _, text in bodies for w in text.split()})
    rows = files.select(quoted(path_col).alias("path"), F.lower(quoted(text_col)).alias("text"))
    texts = rows.where("path IS NOT NULL AND text IS NOT NULL")
    held = F.array_intersect(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.split(F.lit(" ".join(vocabulary)), " "))
    # an empty entry per text counts the texts in the same pass
    entries = texts.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("w"))
    seen = {r.w: r.n for r in entries.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = seen.get("", 0)
    idf = {w: math.log((1 + n) / (1 + seen.get(w, 0))) + 1 for w in vocabulary}
    other = math.log((1 + n) / 2) + 1 if n else 1.0

    def passages(pattern: str, of: F.Column) -> DataFrame:
        named = F.transform(F.regexp_extract_all("s", F.lit(VERSION), F.lit(1)), lambda v: F.regexp_replace(v, r"\.0$", ""))
        some = texts.where(F.col("text").rlike(pattern)).select("path", F.xxhash64("text").alias("of"), F.posexplode(of).alias("at", "s"))
        return some.withColumn("versions", F.array_join(F.array_sort(F.array_distinct(named)), " "))

    notice_idf = {w: idf[w] for w in sorted(notice_words)}
    vectors = _weights(templates, notice_idf)
    pattern = _any(_anchors(vectors, least))
    most = max(len(_words(text)) for _, text in templates) * 3 // 2
    # a cosine of least leaves other words that share of the norm; rounding must not decide
    ratio = 1.0001 * (1 / least**2 - 1) * (max(notice_idf.values()) / other) ** 2
    found = _alike(passages(pattern, _passages(most, pattern, sorted(notice_words), ratio)), templates, vectors, notice_idf, other, least)
    if bodies:
        body_idf = {w: idf[w] for w in sorted({w for _, text in bodies for w in text.split()})}
        vectors = _weights(bodies, body_idf, damped=True)
        whole = passages(_any(_anchors(vectors, LEAST_BODY)), _full_texts([text for _, text in bodies]))
        whole = whole.withColumn("versions", F.lit(""))
        found = found.unionByName(_alike(whole, bodies, vectors, body_idf, other, LEAST_BODY, damped=True))
    best = found.groupBy("path", "licence").agg(F.max("cosine").alias("cosine"))
    # rounded, so that two orders of the same sum do not decide
    rank = F.struct(F.col("licence") == WEAK, -F.round("cosine", 9), "licence")
    return best.groupBy("path").agg(F.min_by("licence", rank).alias("licence"))


def _folder(path: F.Column) -> F.Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(
    files: DataFrame,
    *,
    path_col: str = "path",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    least: float = LEAST,
) -> DataFrame:
    """All rows of ``files`` with ``own_licence``, ``licence`` and ``licence_from``.

    Without ``templates`` TEMPLATES and BODIES hold.  A file's licence is its own if its text states one; else that of the nearest folder above it, its
    own included, in which a licence file states one.  ``licence_from`` is the file's path or the
    folder; the top folder is empty.  A folder with several licence files takes the first by path.

    Null texts state nothing.  Rows without a path neither state, hand on nor inherit.  Rows that
    repeat a path are one file: what any of them states holds for all.  Input columns with the names
    of new ones give way.  An empty table gives an empty table.
    """
    bodies = [] if templates else BODIES
    found = stated(files, templates or TEMPLATES, bodies=bodies, path_col=path_col, text_col=text_col, least=least)
    own = stored(found, "licences")
    by_folder = (
        own.where(F.col("path").rlike(LICENCE_FILE))
        .groupBy(_folder(F.col("path")).alias("above"))
        .agg(F.min_by("licence", "path").alias("inherited"))
    )
    rows = files.select(
        packed(files, ["own_licence", "licence", "licence_from"]),
        quoted(path_col).alias("_path"),
        _folder(quoted(path_col)).alias("_folder"),
    )
    folders = rows.where("_folder IS NOT NULL").select("_folder").distinct()
    parts = F.filter(F.split("_folder", "/"), lambda x: x.isNotNull())
    depths = F.sequence(F.lit(0), F.size(parts))
    above = folders.select(
        "_folder",
        F.posexplode(F.transform(depths, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("depth", "above"),
    ).distinct()
    nearest = above.join(by_folder, "above").groupBy("_folder").agg(
        F.max_by(F.struct("above", "inherited"), "depth").alias("from")
    )
    joined = rows.join(own.select(F.col("path").alias("_path"), F.col("licence").alias("own_licence")), "_path", "left").join(
        nearest, "_folder", "left"
    )
    return joined.select(
        "_row.*",
        "own_licence",
        F.coalesce("own_licence", "from.inherited").alias("licence"),
        F.when(F.col("own_licence").isNotNull(), F.col("_path")).otherwise(F.col("from.above")).alias("licence_from"),
    )
