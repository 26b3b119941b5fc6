"""Licence scans by canonical digest, with DataFrame functions only.

A text is put into a canonical form: case, copyright lines, equivalent spellings and all punctuation and blanks
are normalised away; the SHA-256 of that form is looked up among the digests of known licence texts. Besides the
whole text, each of its lines is a text of its own, which finds one-line notices.

Each text is normalised once: its lines are cut from that form, and the whole form joins them again. Lines are known by
128-bit digests, kept in one table beside the text's SHA-256, and these are joined, not the lines. Known licences are a table (license_id, text); their
digests are broadcast only while they number at most BROADCAST_ROWS, else the join shuffles on the digest.
Cases: null texts and texts whose canonical form is empty match nothing; several known licences with one canonical
form give the smallest id; repeated rows give a row each, as documents are matched by a row number; an empty table gives an empty table. Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimart.llm.scratch import stored

BROADCAST_ROWS = 10_000

# Equivalent spellings, applied in this order to lower-case words.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"), ("copyright owner", "copyright holder"),
    ("favour", "favor"), ("judgement", "judgment"), ("labour", "labor"), ("licence", "license"), ("merchantibility", "merchantability"),
    ("non commercial", "noncommercial"), ("organisation", "organization"), ("per cent", "percent"), ("sub license", "sublicense"), ("whilst", "while"),
)
# Names of licences in notices, by SPDX id.
NAMES = {
    "0BSD": ("the Zero-Clause BSD License", "the BSD Zero Clause License"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0", "the GNU AGPL v3", "AGPLv3"),
    "Apache-2.0": ("the Apache License, Version 2.0", "Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0", "the Apache 2.0 License", "Apache 2.0", "the Apache-2.0 license"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "the Modified BSD License"),
    "BSL-1.0": ("the Boost Software License, Version 1.0", "the Boost Software License 1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "the CC BY 4.0 license", "a Creative Commons Attribution 4.0 International License", "the Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 International"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "the CC BY-NC 4.0 license", "a Creative Commons Attribution-NonCommercial 4.0 International License", "the Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial 4.0 International"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "the CC BY-SA 4.0 license", "a Creative Commons Attribution-ShareAlike 4.0 International License", "the Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike 4.0 International"),
    "CC0-1.0": ("CC0 1.0", "the CC0 1.0 license", "CC0 1.0 Universal", "the Creative Commons CC0 1.0 Universal License"),
    "GPL-2.0": ("the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GNU GPL v2", "the GNU GPL, version 2", "the GPL, version 2", "GPLv2", "the GPLv2"),
    "GPL-3.0": ("the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL v3", "the GNU GPL, version 3", "the GPL, version 3", "GPLv3", "the GPLv3"),
    "ISC": ("the ISC License",),
    "LGPL-2.1": ("the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1", "the GNU LGPL v2.1"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0", "the GNU LGPL v3"),
    "MIT": ("the MIT License", "MIT License", "MIT", "the MIT License (MIT)", "an MIT License"),
    "MPL-2.0": ("the Mozilla Public License, v. 2.0", "the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "the MPL 2.0"),
    "Unlicense": ("the Unlicense",),
    "Zlib": ("the zlib License", "the zlib/libpng License"),
}
# What a notice says before the name.
SUBJECTS = ("", "This work is ", "This project is ", "This software is ", "This program is ", "This code is ", "This file is ", "This document is ")
VERBS = ("licensed", "released", "distributed", "available", "made available", "published")
LINKS = ("under", "under the terms of")
# Titles that a short licence text may bear (the text alone is known as well); longer texts hold their own.
TITLES = {
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "Zlib": ("zlib License", "The zlib License"),
}
# Copyright lines of templates that nobody has filled in (lines with a year fall out of the canonical form).
UNFILLED = ("Copyright (c) <year> <copyright holders>", "Copyright (c) [year] [fullname]")


def _notices() -> Iterator[tuple[str, str]]:
    for spdx, names in NAMES.items():
        for subject, verb, link, name in itertools.product(SUBJECTS, VERBS, LINKS, names):
            yield spdx, f"{subject}{verb} {link} {name}."
        yield spdx, f"SPDX-License-Identifier: {spdx}"
    yield "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."


def _forms(spdx: str, text: str) -> Iterator[str]:
    """A full text in the forms it is passed on in: with and without title, appendix, list numbers, filled-in names, https."""
    forms = [text]
    if "END OF TERMS AND CONDITIONS" in text:
        body, mark, _ = text.partition("END OF TERMS AND CONDITIONS")
        forms += [body, body + mark, re.sub(r"(?m)^ *Copyright \[yyyy\].*$", "", text)]
    if spdx in TITLES:
        forms += [re.sub(r"(?m)^ *\d\. ", "", text)]
        forms = [f"{line}\n\n{f}" for f in forms for line in ("", *UNFILLED)]
        forms += [f"{title}\n\n{f}" for f in forms for title in TITLES[spdx]]
    for form in forms:
        yield from {form: 0, form.replace("http://", "https://"): 0, form.replace("https://", "http://"): 0}


def _texts() -> Iterator[tuple[str, str]]:
    """The full public texts beside this module; a file is named SPDX.txt or SPDX@variant.txt."""
    for file in sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name):
        spdx = file.name.removesuffix(".txt").split("@")[0]
        for form in _forms(spdx, file.read_text(encoding="utf-8")):
            yield spdx, form


#: Known notices and full texts by SPDX id.
NOTICES = tuple(dict.fromkeys([*_notices(), *_texts()]))

#: Lines end at \n only (the flag d; RE2 has no other way).
_COPYRIGHT_LINE = r"(?imd)^[^\p{L}\p{N}\n]*(?:copyright\b|\(c\)|©)[^\n]*\d{4}[^\n]*$|^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"


_SIGNS = ("copyright", "(c)", "©", "all rights reserved")
#: Spellings of one word and of two: the latter are applied where lines have been joined or parted.
ONE_WORD, TWO_WORDS = (tuple(p for p in SPELLINGS if (" " in p[0]) == two) for two in (False, True))


def _spelled(form: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for a, b in pairs:
        form = F.replace(form, F.lit(a), F.lit(b))
    return form


def _even(text: Column) -> Column:
    """Lower-case words of a text with single blanks between them, its line ends kept."""
    low = F.lower(text)
    signed = F.lit(False)
    for sign in _SIGNS:
        signed = signed | low.contains(sign)
    # Only lines with one of the signs can be copyright lines.
    low = F.when(signed, F.regexp_replace(low, _COPYRIGHT_LINE, " ")).otherwise(low)
    return _spelled(F.regexp_replace(low, r"[^\p{L}\p{N}\n]+", " "), ONE_WORD)


def _whole(even: Column) -> Column:
    return _spelled(F.trim(F.regexp_replace(even, "[ \n]+", " ")), TWO_WORDS)


def canonical(text: Column) -> Column:
    """The canonical form of a licence text."""
    return _whole(_even(text))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null where that is empty."""
    return _digest_of(canonical(text))


def _digest_of(form: Column) -> Column:
    return F.when(form != "", F.sha2(form, 256))


def _short(form: Column) -> Column:
    """A 128-bit digest of a line's form."""
    return F.struct(F.xxhash64(form).alias("a"), F.xxhash64(F.lit("line"), form).alias("b"))


def known_notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES), "license_id string, text string")


def scan_licenses(docs: DataFrame, known: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, digest, text_license, line_licenses array) for each row of docs."""
    forms = known.select("license_id", _whole(_even(F.col("text"))).alias("__form")).filter("__form <> ''")
    table = forms.groupBy("__form").agg(F.min("license_id").alias("__license")).select(
        F.sha2("__form", 256).alias("__digest"), _short(F.col("__form")).alias("__line"), "__license")
    small = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    side = F.broadcast(table) if small else table
    # Each text is normalised once; its whole form and its lines are made of that, and only digests are kept.
    even = docs.select(F.col(key).alias("__key"), _even(F.col(text)).alias("__even"))
    line = F.transform(F.split("__even", "\n"), lambda x: _spelled(F.trim(x), TWO_WORDS))
    made = even.select("__key", F.monotonically_increasing_id().alias("__row"), _digest_of(_whole(F.col("__even"))).alias("__digest"),
                       F.transform(F.array_distinct(F.filter(line, lambda x: x != "")), _short).alias("__lines"))
    base = stored(made, "licences")
    hits = base.select("__row", F.explode("__lines").alias("__line")).join(side.select("__line", "__license"), "__line")
    hits = hits.groupBy("__row").agg(F.array_sort(F.collect_set("__license")).alias("line_licenses"))
    out = base.select("__key", "__row", "__digest").join(side.select("__digest", F.col("__license").alias("text_license")), "__digest", "left").join(hits, "__row", "left")
    return out.select(F.col("__key").alias(key), F.col("__digest").alias("digest"), "text_license", F.coalesce("line_licenses", F.array().cast("array<string>")).alias("line_licenses"))
