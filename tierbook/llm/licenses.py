"""License scans: MinHash bands over overlapping text windows.

A text is read as lower-case words (runs of ASCII letters and digits and all
other characters outside ASCII) and their ``SHINGLE``-word shingles, in
overlapping windows of ``WINDOW`` shingles, each starting half a window after
the last. A window's MinHash sketch is the bottom sketch of its shingle
hashes; each value is a band. A template's bands are the
``floor(q * (100 - PERCENT) / 100) + 1`` smallest hashes of its ``q``
shingles. A text with ``PERCENT`` percent of a template holds one of its bands
(it can lack all but one of them); the windows around that shingle have it in
their sketch, which keeps ``WINDOW`` values, as many as a window can hold. So
a template that is there is retrieved with a collision probability of one
(smaller sketches would be cheaper to keep, but the notices of five words that
matter most would be missed in a share of windows). Retrieved templates are
confirmed by exact containment of their shingles.

Everything is DataFrame operations; texts are neither shuffled nor collected
(see ``decontaminate`` for the size-checked broadcasts). Documents are read once
per length of shingles that some template asks for.

The templates are a table of the caller's. ``notice_table`` gives the customary
notices: for each licence of ``LICENSES`` its SPDX tag and the phrases of
``PHRASES`` with each of its names, and the opening of its text or its standard
header where it has one (``BODIES``).

Edge cases: null and blank texts match nothing; a template with fewer words than
a shingle is a run of all its words, found wherever it stands; rows with one
id are judged each by its own text, null ids too; repeated templates are
reported each; other columns are not looked at; an empty table gives an empty
result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import sketches
from .native import with_shingles
from .scratch import materialise, small

SHINGLE = 5
PERCENT = 75
WINDOW = 32

# SPDX identifiers and the names that notices use.
LICENSES = [
    ("MIT", ["the MIT License", "an MIT license", "the terms of the MIT license"]),
    ("Apache-2.0", ["the Apache License, Version 2.0", "the Apache 2.0 License", "the Apache License 2.0"]),
    ("BSD-2-Clause", ["the BSD 2-Clause License", "the Simplified BSD License"]),
    ("BSD-3-Clause", ["the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License"]),
    ("GPL-2.0", ["the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GNU GPL v2"]),
    ("GPL-3.0", ["the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL v3"]),
    ("LGPL-2.1", ["the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1", "the GNU LGPL v2.1"]),
    ("LGPL-3.0", ["the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0", "the GNU LGPL v3"]),
    ("AGPL-3.0", ["the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0", "the GNU AGPL v3"]),
    ("MPL-2.0", ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "the MPL 2.0"]),
    ("EPL-2.0", ["the Eclipse Public License, version 2.0", "the Eclipse Public License 2.0"]),
    ("CDDL-1.0", ["the Common Development and Distribution License, version 1.0"]),
    ("ISC", ["the ISC License"]),
    ("Zlib", ["the zlib License"]),
    ("BSL-1.0", ["the Boost Software License, Version 1.0", "the Boost Software License 1.0"]),
    ("Artistic-2.0", ["the Artistic License 2.0"]),
    ("Unlicense", ["the Unlicense"]),
    ("WTFPL", ["the Do What The Fuck You Want To Public License"]),
    ("OFL-1.1", ["the SIL Open Font License, Version 1.1"]),
    ("CC0-1.0", ["CC0 1.0", "the Creative Commons Zero v1.0 Universal license", "a Creative Commons CC0 1.0 Universal License"]),
    ("CC-BY-4.0", ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"]),
    ("CC-BY-SA-4.0", ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"]),
    ("CC-BY-SA-3.0", ["CC BY-SA 3.0", "the Creative Commons Attribution-ShareAlike 3.0 License"]),
    ("CC-BY-NC-4.0", ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"]),
    ("CC-BY-ND-4.0", ["CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"]),
    ("CC-BY-NC-SA-4.0", ["CC BY-NC-SA 4.0", "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"]),
]
PHRASES = ["Licensed under {}", "Released under {}", "Distributed under {}", "This work is licensed under {}", "Available under {}"]

# The public wording of standard headers and openings.
BODIES = [
    (
        "MIT",
        "grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "Apache-2.0",
        "header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "GPL-3.0-or-later",
        "header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "GPL-2.0-or-later",
        "header",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "BSD",
        "grant",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "MPL-2.0",
        "header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC",
        "grant",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "Unlicense",
        "opening",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose",
    ),
]

NOTICES = [(spdx, f"{spdx}/{name}", text) for spdx, name, text in BODIES]
for _spdx, _names in LICENSES:
    NOTICES.append((_spdx, f"{_spdx}/tag", f"SPDX-License-Identifier: {_spdx}"))
    NOTICES += [(_spdx, f"{_spdx}/{p.format(n)}", p.format(n)) for n in _names for p in PHRASES]

SEPARATOR = "[\\x00-/:-`{-\\x7f]+"


def _words(text):
    return F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR)


def notice_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "license string, template string, text string")


def scan(
    docs: DataFrame,
    templates: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    window: int = WINDOW,
) -> DataFrame:
    """``id, license, template, n_template, n_common, n_windows`` of every
    document and template (license, template, text) it holds; ``n_windows``:
    windows that share a band with the template."""
    item = F.xxhash64("license", "template", "text")
    count = F.least(F.size(F.array_remove(_words(F.col("text")), "")), F.lit(size)).alias("width")
    sized = materialise(templates.select("license", "template", "text", item.alias("item"), count).where("width > 0"), "sized")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("key"))
    widths = sorted((r["width"] for r in sized.select("width").distinct().collect()), reverse=True)  # ``size`` rows at most
    return reduce(DataFrame.unionByName, [_scan(source, sized.where(F.col("width") == w), w, percent, window) for w in widths or [size]])


def _scan(source: DataFrame, templates: DataFrame, size: int, percent: int, window: int) -> DataFrame:
    """``scan`` of the templates (item, license, template, text) whose shingles have ``size`` words."""
    step = window // 2
    sets = materialise(
        with_shingles(templates, _words(F.col("text")), size, "all").select("item", "license", "template", F.array_distinct("all").alias("own")), "templates"
    )
    bands = materialise(
        sketches(sets.select("item", F.col("own").alias("shingles")).dropDuplicates(["item"]), percent).select("item", "hash"), "bands"
    )

    def shingled(df: DataFrame) -> DataFrame:
        return with_shingles(df, _words(F.col("text")), size, "shingles").drop("text")

    posted = shingled(source).select("key", F.posexplode_outer("shingles").alias("at", "hash"))
    # a shingle stands in the sketches of the two windows (one at the start) that hold it
    last = F.floor(F.col("at") / step)
    hit = posted.join(small(bands), "hash").select("key", "item", F.explode(F.sequence(F.greatest(last - 1, F.lit(0)), last)).alias("window"))
    retrieved = materialise(hit.distinct().groupBy("key", "item").agg(F.count("*").alias("n_windows")), "retrieved")
    held = shingled(source.join(small(retrieved.select("key").distinct()), "key"))
    pairs = held.join(small(retrieved), "key").join(small(sets), "item")
    common = F.size(F.array_intersect("shingles", "own")).cast("long")
    return pairs.select(
        "id", "license", "template", F.size("own").cast("long").alias("n_template"), common.alias("n_common"), "n_windows"
    ).where(100 * F.col("n_common") >= percent * F.col("n_template"))
