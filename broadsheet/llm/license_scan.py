"""License templates in texts: MinHash bands over overlapping windows, then containment.

Words are runs of letters and digits in lower case, shingles are five words. A template
of ``n`` shingles belongs to the tier of the next power of two ``s``; a text is cut into
blocks of ``s`` shingles, and two neighbours make a window, so each run of ``n`` shingles
lies whole in some window (a single shingle is a window of its own). Templates and windows that share one of ``bands`` minima are
candidates. A window that holds the share ``CONTAINMENT`` of a template has at least the
Jaccard similarity ``j`` of ``band_count``, and the number of bands is the least with
``1 - (1 - j) ** bands >= CERTAINTY``. A candidate counts if the text's shingles contain
that share of the template's. Native functions only, in the text's row: no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, fresh

SHINGLE = 5
CONTAINMENT = 0.8
CERTAINTY = 0.99
# Templates are searched for in rounds of so many.
ROUND = 64
_LONGS = "array<bigint>"

# Public notices by which texts state a license.
TEMPLATES = {
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "bsd-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
    "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
    "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
    "more details.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software.",
}


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^a-z0-9\x{80}-\x{10FFFF}]+"), "")


def shingles_of(words: Column) -> Column:
    """Hashes of all runs of five words; of the whole sequence if it is shorter, none if empty."""
    runs = F.transform(
        F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SHINGLE)))
    )
    whole = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(F.size(words) >= SHINGLE, runs).when(F.size(words) > 0, whole).otherwise(F.array().cast(_LONGS))


def tier_of(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def band_count(n: int, containment: float = CONTAINMENT, certainty: float = CERTAINTY) -> int:
    """Bands of one minimum that a window with the share of ``n`` shingles hits with ``certainty``."""
    if n == 1:
        return 1
    held = math.ceil(containment * n)
    similar = held / (2 * tier_of(n) + n - held)
    return math.ceil(math.log(1 - certainty) / math.log(1 - similar))


def _masks(bands: int) -> list[int]:
    """Hashes are uniform, so comparing them after flipping fixed bits is another order of them."""
    return [int(x) for x in np.random.default_rng(0).integers(-(1 << 63), (1 << 63) - 1, bands)]


# Many columns of one shape: written as SQL, which is built much faster than by calls.


def _block_minima(shingles: str, tier: int, mask: int) -> str:
    """Of every block of ``tier`` shingles, the minimum in the order of ``mask``."""
    if tier == 1:
        return f"transform(`{shingles}`, h -> h ^ ({mask}L))"
    starts = f"sequence(1, greatest(size(`{shingles}`), 1), {tier})"
    return f"transform({starts}, at -> array_min(transform(slice(`{shingles}`, at, {tier}), h -> h ^ ({mask}L))))"


def _joined_minima(least: str) -> str:
    """The minima of blocks twice as long."""
    pairs = f"sequence(0, greatest(size(`{least}`) - 1, 0), 2)"
    return f"transform({pairs}, i -> least(get(`{least}`, i), get(`{least}`, i + 1)))"


def template_rounds(templates: DataFrame, id_col: str, text_col: str, round_size: int) -> Iterator[list[tuple[str, list[int]]]]:
    """(id, distinct shingles) of the templates that have a word, in rounds of bounded number."""
    ready = templates.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("words")
    ).select("id", F.array_distinct(shingles_of(F.col("words"))).alias("shingles"))
    held = []
    for row in ready.filter(F.size("shingles") > 0).toLocalIterator():
        held.append((row.id, list(row.shingles)))
        if len(held) == round_size:
            yield held
            held = []
    if held:
        yield held


def find_licenses(
    docs: DataFrame,
    templates: DataFrame,
    out: str,
    text_col: str = "text",
    template_id: str = "license_id",
    template_text: str = "text",
    containment: float = CONTAINMENT,
    certainty: float = CERTAINTY,
    round_size: int = ROUND,
) -> DataFrame:
    """``docs`` with ``out``, an array of (license_id, containment, window) sorted by id.

    ``window`` is the first word of the first window that retrieved the template. A null or
    empty text matches nothing, nor does a template without words; a null template id
    counts as ''. Repeated rows and templates are judged each by itself, an empty table stays
    empty. Templates beyond ``round_size`` are searched for in further rounds over the texts.
    """
    base = docs.columns
    words, shingles, near = fresh(docs, "words", "shingles", "near")
    found = docs.withColumn(words, words_of(F.coalesce(F.col(text_col), F.lit("")))).withColumn(shingles, shingles_of(F.col(words)))
    parts, rounds = [], 0
    for rounds, part in enumerate(template_rounds(templates, template_id, template_text, round_size), 1):
        if rounds > 1:
            found = cut(found)
        (name,) = fresh(found, f"{out}_{rounds}")
        parts.append(name)
        # a text without any of the templates' shingles contains no share of them and has no window to look at
        sought = F.lit(sorted({h for _, own in part for h in own})).cast(_LONGS)
        found = found.withColumn(near, F.when(F.arrays_overlap(shingles, sought), F.col(shingles)).otherwise(F.array().cast(_LONGS)))
        found = _one_round(found, part, name, near, containment, certainty)
    none = F.array().cast("array<struct<license_id:string,containment:double,window:int>>")
    return found.select(*base, F.array_sort(F.concat(none, *parts)).alias(out))


def _retrieved(least: str, tier: int, owners: dict[int, list[int]]) -> str:
    """(number, window) of the templates that a window meets in one band.

    ``least`` are the minima of the blocks, ``owners`` the templates of each minimum. A
    window's minimum is one of its two blocks', so most texts are passed over at once.
    """
    keys = ", ".join(f"{k}L" if k >= 0 else f"({k}L)" for k in owners)
    numbers = ", ".join(f"({k}L), array({', '.join(map(str, own))})" for k, own in owners.items())
    window = f"`{least}`" if tier == 1 else f"transform(`{least}`, (low, at) -> least(low, get(`{least}`, at + 1)))"
    placed = f"filter(transform({window}, (k, at) -> named_struct('window', at * {tier}, 'key', k)), w -> array_contains(array({keys}), w.key))"
    listed = f"transform(element_at(map({numbers}), w.key), i -> named_struct('number', i, 'window', w.window))"
    return (
        f"CASE WHEN arrays_overlap(`{least}`, array({keys})) THEN flatten(transform({placed}, w -> {listed})) "
        "ELSE cast(array() AS array<struct<number:int,window:int>>) END"
    )


def _one_round(
    found: DataFrame, templates: list[tuple[str, list[int]]], out: str, shingles: str, containment: float, certainty: float
) -> DataFrame:
    tiers: dict[int, list[int]] = {}
    for i, (_, own) in enumerate(templates):
        tiers.setdefault(tier_of(len(own)), []).append(i)
    bands = {
        tier: max(band_count(len(templates[i][1]), containment, certainty) for i in members) for tier, members in tiers.items()
    }
    masks = _masks(max(bands.values()))
    hits_of, temporary, least, below = [], [], [], 0
    for tier in sorted(tiers):
        # tiers that double each other share their bands, and minima come from the tier below
        chain = [tier]
        while 2 * chain[-1] in tiers:
            chain.append(2 * chain[-1])
        wanted = max(bands[t] for t in chain)
        if below > 1 and tier == 2 * below:
            columns = [_joined_minima(c) for c in least[:wanted]]
        else:
            columns = [_block_minima(shingles, tier, mask) for mask in masks[:wanted]]
        least, below = fresh(found, *(f"least_{tier}_{band}" for band in range(wanted))), tier
        # one wide projection a tier
        found = found.withColumns({name: F.expr(c) for name, c in zip(least, columns)})
        temporary += least
        for band in range(bands[tier]):
            owners: dict[int, list[int]] = {}
            for i in tiers[tier]:
                owners.setdefault(min(h ^ masks[band] for h in templates[i][1]), []).append(i)
            hits_of.append(F.expr(_retrieved(least[band], tier, owners)))
    (hits,) = fresh(found, "hits")
    found = found.withColumn(hits, F.concat(*hits_of))
    verified = []
    for i, (name, own) in enumerate(templates):
        mine = F.filter(hits, lambda h: h["number"] == i)
        share = F.size(F.array_intersect(shingles, F.lit(own).cast(_LONGS))) / float(len(own))
        entry = F.struct(
            F.lit(name).alias("license_id"), share.alias("containment"), F.array_min(F.transform(mine, lambda h: h["window"])).alias("window")
        )
        verified.append(F.when(F.size(mine) > 0, F.filter(F.array(entry), lambda e: e["containment"] >= containment)))
    none = F.array().cast("array<struct<license_id:string,containment:double,window:int>>")
    listed = F.flatten(F.array(*(F.coalesce(v, none) for v in verified)))
    found = found.withColumn(out, F.when(F.size(hits) > 0, listed).otherwise(none))
    return found.drop(hits, *temporary)
