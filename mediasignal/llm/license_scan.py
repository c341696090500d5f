"""License scans: MinHash bands over text windows retrieve templates, exact containment verifies them.

Words are runs of a-z and 0-9 after lower-casing; a shingle is five of them in a
row. A template of ``LONG`` or more shingles is cut into all its windows of
``WINDOW`` shingles, a text into those at every ``STRIDE``-th place. Each window
has ``len(MASKS) * 2`` MinHash values, the least and the greatest of its hashes
under each mask, and each value is a band of its own: two windows with
similarity ``s`` share a band with probability ``1 - (1 - s) ** 8``, 0.97 at
0.35. A text that holds 0.8 of a template's shingles holds several windows of
at least that similarity. Windows of shorter templates are single shingles,
whose bands are equal if and only if the shingles are.

A template that shares a band with a text is compared shingle by shingle with
the words around: it matches if the share of its distinct shingles found there
reaches ``LEAST``. All of this is one column expression; texts never leave
their row, and only matches become rows.

Defined cases: null texts and texts of under five words match nothing, nor do
templates of under five words. Repeated rows and null ids are scanned for
themselves; a table without rows gives none; extra columns are ignored. The
templates are literals of the plan, at most ``TEMPLATE_SHINGLES`` shingles.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS, LEAST = 5, 0.8
WINDOW, STRIDE, LONG = 8, 4, 16
#: Each is XORed to the hashes for another order.
MASKS = [0, 0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F]
TEMPLATE_SHINGLES = 50_000

# Usual notices of public licenses.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "MIT-permission": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "BSD-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer.""",
    "ISC-permission": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission notice appear in
        all copies.""",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
        of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}

_WORDS = "regexp_extract_all(lower({text}), '[a-z0-9]+', 0)"
_NEXT = ", ".join(f"{{w}}[i + {k}]" for k in range(WORDS))


def _shingles(words: str, make: str, kind: str) -> str:
    each = f"{make}{_NEXT.format(w=words)})"
    return (f"if(size({words}) >= {WORDS}, transform(sequence(0, size({words}) - {WORDS}), i -> {each}), "
            f"cast(array() as array<{kind}>))")


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body``, in which ``name`` stands for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _bands(window: str) -> str:
    orders = [window if not m else f"transform({window}, v -> v ^ {m}L)" for m in MASKS]
    return "array(" + ", ".join(f"array_min({o}), array_max({o})" for o in orders) + ")"


def _among(value: str, numbers: set[int]) -> str:
    return f"{value} in ({', '.join(f'{n}L' if n > -2**63 else 'bigint(-9223372036854775808)' for n in sorted(numbers))})" \
        if numbers else "false"


def prepared(spark: SparkSession, templates: dict[str, str]) -> list[dict]:
    """License, number of distinct shingles, shingles and bands of each template, by the expressions that texts get."""
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    words = _WORDS.format(text="text")
    hashes = _shingles("w", "xxhash64(", "bigint")
    windows = (f"if(size(h) >= {LONG}, array_distinct(flatten(transform(sequence(1, size(h) - {WINDOW - 1}), "
               f"s -> {_let('c', f'slice(h, s, {WINDOW})', _bands('c'))}))), h)")
    found = rows.selectExpr(
        "license", _let("w", words, "array_distinct(" + _shingles("w", "concat_ws(' ', ", "string") + ")") + " as shingles",
        _let("w", words, _let("h", hashes, windows)) + " as bands").where("size(shingles) > 0").collect()
    if sum(len(r.shingles) for r in found) > TEMPLATE_SHINGLES:
        raise ValueError(f"templates have more than {TEMPLATE_SHINGLES} shingles")
    return [{"license": r.license, "n": len(r.shingles), "shingles": r.shingles, "bands": r.bands} for r in found]


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """One row per document and template that it holds: doc_id, license, containment."""
    known = prepared(docs.sparkSession, TEMPLATES if templates is None else templates)
    kind = "array<struct<license:string,containment:double>>"
    none = f"cast(array() as {kind})"
    single = {b for t in known if t["n"] < LONG for b in t["bands"]}
    wide = {b for t in known if t["n"] >= LONG for b in t["bands"]}
    # Places of windows that share a band with some template.
    alone = f"filter(transform(h, (v, i) -> if({_among('v', single)}, struct(i as at, v as band), null)), x -> x is not null)"
    hit = f"transform(filter({_bands('c')}, v -> {_among('v', wide)}), v -> struct(s - 1 as at, v as band))"
    broad = (f"flatten(transform(if(size(h) > 0, sequence(1, size(h), {STRIDE}), cast(array() as array<int>)), "
             f"s -> {_let('c', f'slice(h, s, {WINDOW})', hit)}))")
    table = json.dumps(known).replace("\\", "\\\\").replace("'", "\\'")
    fields = "array<struct<license:string,n:int,shingles:array<string>,bands:array<bigint>>>"
    # The words of a stretch of 3 n shingles and a window, which covers a match wherever it was hit.
    near = f"slice(w, greatest((b - 1) * t.n, 0) + 1, 3 * t.n + {WINDOW + WORDS + STRIDE})"
    share = _let("r", near, f"size(array_intersect(t.shingles, {_shingles('r', "concat_ws(' ', ", 'string')})) / t.n")
    best = (f"array_max(transform(array_distinct(transform(z, y -> cast(y.at div t.n as int))), b -> {share}))")
    judged = _let("z", "filter(x, y -> array_contains(t.bands, y.band))",
                  f"if(size(z) = 0, null, struct(t.license as license, {best} as containment))")
    verified = f"filter(transform(from_json('{table}', '{fields}'), t -> {judged}), m -> m.containment >= {float(least)}D)"
    matches = _let("w", _WORDS.format(text="coalesce(cast(text as string), '')"), _let(
        "h", _shingles("w", "xxhash64(", "bigint"), _let(
            "x", f"concat({alone}, {broad})", f"if(size(x) = 0, {none}, {verified})")))
    return docs.select("doc_id", F.explode(F.expr(matches)).alias("match")).select(
        "doc_id", "match.license", "match.containment")


