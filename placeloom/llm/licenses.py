"""Licence notices: passages compared with templates by Dice over word bigrams.

A passage is the whole text, or a window of lines and sentences that begins at
one with a word that notices begin with: of as many lengths as it takes for one
to come near any notice that begins there, wrapped or not, with comment marks or
not, before code or prose. Its words are lower-case
runs of letters and digits. Two bounds, both exact, keep most passages from
being compared: a passage whose number of bigrams is too far from a template's
can't reach the threshold, and neither can one with none of the words that
most of a template's bigrams hang on.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeloom.llm.common import let, text_of

DICE = 0.75
# Licence notices, by SPDX name.
_PERMISSION = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
    "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE '
    "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
    "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ENDORSE = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, '
    "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
    "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain."
)
_APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License."
)
_GNU = "This work is licensed under the GNU {} License, version {}."
_GNU_HEADER = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_GNU_TITLE = "GNU {} LICENSE Version {} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_CREATIVE = "This work is licensed under a Creative Commons {} License."
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", _GNU.format("Affero General Public", "3")),
    ("AGPL-3.0", _GNU_HEADER.format("program", "Affero General Public", "3")),
    ("AGPL-3.0", _GNU_TITLE.format("AFFERO GENERAL PUBLIC", "3, 19 November 2007")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("BSD-2-Clause", _REDISTRIBUTION),
    ("BSD-2-Clause", f"{_REDISTRIBUTION} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_REDISTRIBUTION}{_ENDORSE} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", _REDISTRIBUTION + _ENDORSE),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-3.0", _CREATIVE.format("Attribution 3.0 Unported")),
    ("CC-BY-4.0", _CREATIVE.format("Attribution 4.0 International")),
    ("CC-BY-NC-4.0", _CREATIVE.format("Attribution-NonCommercial 4.0 International")),
    ("CC-BY-NC-ND-4.0", _CREATIVE.format("Attribution-NonCommercial-NoDerivatives 4.0 International")),
    ("CC-BY-NC-SA-4.0", _CREATIVE.format("Attribution-NonCommercial-ShareAlike 4.0 International")),
    ("CC-BY-ND-4.0", _CREATIVE.format("Attribution-NoDerivatives 4.0 International")),
    ("CC-BY-SA-3.0", _CREATIVE.format("Attribution-ShareAlike 3.0 Unported")),
    ("CC-BY-SA-4.0", _CREATIVE.format("Attribution-ShareAlike 4.0 International")),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0", _GNU.format("General Public", "2")),
    ("GPL-2.0", _GNU_TITLE.format("GENERAL PUBLIC", "2, June 1991")),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", _GNU.format("General Public", "3")),
    ("GPL-3.0", _GNU_TITLE.format("GENERAL PUBLIC", "3, 29 June 2007")),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", _ISC),
    ("ISC", f"{_ISC} {_ISC_DISCLAIMER}"),
    ("LGPL-2.1", _GNU.format("Lesser General Public", "2.1")),
    ("LGPL-2.1", _GNU_HEADER.format("library", "Lesser General Public", "2.1")),
    ("LGPL-2.1", _GNU_TITLE.format("LESSER GENERAL PUBLIC", "2.1, February 1999")),
    ("LGPL-3.0", _GNU.format("Lesser General Public", "3")),
    ("LGPL-3.0", _GNU_HEADER.format("library", "Lesser General Public", "3")),
    ("LGPL-3.0", _GNU_TITLE.format("LESSER GENERAL PUBLIC", "3, 29 June 2007")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _PERMISSION),
    ("MIT", f"{_PERMISSION} {_AS_IS}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", _UNLICENSE),
    ("Zlib", _ZLIB),
)


# Beginnings of words one of which every notice has in its first or second piece.
STARTS = ("licen", "copyright", "redistribut", "permission", "warrant", "unencumbered", "mozilla")
# Words that tell licences of one family apart; the first of each line names the family.
FAMILIES = (("gnu", "affero", "lesser"), ("creative", "sharealike", "noncommercial", "noderivatives"), ("cc", "sa", "nc", "nd"))
#: Lines or sentences in a window: each a third more than the one before, as far as the longest notice goes in short lines.
WINDOWS = (2, 3, 4, 5, 7, 9, 12, 16, 22, 29, 39)


def _bigrams(text: str) -> list[str]:
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def anchors(templates=TEMPLATES, dice: float = DICE) -> list[str]:
    """Words of which any passage within dice of any template has at least one.

    Such a passage shares at least dice / (2 - dice) of a template's bigrams, so it's enough to take words (long ones
    first) until fewer bigrams than that have none of them.
    """
    out: set[str] = set()
    for _, text in templates:
        all_ = _bigrams(text)
        for word in sorted({w for b in all_ for w in b.split()}, key=lambda w: (w not in out, -len(w), w)):
            if sum(not out & set(b.split()) for b in all_) < dice / (2 - dice) * len(all_):
                break
            out.add(word)
    return sorted(out)


def telling(text: str) -> tuple[set[str], set[str], set[str]]:
    """Of a template: the family's words that a passage must have, those that it must not, and the versions that it may name.

    A version is "version n", or two figures that stand together, such as 2.1 or 4.0.
    """
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    needed = {w for family in FAMILIES if family[0] in words for w in family[1:]}
    return needed & set(words), needed - set(words), {b for b in _bigrams(text) if re.fullmatch(VERSION, b)}


#: Bigrams that name a version.
VERSION = r"version \d+|\d \d"


def _words(passage: Column) -> Column:
    return F.split(F.btrim(F.regexp_replace(F.lower(passage), r"[^\p{L}\p{N}]+", " ")), " ")


def _compared(passage: Column, templates, dice: float, best_only: bool) -> Column:
    """array<struct<dice,name,gain>> of the templates that passage comes within dice of; with best_only without those that
    another word or version tells apart from it. gain: shared bigrams, less half of those that only one of the two has.

    The passage's bigrams are first cut down to those of any template: most passages end there.
    """
    known = [(name, text, _bigrams(text)) for name, text in templates]
    share = dice / (2 - dice)
    least, most = min(len(b) for *_, b in known) * share, max(len(b) for *_, b in known) / share
    every = F.array(*map(F.lit, sorted({g for *_, b in known for g in b})))

    def against(words: Column, grams: Column, some: Column) -> Column:
        return let(F.filter(grams, lambda g: g.rlike(f"^({VERSION})$")), lambda versions: matches(words, grams, some, versions))

    def matches(words: Column, grams: Column, some: Column, versions: Column) -> Column:
        n, m = F.size(grams), F.size(some)
        plain = F.filter(versions, lambda g: ~g.rlike(r"^\d 0$"))
        each = []
        for name, text, b in known:
            # what is shared is at least a share of either: a passage with fewer known bigrams is not compared
            fits = (n >= len(b) * share) & (n * share <= len(b)) & (m >= len(b) * share) & (m >= n * share)
            shared = F.size(F.array_intersect(some, F.array(*map(F.lit, b))))
            if best_only:
                needed, barred, own = telling(text)
                for w in sorted(needed):
                    fits = fits & F.array_contains(words, w)
                for w in sorted(barred):
                    fits = fits & ~F.array_contains(words, w)
                if own:
                    # "2.0" is no other version than "2"
                    pairs = any(re.fullmatch(r"\d \d", v) for v in own)
                    fits = fits & (F.size(F.array_except(versions if pairs else plain, F.array(*map(F.lit, sorted(own))))) == 0)
            each.append(F.struct(F.when(fits, shared).otherwise(0).alias("shared"), F.lit(len(b)).alias("size"), F.lit(name).alias("name")))
        score = lambda x: F.struct((2.0 * x["shared"] / (n + x["size"])).alias("dice"), x["name"].alias("name"), (2.0 * x["shared"] - (n + x["size"]) / 2).alias("gain"))
        return F.filter(F.transform(F.array(*each), score), lambda x: x["dice"] >= dice)

    def bigrams(w: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda k: F.concat(F.get(w, k), F.lit(" "), F.get(w, k + 1))))

    nothing = F.array().cast("array<struct<dice:double,name:string,gain:double>>")
    # Repeated bigrams count once, so only the upper end of a passage's words may be cut here by a lower count of bigrams.
    return let(_words(passage), lambda w: F.when(F.size(w) - 1 < least, nothing).otherwise(let(bigrams(w), lambda g: F.when((F.size(g) < least) | (F.size(g) > most), nothing).otherwise(let(F.array_intersect(g, every), lambda x: F.when((F.size(x) < least) | (F.size(x) < F.size(g) * share), nothing).otherwise(against(w, g, x)))))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, dice: float = DICE, best_only: bool = False) -> DataFrame:
    """One row for each row of docs: id_col and notices, array<struct<dice,name>>, the best score of each licence found:
    all that a passage comes near, or with best_only the best of those passages that overlap, by gain.

    A passage is the whole text, a piece, which ends at a line's or a sentence's end and has a word from anchors(), or a
    window of pieces that begins at one with a word that begins as in STARTS, or at the one before it. Notices are sorted by name. Null and empty texts have none; whole
    texts are read, whatever their length; repeated rows stay repeated; null ids stay; further columns are not read; an
    empty table gives an empty one.
    """
    hint = rf"(?i)(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(anchors(templates, dice))})(?:$|[^\p{{L}}\p{{N}}])"
    starts_at = rf"(?i)(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(STARTS)})"
    has = lambda x: x.rlike(hint)

    def passages(pieces: Column) -> Column:
        """array<struct<first,last,text>>"""
        n, hinted = F.size(pieces), F.transform(pieces, lambda x: x.rlike(starts_at))
        starts = lambda at: F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(at, i) | F.coalesce(F.get(at, i + 1), F.lit(False)))
        window = lambda i, k: F.struct(i.alias("first"), (i + k - 1).alias("last"), F.array_join(F.slice(pieces, i + 1, k), " ").alias("text"))
        windows = let(hinted, lambda at: F.flatten(F.transform(starts(at), lambda i: F.transform(F.filter(F.array(*map(F.lit, WINDOWS)), lambda k: i + k <= n), lambda k: window(i, k)))))
        alone = F.filter(F.transform(pieces, lambda x, i: F.struct(i.alias("first"), i.alias("last"), x.alias("text"))), lambda w: has(w["text"]))
        return F.concat(alone, windows, F.array(F.struct(F.lit(0).alias("first"), (n - 1).alias("last"), F.col("_t").alias("text"))))

    pieces = F.split("_t", r"\n|(?<=[.;:!?])[ \t]+")
    each = lambda w: F.transform(_compared(w["text"], templates, dice, best_only), lambda x: F.struct(x["gain"].alias("gain"), w["first"].alias("first"), w["last"].alias("last"), x["dice"].alias("dice"), x["name"].alias("name")))
    kind = "array<struct<gain:double,first:int,last:int,dice:double,name:string>>"
    found = F.when(has(F.col("_t")), F.flatten(F.transform(let(pieces, passages), each))).otherwise(F.array().cast(kind))
    if best_only:
        apart = lambda a, x: ~F.exists(a, lambda y: (y["first"] <= x["last"]) & (x["first"] <= y["last"]) & ((y["gain"] > x["gain"]) | (y["name"] == x["name"])))
        add = lambda a, x: F.when(apart(a, x), F.concat(a, F.array(x))).otherwise(a)
        found = F.aggregate(F.sort_array(found, asc=False), F.array().cast(kind), add)
    best = let(found, lambda f: F.transform(F.array_sort(F.array_distinct(F.transform(f, lambda x: x["name"]))), lambda n: F.struct(F.array_max(F.filter(F.transform(f, lambda x: F.struct(x["dice"].alias("dice"), x["name"].alias("name"))), lambda x: x["name"] == n))["dice"].alias("dice"), n.alias("name"))))
    return docs.select(F.col(id_col), text_of(text_col).alias("_t")).select(id_col, best.alias("notices"))


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """licences, comma-joined, how many, and the best score to six places (0 without any)."""
    return found.select(
        id_col,
        F.array_join(F.transform("notices", lambda x: x["name"]), ",").alias("licences"),
        F.size("notices").cast("long").alias("n_licences"),
        F.round(F.coalesce(F.array_max(F.transform("notices", lambda x: x["dice"])), F.lit(0.0)), 6).alias("best_dice"),
    )
