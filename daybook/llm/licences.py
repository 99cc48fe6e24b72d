"""Licence notices and texts in whole documents, by the Dice coefficient of word bigrams.

A text is normalized (A-Z becomes lower case; everything but a-z and 0-9 parts words), so lines, comment marks and
wrapping don't matter. Any run of consecutive words may be a notice. A run with a bigrams, c of them in common with a template of b bigrams
(a repeated one counts as often as both have it), has the coefficient 2c / (a + b). To reach t, c must be at least
bt / (2 - t) and a at most b(2 - t) / t. So a template is left aside unless the text has that many of its bigrams within that many
places, and only such places are looked at: from each first bigram, the run of the highest coefficient (ties: the shortest).
Of runs of one template that overlap, the better one stays (ties: the earlier), going from left to right.

The work is array functions within a row: no shuffle, no Python. It grows with the words of a text, and at the places
in question with the square of the template. Null or empty texts and texts of fewer than two words match nothing. A text with the same notice twice
has two matches; templates that are alike may both match one place. Extra columns pass through; a column called like the output is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The notices, headers and licence texts looked for.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions:"""
_MIT_REST = """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License.""",
    "bsd-2-clause-text": f"{_BSD_START} {_BSD_REST}",
    "bsd-3-clause": "Use of this source code is governed by a BSD-style license.",
    "bsd-3-clause-text": f"{_BSD_START} {_BSD_THIRD} {_BSD_REST}",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "mit": "Released under the MIT License.",
    "mit-grant": _MIT_GRANT,
    "mit-text": f"{_MIT_GRANT} {_MIT_REST}",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
LEAST = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MATCH = "array<struct<first:int,last:int,dice:double>>"


def bigrams(text: str) -> list[str]:
    """All bigrams of a text in order, repeated ones too."""
    words = re.sub("[^0-9a-z]+", " ", text.translate(str.maketrans(UPPER, LOWER))).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def bounds(size: int, least: float) -> tuple[int, int]:
    """For a template of `size` bigrams: the least number in common, and the most bigrams of a run; outward, so that no tie is lost."""
    return max(1, math.ceil(size * least / (2 - least) * (1 - 1e-9))), math.floor(size * (2 - least) / least * (1 + 1e-9))


def _let(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _times(gram: Column, counts: Counter) -> Column:
    """How often the template has the bigram."""
    out = F.lit(1)
    for n in sorted({n for n in counts.values() if n > 1}):
        out = F.when(gram.isin([g for g, m in counts.items() if m == n]), F.lit(n)).otherwise(out)
    return out


def _matches(hits: Column, counts: Counter, least: float) -> Column:
    """Matches of one template among the places (p, g) of its bigrams."""
    size = sum(counts.values())
    need, most = bounds(size, least)
    place = lambda k: F.get(hits, k)["p"]
    none = F.array().cast(_MATCH)

    # A place counts in a run unless the run has the bigram as often as the template before it: `before` is the first start that is too early.
    def earlier(x: Column, k: Column) -> Column:
        back = F.least(k, F.lit(most))
        same = F.filter(F.sequence(F.lit(1), back), lambda d: F.get(hits, k - d)["g"] == x["g"])
        same = F.when(k > 0, same).otherwise(F.array().cast("array<int>"))
        return F.coalesce(k - F.get(same, _times(x["g"], counts) - 1), F.lit(-1))

    def best(marked: Column, i: Column) -> Column:
        start = F.get(marked, i)["p"]

        def step(acc: Column, x: Column) -> Column:
            def judge(c: Column) -> Column:
                dice = 2 * c / (x["p"] - start + 1 + size)
                better = dice > acc["dice"]
                return F.struct(
                    c.alias("c"),
                    F.when(better, dice).otherwise(acc["dice"]).alias("dice"),
                    F.when(better, x["p"]).otherwise(acc["last"]).alias("last"),
                )

            return _let(acc["c"] + F.when(x["before"] < i, 1).otherwise(0), judge)

        zero = F.struct(F.lit(0).alias("c"), F.lit(0.0).alias("dice"), F.lit(-1).alias("last"))
        # Bigram p is of words p and p + 1.
        return F.aggregate(
            F.slice(marked, i + 1, F.lit(most)), zero, step,
            lambda acc: F.struct(start.alias("first"), (acc["last"] + 1).alias("last"), acc["dice"].alias("dice")),
        )

    def keep(acc: Column, x: Column) -> Column:
        end = F.get(acc, F.size(acc) - 1)
        apart = F.when(F.size(acc) == 0, F.lit(True)).otherwise(x["first"] > end["last"])
        return (
            F.when(apart, F.concat(acc, F.array(x)))
            .when(x["dice"] > end["dice"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(x)))
            .otherwise(acc)
        )

    def runs(starts: Column) -> Column:
        marked = F.transform(hits, lambda x, k: F.struct(x["p"].alias("p"), earlier(x, k).alias("before")))
        found = _let(marked, lambda m: F.transform(starts, lambda i: best(m, i)))
        return F.aggregate(F.filter(found, lambda m: m["dice"] >= least), none, keep)

    starts = F.filter(F.sequence(F.lit(0), F.size(hits) - need), lambda i: place(i + (need - 1)) - place(i) < most)
    return F.when(F.size(hits) >= need, _let(starts, lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none))).otherwise(none)


def scan(df: DataFrame, text: str = "text", templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """`df` with `licences`: (name, first, last, dice) of every match; first and last are numbers of words, from 0. By name, then place."""
    known = {n: Counter(bigrams(t)) for n, t in sorted((TEMPLATES if templates is None else templates).items())}
    known = {n: c for n, c in known.items() if c}
    type_ = "array<struct<name:string,first:int,last:int,dice:double>>"
    if not known:
        return df.withColumn("licences", F.array().cast(type_))
    every = sorted(set().union(*known.values()))
    lefts, rights = (sorted({g.split(" ")[k] for g in every}) for k in (0, 1))
    fewest = min(bounds(sum(c.values()), least)[0] for c in known.values())
    none = F.array().cast(type_)

    def places(words: Column) -> Column:
        gram = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))
        inside = F.filter(  # most places fail at one of the words, which costs less than to join them
            F.sequence(F.lit(0), F.size(words) - 2),
            lambda i: F.get(words, i).isin(lefts) & F.get(words, i + 1).isin(rights) & gram(i).isin(every),
        )
        return F.transform(inside, lambda i: F.struct(i.alias("p"), gram(i).alias("g")))

    def named(name: str, counts: Counter, hits: Column) -> Column:
        own = F.filter(hits, lambda x: x["g"].isin(sorted(counts)))
        found = _let(own, lambda h: _matches(h, counts, least))
        return F.transform(found, lambda m: F.struct(F.lit(name).alias("name"), m["first"].alias("first"), m["last"].alias("last"), m["dice"].alias("dice")))

    def all_named(hits: Column) -> Column:
        return F.when(F.size(hits) >= fewest, F.flatten(F.array(*(named(n, c, hits) for n, c in known.items())))).otherwise(none)

    plain = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[^0-9a-z]+", " "))
    found = _let(F.split(plain, " "), lambda w: F.when(F.size(w) > 1, _let(places(w), all_named)).otherwise(none))
    return df.withColumn("licences", found.cast(type_))
