"""Licence scan by a positional index of each file's rarest licence words. DataFrame and SQL functions only."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Phrases whose every place counts, and their labels.
BASE = (("mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Passages of licences that the method finds: label, words in order, the phrase in them that must stand.
PASSAGES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international", "attribution noncommercial"),
    ("cc-by", "creative commons attribution 4 0 international", "commons attribution 4 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2", "this program is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "this permission notice shall be included"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "must reproduce the above copyright notice"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "required by applicable law or agreed to in writing"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness", "the author disclaims all warranties"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "must be plainly marked as such"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license as published"),
)
# Whole licences and notices as published, and the phrase in them that must stand.
WHOLE = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""", "to any person obtaining a copy"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""", "for any purpose with or without fee"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
        OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
        THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""", "redistributions of source code must retain"),
    ("bsd-3", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""", "neither the name of the"),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
        is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
        original software. 3. This notice may not be removed or altered from any source distribution.""", "must be plainly marked as such"),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or
        authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
        dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
        dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
        copyright law.""", "unencumbered software"),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""", "apache license version 2 0"),
    ("gpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program.""", "either version 3 of the license"),
    ("gpl-2", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""", "either version 2 of the license"),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""", "mozilla public license"),
)
TEMPLATES = PASSAGES + WHOLE
RARE, AGREE, COVER = 5, 2, 0.6
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def quoted(word: str) -> str:
    return "'" + word + "'"


def array_of(items: list[str]) -> str:
    return f"array({', '.join(items)})"


def parts_of(text: str) -> list[str]:
    """Words of a template, as those of a text are taken."""
    return [w for w in re.split(GAP, text.lower()) if w]


def with_words(docs: DataFrame) -> DataFrame:
    """doc_id and the lower-cased words of each text, all of them."""
    text = F.coalesce("text", F.lit(""))
    plain = F.length(text) == F.octet_length(text)  # ASCII alone, where lower() changes A-Z and nothing else
    low = F.when(plain, F.lower(text)).otherwise(ascii_lower(text))
    return docs.select("doc_id", F.array_remove(F.split(low, GAP), "").alias("w"))


def licence_words(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, text, _ in templates for w in parts_of(text)})


def word_idf(words: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """Inverse document frequency, over all documents, of each licence word (so few rows reach the driver); one pass, in which "" counts the documents."""
    vocabulary = licence_words(templates)
    held = F.array_append(F.array_intersect("w", F.array(*map(F.lit, vocabulary))), F.lit(""))
    count = {r["word"]: r["count"] for r in words.select(F.explode(held).alias("word")).groupBy("word").count().collect()}
    return {w: math.log((count.get("", 0) + 1) / (count.get(w, 0) + 0.5)) for w in vocabulary}


def posted(templates, idf: dict[str, float]) -> str:
    """The index of templates as one constant: words in order, their weights and sum, distinct words from the rarest, words and place of the phrase."""
    rows = []
    for t, (label, text, phrase) in enumerate(templates):
        parts, need = parts_of(text), parts_of(phrase)
        first = next(i for i in range(len(parts)) if parts[i : i + len(need)] == need)
        rank = lambda some: array_of([quoted(w) for w in sorted(set(some), key=lambda w: (-idf[w], w))])
        weights = array_of([f"{idf[w]:.9f}D" for w in parts])
        total = sum(float(f"{idf[w]:.9f}") for w in parts)
        rows.append(f"named_struct('t', {t}, 'label', {quoted(label)}, 'body', {array_of([quoted(w) for w in parts])}, 'weights', {weights}, 'total', {total:.9f}D, 'ranked', {rank(parts)}, 'need', {rank(need)}, 'a', {first}, 'b', {first + len(need) - 1})")
    return array_of(rows)


def license_scan(docs: DataFrame, templates=TEMPLATES, base=BASE, rare: int = RARE, agree: int = AGREE, cover: float = COVER) -> DataFrame:
    """Licence labels of every whole text.

    Words are the runs of digits, lower-cased letters and non-ASCII characters. ``base`` phrases are found at every
    place where their words stand consecutively. For licences and notices that were reworded or cut, each template is
    looked up by the ``rare`` highest-IDF words that *the file* holds of it: where one of them stands, each posting of
    the word gives the place where the template would start. Postings are intersected: only starts on which ``agree``
    words or more agree are looked at further. There all words of the template that stand in their places are weighed
    by IDF; the place counts if they reach ``cover`` of the template's weight and its mandatory phrase stands there word
    for word. A template whose phrase needs a word that the file lacks, or of whose weight the file's distinct words hold
    less than ``cover``, can't count at any place and is not looked up.

    All work is inside the row, so nothing is shuffled but the document frequencies; it is linear in the words of the
    text. Null, empty and wordless texts give no words, null first_word and last_word, empty labels and score 0.
    score is 1 with a base phrase, else the best cover, 1 at most however its sums round. Null or repeated ids and
    repeated rows pass through as rows; other columns are ignored. An empty table gives an empty result.
    """
    words = with_words(docs)
    index = posted(templates, word_idf(words, templates))
    vocabulary = sorted({*licence_words(templates), *(w for phrase, _ in base for w in phrase.split())})
    marks = []
    for phrase, label in base:
        need = phrase.split()
        held = " and ".join(f"array_contains(held, {quoted(x)})" for x in need)
        test = " and ".join(f"get(w, i + {k}) <=> {quoted(x)}" for k, x in enumerate(need))
        marks.append(f"if({held}, transform(filter(sequence(0, size(w) - 1), i -> {test}), i -> struct({quoted(label)} as label, i as i)), cast(array() as array<struct<label:string,i:int>>))")
    weight = "aggregate(zip_with(t.body, t.weights, (x, y) -> if(array_contains(held, x), y, 0D)), 0D, (s, y) -> s + y)"
    asked = f"""transform(filter({index}, t -> forall(t.need, x -> array_contains(held, x)) and {weight} / t.total >= {cover}D),
        t -> struct(t.t as t, slice(filter(t.ranked, x -> array_contains(held, x)), 1, {rare}) as mine))"""
    proposed = f"""if(size(asked) = 0, cast(array() as array<struct<t:int,start:int>>), array_sort(flatten(flatten(transform(
        filter(transform(w, (x, i) -> struct(x as x, i as i)), h -> exists(asked, c -> array_contains(c.mine, h.x))),
        h -> transform(filter(asked, c -> array_contains(c.mine, h.x)), c -> transform(filter(
            transform(get({index}, c.t).body, (x, k) -> struct(x as x, k as k)), q -> q.x = h.x), q -> struct(c.t as t, h.i - q.k as start))))))))"""
    found = f"""if(size(proposed) = 0, cast(array() as array<struct<label:string,cover:double>>), transform(filter(transform(
        filter(proposed, (c, i) -> c <=> get(proposed, i + {agree - 1}) and not c <=> get(proposed, i - 1)), c -> struct(get({index}, c.t) as t, c.start as start)),
        c -> c.start + c.t.a >= 0 and forall(sequence(c.t.a, c.t.b), o -> get(w, c.start + o) <=> get(c.t.body, o))),
        c -> struct(c.t.label as label, aggregate(transform(zip_with(c.t.body, c.t.weights, (x, y) -> struct(x as x, y as y)),
            (v, k) -> if(c.start + k >= 0 and get(w, c.start + k) <=> v.x, v.y, 0D)), 0D, (s, y) -> s + y) / c.t.total as cover)))"""
    rows = words.withColumn("held", F.array_intersect("w", F.array(*map(F.lit, vocabulary))))
    rows = rows.select("doc_id", "w", F.expr(f"concat({', '.join(marks)})").alias("places"), F.expr(asked).alias("asked"))
    rows = rows.select("doc_id", F.size("w").alias("n"), "places", "w", F.expr(proposed).alias("proposed"))
    rows = rows.select("doc_id", "n", "places", F.filter(F.expr(found), lambda c: c["cover"] >= cover).alias("found"))
    labels = F.array_distinct(F.transform("places", lambda p: p["label"]))
    starts = F.transform("places", lambda p: p["i"])
    return rows.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.transform("found", lambda c: c["label"]))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.least(F.coalesce(F.array_max(F.transform("found", lambda c: c["cover"])), F.lit(0.0)), F.lit(1.0))).alias("score"),
    )
