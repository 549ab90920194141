"""Licences in texts: a generalised suffix automaton over the words of licence templates.

A text's words are streamed through the automaton. At each word it gives the matching statistic: the length
of the longest run of words that ends here and stands in some template, and all places where it
stands. Runs that no further word prolongs are matches; long ones are chained, in the order of text and template
alike, into spans that cover part of a template. Short phrases are templates, too: a phrase stands wherever the
automaton's state is the phrase's own or lies below it in the tree of suffix links.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeward.llm.text import arrow_column, as_bytes, settle

# Words: ASCII letters and digits and everything beyond ASCII; A-Z count as a-z.
_KEPT = string.ascii_letters + string.digits
_FOLD = bytes(ord(chr(b).lower()) if b > 127 or chr(b) in _KEPT else 32 for b in range(128)) + bytes(range(128, 256))

# Phrases that name a licence, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Texts of common licences and notices, without names and years.
_GRANT = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
_SOURCE = "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
_BINARY = (
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution"
)
_ENDORSE = (
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission"
)
_HOLDERS = (
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not "
    "limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the "
    "copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including "
    "but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused "
    "and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out "
    "of the use of this software even if advised of the possibility of such damage"
)
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
        "to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software the software is provided as is without warranty of any kind express or implied including but not limited "
        "to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or "
        "copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising "
        "from out of or in connection with the software or the use or other dealings in the software",
    ),
    ("bsd-2-clause", f"{_GRANT} {_SOURCE} {_BINARY} {_HOLDERS}"),
    ("bsd-3-clause", f"{_GRANT} {_SOURCE} {_BINARY} {_ENDORSE} {_HOLDERS}"),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
        "the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims "
        "all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the "
        "author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data "
        "or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing "
        "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express "
        "or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version this program is "
        "distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or "
        "fitness for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu "
        "general public license along with this program",
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
        "this file you can obtain one at http mozilla org mpl 2 0",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or "
        "distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    ),
    (
        "cc-by",
        "you are free to share copy and redistribute the material in any medium or format and adapt remix transform and build upon the "
        "material for any purpose even commercially under the following terms attribution you must give appropriate credit provide a link to "
        "the license and indicate if changes were made",
    ),
)


@dataclass(frozen=True)
class Library:
    """``phrases`` and ``templates`` are pairs: (words, label) and (label, words)."""

    phrases: tuple[tuple[str, str], ...] = PHRASES
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    least: int = 5  # words of a match that may be chained
    gap: int = 40  # words of the text that a chain may leave out at once
    share: float = 0.5  # of a template's words, for its label to be given


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences (Blumer et al., 1985).

    ``ends[state]`` are the places ``(sequence, end)`` at which the state's runs of words end.
    """

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        self.whole = []  # the state of each whole sequence
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence, 1):
                last = self._extend(last, word, own)
                own[last].append((number, place))
            self.whole.append(last)
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            own[self.link[state]] += own[state]
        self.ends = [tuple(sorted(set(e))) for e in own]

    def _state(self, length: int, link: int, following: dict[bytes, int], own: list) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        own.append([])
        return len(self.link) - 1

    def _extend(self, last: int, word: bytes, own: list) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, word, known, own)
        made = self._state(self.length[last] + 1, 0, {}, own)
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = made
            at = self.link[at]
        if at != -1:
            self.link[made] = self._split(at, word, self.next[at][word], own)
        return made

    def _split(self, at: int, word: bytes, target: int, own: list) -> int:
        """The state of the runs that come from ``at`` by ``word``, split off ``target`` where that has longer ones."""
        if self.length[target] == self.length[at] + 1:
            return target
        clone = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]), own)
        self.link[target] = clone
        while at != -1 and self.next[at].get(word) == target:
            self.next[at][word] = clone
            at = self.link[at]
        return clone


class Scanner:
    def __init__(self, library: Library):
        self.library = library
        phrases = [words_of(p.encode()) for p, _ in library.phrases]
        texts = [words_of(t.encode()) for _, t in library.templates]
        if not all(phrases) or not all(texts):
            raise ValueError("phrases and templates need a word each")
        self.sizes = [len(x) for x in phrases + texts]
        self.automaton = a = Automaton(phrases + texts)
        self.vocabulary = frozenset(w for x in phrases + texts for w in x)
        self.first_text = len(phrases)
        own = {}
        for number in range(len(phrases)):
            own.setdefault(a.whole[number], []).append(number)
        self.below: list[tuple[int, ...]] = [()] * len(a.link)  # phrases that end each state's longest run
        for state in sorted(range(1, len(a.link)), key=a.length.__getitem__):
            self.below[state] = self.below[a.link[state]] + tuple(own.get(state, ()))

    def statistics(self, words: list[bytes]):
        """``place, length, state`` for every word of the vocabulary: the matching statistic and its state."""
        following, link, length = self.automaton.next, self.automaton.link, self.automaton.length
        known, before, state, run = self.vocabulary, -2, 0, 0
        for place in [k for k, w in enumerate(words) if w in known]:
            if place != before + 1:
                state = run = 0
            before, word = place, words[place]
            while word not in following[state]:
                state = link[state]
                run = length[state]
            state = following[state][word]
            run += 1
            yield place, run, state

    def scan(self, words: list[bytes]):
        """Places of phrases ``(start, phrase)`` in order, and matches by template: ``(start, end, its start)``."""
        places, matches = [], {}
        least, ends = self.library.least, self.automaton.ends
        held = None  # the run that the next word may prolong
        for place, run, state in self.statistics(words):
            if held and not (place == held[0] + 1 and run == held[1] + 1):
                self._match(held, matches)
            held = (place, run, state) if run >= least and ends[state] else None
            for number in self.below[state]:
                if run >= self.sizes[number]:
                    places.append((place + 1 - self.sizes[number], number))
        if held:
            self._match(held, matches)
        return sorted(places), matches

    def _match(self, held: tuple[int, int, int], matches: dict) -> None:
        place, run, state = held
        for number, end in self.automaton.ends[state]:
            if number >= self.first_text:
                matches.setdefault(number, []).append((place + 1 - run, place + 1, end - run))

    def chains(self, matches: dict):
        """Spans ``(start, end, template, covered)``, of each chain's first match the one that covers most."""
        found = []
        for number, runs in matches.items():
            runs.sort(key=lambda m: (m[1], m[2]))
            best: list[tuple[int, int]] = []  # words covered, first match of the chain
            low, leaders = 0, {}
            for k, (start, end, at) in enumerate(runs):
                while runs[low][1] < start - self.library.gap:
                    low += 1
                most = (end - start, k)
                for j in range(low, k):
                    overlap = max(runs[j][1] - start, runs[j][2] + runs[j][1] - runs[j][0] - at, 0)
                    if overlap < end - start and runs[j][0] <= start and runs[j][2] <= at:
                        most = max(most, (best[j][0] + end - start - overlap, best[j][1]), key=lambda b: (b[0], -b[1]))
                best.append(most)
                lead = leaders.get(most[1])
                if lead is None or most[0] > lead[0]:
                    leaders[most[1]] = (most[0], end)
            found += [(runs[k][0], end, number, covered) for k, (covered, end) in leaders.items()]
        return sorted(found)

    def spans(self, matches: dict) -> list[tuple[str, int, int, int, float]]:
        """``label, start, end, covered, share`` of the chains that no better chain's span contains."""
        rated = [(s, e, c, c / self.sizes[n], n) for s, e, n, c in self.chains(matches)]
        kept, active = [], []
        # By start, the longest first: whatever contains a span comes before it or at its side.
        for one in sorted(rated, key=lambda r: (r[0], -r[1], -r[2], -r[3], r[4])):
            active = [a for a in active if a[1] > one[0]]
            if not any(a[1] >= one[1] and (a[2], a[3]) > (one[2], one[3]) for a in active):
                active.append(one)
                kept.append(one)
        label = [lab for _, lab in self.library.phrases] + [lab for lab, _ in self.library.templates]
        return [(label[n], s, e, c, share) for s, e, c, share, n in kept]


@lru_cache(maxsize=4)
def scanner(library: Library) -> Scanner:
    return Scanner(library)


_FOUND = (
    "struct<n_words:bigint,places:array<struct<label:string,start:bigint>>,"
    "spans:array<struct<label:string,start:bigint,end:bigint,covered:bigint,share:double>>>"
)


def _scan(library: Library):
    def run(texts: pa.Array) -> pa.Array:
        scan, rows = scanner(library), []
        for raw in as_bytes(texts):
            words = words_of(raw)
            places, matches = scan.scan(words)
            rows.append(
                {
                    "n_words": len(words),
                    "places": [{"label": library.phrases[n][1], "start": s} for s, n in places],
                    "spans": [
                        {"label": n, "start": s, "end": e, "covered": c, "share": share}
                        for n, s, e, c, share in (scan.spans(matches) if matches else ())
                    ],
                }
            )
        place = pa.struct([("label", pa.string()), ("start", pa.int64())])
        span = pa.struct(
            [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]
        )
        kind = pa.struct([("n_words", pa.int64()), ("places", pa.list_(place)), ("spans", pa.list_(span))])
        return pa.array(rows, kind)

    return run


def with_licenses(docs: DataFrame, text: str = "text", out: str = "licenses", library: Library = Library()) -> DataFrame:
    """Adds a struct: ``n_words``, ``places`` of phrases (label and start) and ``spans`` of templates (label, start, end,
    words covered and their share of the template), all counted in words from 0 and in order.

    Spans stand for every chain of matches, however small its share; ``labels`` applies the library's limit. A
    null or empty text has no words and nothing found. A long text is streamed once; repeated rows are scanned
    alike. A column named ``out`` is replaced, all others stay; no rows give no rows.
    """
    settle(docs.sparkSession)
    return docs.withColumn(out, arrow_column(_scan(library), _FOUND)(F.col(text)))


def base_labels(found: Column) -> Column:
    """Distinct labels of the phrases, sorted."""
    return F.array_sort(F.array_distinct(F.transform(found["places"], lambda p: p["label"])))


def labels(found: Column, library: Library = Library()) -> Column:
    """Distinct labels of the phrases and of the templates of which enough is covered, sorted."""
    enough = F.filter(found["spans"], lambda s: s["share"] >= library.share)
    return F.array_sort(F.array_union(base_labels(found), F.transform(enough, lambda s: s["label"])))


def score(found: Column) -> Column:
    """Largest covered share of a template: 1 where a phrase stands, 0 where nothing is found."""
    phrase = F.when(F.size(found["places"]) > 0, 1.0).otherwise(0.0)
    return F.greatest(phrase, F.coalesce(F.array_max(F.transform(found["spans"], lambda s: s["share"])), F.lit(0.0)))
