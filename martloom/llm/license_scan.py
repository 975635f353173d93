"""License scans: phrases, and license templates with optional and replaceable regions as token automata.

A template is the wording of a license in a small markup: ``[[...]]`` is a region that may be missing, ``{{a-b}}`` stands
for any a to b words. It is compiled once into an automaton over word hashes: a state for each place in the wording, with
moves by a word, by any word, or by none past an optional region. A text is accepted where some run of its words leads
from the first state to the last, so all mandatory words must be there, in order and without others between them.

The templates of MIT (the first), ISC and both of BSD are whole licenses, disclaimers included: a text that leaves out or
alters a word of them is not accepted. Those of Apache, GPL and CC-BY, and MIT's other two, are notices that name a license:
whole in themselves, they say which license is meant; the text of such a license has their label only where a notice stands in it.

Places where a template can begin are found for all texts of a batch at once; the automaton runs from those places only.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from martloom.llm import tokens
from martloom.llm.common import with_text_columns

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

WARRANTY = (
    'the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the'
    " warranties of merchantability, fitness for a particular purpose and noninfringement. in no event shall the"
    " {{0-8}} be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise,"
    " arising from, out of or in connection with the software or the use or other dealings in the software."
)
BSD_HEAD = (
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: [[1.]] redistributions of source code must retain the above copyright notice, this"
    " list of conditions and the following disclaimer. [[2.]] redistributions in binary form must reproduce the above"
    " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials"
    " provided with the distribution."
)
BSD_TAIL = (
    ' this software is provided by {{1-20}} "as is" and any express or implied warranties, including, but not limited to, the'
    " implied warranties of merchantability and fitness for a particular purpose are disclaimed. in no event shall {{1-20}} be"
    " liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to,"
    " procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and"
    " on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in"
    " any way out of the use of this software, even if advised of the possibility of such damage."
)
# Wordings of public licenses and of the notices that name them, by label.
TEMPLATES = {
    "MIT": [
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "software"), to deal in the software without restriction, including without limitation'
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and"
        " to permit persons to whom the software is furnished to do so, subject to the following conditions: the above"
        " copyright notice and this permission notice [[(including the next paragraph)]] shall be included in all copies"
        " or substantial portions of the software. " + WARRANTY,
        "[[this {{1-2}} is]] licensed under the mit license",
        "released under the mit license",
    ],
    "ISC": [
        "permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies. the software"
        ' is provided "as is" and {{1-12}} disclaims all warranties with regard to this software including all implied warranties'
        " of merchantability and fitness. in no event shall {{1-12}} be liable for any special, direct, indirect, or consequential"
        " damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract,"
        " negligence or other tortious action, arising out of or in connection with the use or performance of this software."
    ],
    "BSD-2-Clause": [BSD_HEAD + BSD_TAIL],
    "BSD-3-Clause": [
        BSD_HEAD + " [[3.]] neither the name of {{1-20}} nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission." + BSD_TAIL
    ],
    "Apache-2.0": [
        'licensed under the apache license, version 2.0 [[(the "license")]]',
        "released under the apache license, version 2.0",
    ],
    "GPL-2.0": ["licensed under the gnu general public license[[,]] version 2"],
    "GPL-3.0": ["licensed under the gnu general public license[[,]] version 3"],
    "GPL-or-later": [
        "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the"
        " free software foundation[[,]] either version {{1-2}} of the license, or (at your option) any later version"
    ],
    "CC-BY-4.0": ["licensed under [[a]] cc by 4.0", "licensed under a creative commons attribution 4.0 international license"],
    "CC-BY-NC-4.0": ["licensed under [[a]] cc by-nc 4.0"],
    "CC-BY-SA-4.0": ["licensed under [[a]] cc by-sa 4.0"],
}

MARKUP = re.compile(r"(\[\[)|(\]\])|\{\{(\d+)-(\d+)\}\}|([0-9a-z\x80-\U0010FFFF]+)")


def word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(tokens.span_hashes(data, np.array([0]), np.array([len(data)]))[0])


class Automaton:
    """States of one template: moves by word, by any word, and by none."""

    def __init__(self, template: str):
        self.by_word: list[dict[int, int]] = [{}]
        self.by_any: list[set[int]] = [set()]
        self.by_none: list[set[int]] = [set()]
        opened: list[int] = []
        for opens, closes, least, most, word in MARKUP.findall(template.lower()):
            last = len(self.by_word) - 1
            if opens:
                opened.append(last)
            elif closes:
                self.by_none[opened.pop()].add(last)
            elif word:
                self.by_word[last][word_hash(word)] = self._state()
            else:
                places = [last]
                for _ in range(int(most)):
                    places.append(self._state())
                    self.by_any[places[-2]].add(places[-1])
                for place in places[int(least) : -1]:
                    self.by_none[place].add(places[-1])
        self.final = len(self.by_word) - 1
        self.first = self.reached({0})

    def _state(self) -> int:
        for moves in (self.by_word, self.by_any, self.by_none):
            moves.append({} if moves is self.by_word else set())
        return len(self.by_word) - 1

    def reached(self, states: set[int]) -> frozenset[int]:
        """The states, and those that moves by none lead to."""
        found, todo = set(states), list(states)
        while todo:
            for state in self.by_none[todo.pop()] - found:
                found.add(state)
                todo.append(state)
        return frozenset(found)

    @property
    def openings(self) -> set[int]:
        """Words that an accepted run can begin with; templates do not begin with any word."""
        return {word for state in self.first for word in self.by_word[state]}

    def accepts(self, hashes: np.ndarray, start: int, stop: int) -> bool:
        """Whether some run of the words from start on, before stop, is the template's wording."""
        states = self.first
        for k in range(start, stop):
            word, after = int(hashes[k]), set()
            for state in states:
                if (then := self.by_word[state].get(word)) is not None:
                    after.add(then)
                after |= self.by_any[state]
            if not after:
                return False
            states = self.reached(after)
            if self.final in states:
                return True
        return False


@cache
def compiled() -> tuple[list[tuple[str, np.ndarray]], list[tuple[str, Automaton, np.ndarray, np.ndarray]]]:
    """Phrases as hashes; templates with their automata, possible first words and the second words that may follow."""
    phrases = [(label, np.array([word_hash(w) for w in phrase.split()], dtype=np.uint64)) for phrase, label in PHRASES.items()]
    templates = []
    for label, wordings in TEMPLATES.items():
        for wording in wordings:
            automaton = Automaton(wording)
            seconds = set()
            for state in automaton.first:
                for then in automaton.by_word[state].values():
                    after = automaton.reached({then})
                    seconds |= {w for s in after for w in automaton.by_word[s]}
                    seconds |= {-1} if any(automaton.by_any[s] for s in after) else set()
            known = np.array(sorted(seconds - {-1}), dtype=np.uint64) if -1 not in seconds else None
            templates.append((label, automaton, np.array(sorted(automaton.openings), dtype=np.uint64), known))
    return phrases, templates


def scan_texts(texts: pa.Array) -> list[pa.Array]:
    phrases, templates = compiled()
    words = tokens.find_words(texts, tokens.IS_NAME, tokens.LOWER_ASCII)
    hashes, doc, firsts, counts = words.hashes(), words.doc, words.firsts(), words.counts()
    base = np.zeros(words.texts, dtype=np.int64)
    low, high = np.full(words.texts, np.iinfo(np.int64).max), np.full(words.texts, -1)
    base_labels: list[set[str]] = [set() for _ in range(words.texts)]
    found: list[set[str]] = [set() for _ in range(words.texts)]
    for label, phrase in phrases:
        last = len(hashes) - len(phrase) + 1
        if last <= 0:
            continue
        here = doc[:last] == doc[len(phrase) - 1 :]
        for k, word in enumerate(phrase):
            here &= hashes[k : k + last] == word
        at = np.flatnonzero(here)
        place = at - firsts[doc[at]]
        np.add.at(base, doc[at], 1)
        np.minimum.at(low, doc[at], place)
        np.maximum.at(high, doc[at], place)
        for d in np.unique(doc[at]).tolist():
            base_labels[d].add(label)
    for label, automaton, openings, seconds in templates:
        at = np.flatnonzero(np.isin(hashes, openings))
        if seconds is not None:
            at = at[at + 1 < len(hashes)]
            at = at[np.isin(hashes[at + 1], seconds)]
        for k in at.tolist():
            d = int(doc[k])
            if label not in found[d] and automaton.accepts(hashes, k, int(firsts[d] + counts[d])):
                found[d].add(label)
    some = base > 0
    joined = [",".join(sorted(b)) for b in base_labels], [",".join(sorted(b | f)) for b, f in zip(base_labels, found, strict=True)]
    score = [1.0 if f else 0.5 if b else 0.0 for b, f in zip(base_labels, found, strict=True)]
    return [
        pa.array(counts.astype(np.int64)), pa.array(base), pa.array(low, mask=~some), pa.array(high, mask=~some),
        *[pa.array(x, pa.string()) for x in joined], pa.array(score),
    ]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score for every document.

    Words are runs of a-z, digits and characters beyond ASCII after A-Z became small. score: 1 where a template is
    accepted, 0.5 where only phrases stand, else 0. NULL and empty texts have no words, no labels and the score 0.
    """

    def make() -> Callable[[pa.Array], list]:
        return scan_texts

    kinds = {"n_words": LongType(), "n_base": LongType(), "first_word": LongType(), "last_word": LongType(), "base_labels": StringType(), "labels": StringType(), "score": DoubleType()}
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_text_columns(plain, "text", StructType([StructField(n, t) for n, t in kinds.items()]), make).drop("text")
