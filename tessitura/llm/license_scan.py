"""License scan: exact phrases, and short notices with a bounded number of edits.

A text is read as its words (A-Z lower-cased, single spaces between). A notice of n letters may
have one edit (substitution, insertion, deletion) for each ten letters, four at most; words
named as exact may have none. Split into one piece more than its edits, at least one piece
stands unchanged in whatever matches: pieces and phrases are found by one Aho-Corasick scan,
pieces give windows, and a bounded-error regular expression verifies each window and says
how many edits there are. A match begins and ends with words. So nothing within the bound is
lost, and only windows are verified.

Defined cases: null and empty texts have no words and no labels; ties and repeated rows are judged
one by one; null ids are carried through; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_rows, texts_of
from .decontaminate import words

#: The exact phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Notices (label, words that stand unchanged, the rest).
NOTICES = [
    ("gpl", "", "gnu general public license"),
    ("gpl", "", "this program is free software you can redistribute it and or modify it"),
    ("lgpl", "", "gnu lesser general public license"),
    ("agpl", "", "gnu affero general public license"),
    ("apache", "", "apache license"),
    ("mit", "mit ", "license"),
    ("mit", "", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "bsd ", "license"),
    ("bsd", "", "redistribution and use in source and binary forms with or without modification"),
    ("isc", "", "permission to use copy modify and or distribute this software for any purpose"),
    ("mpl", "", "mozilla public license"),
    ("epl", "", "eclipse public license"),
    ("cc-by", "", "creative commons attribution"),
    ("cc0", "", "creative commons zero"),
    ("unlicense", "", "free and unencumbered software released into the public domain"),
]
LETTERS_AN_EDIT, MOST_EDITS = 10, 4
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPANS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("edits", T.IntegerType())]))
SPANS_ARROW = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))


@dataclass(frozen=True)
class Notice:
    label: str
    exact: str
    rest: str

    @property
    def text(self) -> str:
        return self.exact + self.rest

    @property
    def edits(self) -> int:
        return min(MOST_EDITS, len(self.text) // LETTERS_AN_EDIT)

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece): one of them stands unchanged in each match; with exact words, these alone are the piece."""
        if self.exact:
            return [(0, self.exact)]
        cuts = [len(self.text) * k // (self.edits + 1) for k in range(self.edits + 2)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def pattern(self) -> regex.Pattern:
        rest = f"(?:{regex.escape(self.rest)}){{e<={self.edits}}}"
        return regex.compile(rf"(?e)(?<!\S){regex.escape(self.exact)}{rest}(?!\S)")


class Scanner:
    """The automaton of phrases and pieces, and the notices' patterns."""

    def __init__(self, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str, str]] = NOTICES):
        self.notices = [Notice(*n) for n in notices]
        self.patterns = [n.pattern() for n in self.notices]
        uses: dict[str, list[tuple]] = {}
        for phrase, label in phrases:
            uses.setdefault(f" {phrase} ", []).append((None, label))
        for k, n in enumerate(self.notices):
            for offset, piece in n.pieces():
                uses.setdefault(piece, []).append((k, offset))
        self.built = ahocorasick.Automaton()
        for piece, of in uses.items():
            self.built.add_word(piece, (len(piece), of))
        self.built.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, int]]]:
        """(number of words, base places (first word, label), spans (label, first word, word after, edits))."""
        found = words(text)
        plain = f" {b' '.join(found).decode('utf-8', 'surrogatepass')} " if found else ""
        places, windows = [], {}
        for end, (length, of) in self.built.iter(plain):
            start = end - length + 1
            for k, x in of:
                if k is None:
                    places.append((start, x))
                else:
                    n = self.notices[k]
                    a = start - x - n.edits
                    windows.setdefault(k, []).append((a, a + len(n.text) + 2 * n.edits))
        if not places and not windows:
            return len(found), [], []
        gaps = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        word_at = lambda p: int(np.searchsorted(gaps, p, "right")) - 1  # noqa: E731  of the letter or the space before it
        spans = set()
        for k, parts in windows.items():
            for a, b in merged(parts, 0, len(plain)):
                # whole words: the window's ends move out to the spaces around
                a, b = int(gaps[max(0, np.searchsorted(gaps, a, "right") - 1)]), int(gaps[min(len(gaps) - 1, np.searchsorted(gaps, b))])
                for m in self.patterns[k].finditer(plain, a, b):
                    if m.end() > m.start():
                        spans.add((self.notices[k].label, word_at(m.start()), word_at(m.end() - 1) + 1, sum(m.fuzzy_counts)))
        return len(found), sorted((word_at(p), label) for p, label in places), sorted(spans, key=lambda s: (s[1], s[2], s[0], s[3]))


def merged(parts: list[tuple[int, int]], low: int, high: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((max(low, a), min(high, b)) for a, b in parts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def places_of(text: str, spans: list[tuple[str, int, int, int]]) -> list[dict]:
    """Spans of words as code points of the original text, end exclusive."""
    if not spans:
        return []
    at = [m.span() for m in WORD.finditer(text)]
    return [{"label": label, "start": at[a][0], "end": at[b - 1][1], "edits": e} for label, a, b, e in spans]


def score(places: list, spans: list[tuple[str, int, int, int]], lengths: dict[str, int]) -> float:
    """1 where a phrase or an unedited notice stands, else the best share of unedited letters, 0 without any."""
    return 1.0 if places else max((1 - e / max(lengths[label], e) for label, _, _, e in spans), default=0.0)


def scan(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of each document.

    ``spans`` are matched notices as (label, start, end, edits) in code points of the text; labels
    are sorted arrays. One pass over the texts, no shuffle.
    """
    schema = T.StructType([
        T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.ArrayType(T.StringType())), T.StructField("labels", T.ArrayType(T.StringType())), T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS),
    ])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(), SPANS_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        shortest = {label: min(len(n.text) for n in scanner.notices if n.label == label) for label in {n.label for n in scanner.notices}}
        for batch in batches:
            rows = []
            for text in texts_of(batch.column(1)):
                number, places, spans = scanner.scan(text)
                base = sorted({label for _, label in places})
                every = sorted({*base, *(s[0] for s in spans)})
                rows.append((number, len(places), places[0][0] if places else None, places[-1][0] if places else None, base, every, score(places, spans, shortest), places_of(text or "", spans)))
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names=schema.names)

    return map_rows(documents.select(id_col, text_col), run, schema)
