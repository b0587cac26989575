"""The license scan against exact word search and against all edits by dynamic programming."""

import random
import re

import pytest

from tessitura.llm import license_scan as ls

PLAIN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall((text or "").translate(PLAIN))


def base(text):
    found, out = plain_words(text), []
    for phrase, label in ls.PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(found)) if found[i : i + len(p)] == p]
    return sorted(out)


def distances(notice, found):
    """Of each last word: the least edits with which the notice ends there, from any first word (edit distances row by row)."""
    text = " ".join(found)
    starts = {0, *(i + 1 for i, c in enumerate(text) if c == " ")}
    exact = len(notice.exact)
    out = {}
    for first in sorted(starts):
        if text[first : first + exact] != notice.exact:
            continue
        tail = text[first + exact : first + exact + len(notice.rest) + notice.edits + 1]
        row = list(range(len(notice.rest) + 1))
        for j, c in enumerate(tail, 1):
            new = [j]
            for i, d in enumerate(notice.rest, 1):
                new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != d)))
            row = new
            end = first + exact + j
            if (end == len(text) or text[end] == " ") and row[-1] <= notice.edits:
                out.setdefault((text[:first].count(" "), text[:end].count(" ") + 1), row[-1])
    return out


def mutated(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(1, len(text) - 1)
        text = rng.choice([text[:i] + rng.choice("abcxyz") + text[i + 1 :], text[:i] + text[i + 1 :], text[:i] + rng.choice("abc e") + text[i:]])
    return text


def test_edits_against_dynamic_programming():
    """Labels are those within the bound and no others; each span is one of the matches; each match meets a span."""
    rng, scanner = random.Random(4), ls.Scanner()
    for trial in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            notice = rng.choice(scanner.notices)
            parts += [rng.choice(["", "the public", "license", "mit", "gnu gnu", "é général", "a b c"]), mutated(rng, notice.text, rng.randrange(0, notice.edits + 3)).title()]
        text = rng.choice([" ", "\n", ", "]).join(parts)
        found = plain_words(text)
        number, places, spans = scanner.scan(text)
        assert number == len(found) and places == base(text)
        want = {}
        for n in scanner.notices:
            for at, edits in distances(n, found).items():
                want.setdefault(n.label, {}).setdefault(at, []).append(edits)
        assert {s[0] for s in spans} == set(want), (trial, text)
        for label, a, b, edits in spans:
            assert min(want[label].get((a, b), [99])) <= edits, (trial, text, label)
        for label, matches in want.items():
            assert all(any(s[0] == label and s[1] < b and a < s[2] for s in spans) for a, b in matches)


def test_pieces_cover_notices():
    for n in ls.Scanner().notices:
        assert n.exact or "".join(p for _, p in n.pieces()) == n.text and len(n.pieces()) == n.edits + 1


ROWS = [
    (1, "Released under the MIT License.", 5, 1, 3, 3, "mit", "mit", 1.0),
    (2, "Released under the MIT Licence.", 5, 0, None, None, "", "mit", 1 - 1 / 11),
    (3, "GNU General\nPublic-License or Apache License; cc by", 9, 3, 0, 7, "apache,cc-by,gpl", "apache,cc-by,gpl", 1.0),
    (4, "Submit license, permit licence: the mit licensing", 7, 0, None, None, "", "", 0.0),
    (5, None, 0, 0, None, None, "", "", 0.0),
    (6, "", 0, 0, None, None, "", "", 0.0),
    (7, "Mozila Public Licence", 3, 0, None, None, "", "mpl", 1 - 2 / 22),
    (None, "word " * 50_000 + "apache license", 50_002, 1, 50_000, 50_000, "apache", "apache", 1.0),
    (1, "Released under the MIT License.", 5, 1, 3, 3, "mit", "mit", 1.0),
]


def test_rows(spark):
    df = spark.createDataFrame([(i, t, "l", 3, 0.5) for i, t, *_ in ROWS], "doc_id long, text string, labels string, n_words int, score double")
    got = ls.scan(df).collect()
    assert [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], ",".join(r["base_labels"]), ",".join(r["labels"])) for r in got] == [(i, *rest[:-1]) for i, _, *rest in ROWS]
    assert [r["score"] for r in got] == pytest.approx([r[-1] for r in ROWS])
    assert all(ROWS[k][1][s["start"] : s["end"]] for k, r in enumerate(got) for s in r["spans"])
    assert ROWS[6][1][slice(got[6]["spans"][0]["start"], got[6]["spans"][0]["end"])] == "Mozila Public Licence"
    assert ls.scan(df.limit(0)).count() == 0


def test_base_on_given_texts(spark):
    """All columns of the base against a search of words over the smallest table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {}
    for r in docs.collect():
        at = base(r["text"])
        want[r["doc_id"]] = (len(plain_words(r["text"])), len(at), at[0][0] if at else None, at[-1][0] if at else None, sorted({x for _, x in at}))
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in ls.scan(docs).collect()}
    assert got == want and any(v[1] for v in want.values())
