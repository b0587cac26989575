"""The source audit against a plain count of all terms."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tessitura.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, most):
    docs, count, groups = Counter(), Counter(), defaultdict(set)
    for text, lang, source in ((t or "", a or "", s or "") for t, a, s in rows):
        found = TERM.findall(text.translate(SMALL))
        groups[lang].add(source)
        docs.update((lang, t) for t in set(found))
        count.update((lang, source, t) for t in found)
    out = []
    for lang, sources in groups.items():
        kept = [t for (a, t), n in docs.items() if a == lang and n >= least]
        n = lambda s, t, lang=lang: count[lang, s, t]
        total = {s: sum(n(s, t) for t in kept) for s in sources}
        whole = sum(total.values())
        p = {(s, t): 1 + 10**9 * (n(s, t) + 5) // (total[s] + 5 * len(kept)) for s in sources for t in kept}
        q = {t: 1 + 10**9 * (sum(n(s, t) for s in sources) + 5) // (whole + 5 * len(kept)) for t in kept}
        for s in sources:
            pair = [(-sum(abs(p[s, t] - p[o, t]) for t in kept), o.encode(), o) for o in sources if o != s]
            term = [(q[t] - p[s, t], t.encode(), t) for t in kept if n(s, t) and p[s, t] > q[t]]
            out += [(lang, s, "pair", x, -v, r) for r, (v, _, x) in enumerate(sorted(pair), 1)]
            out += [(lang, s, "term", x, -v, r) for r, (v, _, x) in enumerate(sorted(term)[:most], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i % 50, t, a, s, i, "x") for i, (t, a, s) in enumerate(rows)], "doc_id long, text string, lang string, source string, n long, term string")


@pytest.mark.parametrize("run_rows, chunk", [(1, 40), (200_000, 8 << 20)])
def test_against_plain_counts(spark, monkeypatch, run_rows, chunk):
    """Runs of one term and chunks of one text, a hot source and term, nulls, empty and long texts, repeated rows, a bare group."""
    monkeypatch.setattr(divergence, "CHUNK_BYTES", chunk)
    rng = random.Random(3)
    words = [*"The the THE of Of à É日本 ß x-y don't a1b \U0001f600z".split(), *(f"w{k:c}" for k in range(97, 123))]
    rows = [(" ".join(rng.choices(words, weights=[9, *[1] * (len(words) - 1)], k=rng.randrange(0, 60))), rng.choice(["en", "en", "fr", None]), rng.choice(["hot", "hot", "hot", "a", "b", None])) for _ in range(150)]
    rows += [("the word " * 20_000, "en", "long")] + rows[:10] + [(None, "en", "bare"), ("", "xx", "one"), (None, "xx", "two"), (None, None, "three"), ("\x00the\x7fend", "en", "a")]
    got = divergence.audit(frame(spark, rows), least_docs=8, most_terms=7, run_rows=run_rows)
    want = brute(rows, 8, 7)
    assert sorted(map(tuple, got.collect())) == want and any(r[2] == "term" for r in want)


def test_empty_and_nothing_kept(spark):
    assert divergence.audit(frame(spark, [("a b", "en", "s")]).limit(0)).count() == 0
    got = sorted(map(tuple, divergence.audit(frame(spark, [("a b", "en", "s"), ("c", "en", "t"), ("c", "fr", "alone")])).collect()))
    assert got == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
