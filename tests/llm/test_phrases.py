"""Phrases against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest

from footfall.llm import hattrie, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, max_words, min_count, top, contained):
    """rows: (text, lang)."""
    out = []
    for lang in sorted({lang or "und" for _, lang in rows}):
        f, n = Counter(), 0
        for text, own in rows:
            if (own or "und") == lang:
                for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
                    w = re.findall(r"[^\x20\x09]+", piece)
                    n += len(w)
                    f.update(tuple(w[i : i + k]) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
        candidates = {g: c for g, c in f.items() if len(g) > 1 and c >= min_count}
        kept = []
        for g, a in candidates.items():
            score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            inside = [
                c for h, c in candidates.items()
                if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
            ]
            if not any(100 * c >= contained * a for c in inside):
                kept.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def mined(make, rows, **options):
    docs = make([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    docs = docs.selectExpr("*", "1 AS n", "2 AS word", "'q' AS gram")
    return sorted(tuple(r) for r in phrases.mine_phrases(docs, **options).collect())


def sentences(n, seed, words=9):
    rng = np.random.default_rng(seed)
    names = [*(f"w{i}" for i in range(words - 2)), "É", "the"]
    out = []
    for _ in range(n):
        line = [names[i] for i in np.minimum(rng.geometric(0.3, rng.integers(1, 40)) - 1, words - 1)]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ?"]) for w in line)
        out.append((text, rng.choice(["en", "de", None], p=[0.6, 0.3, 0.1])))
    return out


@pytest.mark.parametrize("max_words, min_count, contained", [(3, 10, 50), (2, 3, 50), (4, 2, 30)])
def test_like_plain_python(make, max_words, min_count, contained):
    rows = sentences(150, max_words)
    rows += [(None, "en"), ("", "fr"), (" \t. ,", "fr"), ("New York " * 12, "En"), ("New York " * 12, "En"), ("a", None)]
    options = dict(max_words=max_words, min_count=min_count, top=2000, contained=contained)
    got = mined(make, rows, **options)
    assert got == brute(rows, **options) and len(got) > 20


def test_only_the_first_are_returned(make):
    rows = sentences(80, 5)
    got = mined(make, rows, min_count=2, top=7)
    assert got == brute(rows, 3, 2, 7, 50)


def test_small_memory_small_batches(make, monkeypatch):
    """Containers burst, subtrees are spilled again and again; sums stay."""
    for module, name, value in ((hattrie, "BURST", 4), (phrases, "GRAMS", 30), (phrases, "ROWS", 50), (phrases, "TEXT_BYTES", 500)):
        monkeypatch.setattr(module, name, value)
    rows = sentences(60, 9)
    assert mined(make, rows, min_count=3) == brute(rows, 3, 3, 2000, 50)


def test_a_common_pair_and_a_long_text(make):
    rows = [("of the " * 100_000, "en")] + [("Of the x%d" % i, "en") for i in range(2000)]
    assert mined(make, rows) == brute(rows, 3, 10, 2000, 50)


def test_nothing_there(make):
    assert mined(make, []) == []
    assert mined(make, [(None, None), ("one two three", "en")]) == []


def test_words_and_pieces():
    import pyarrow as pa

    texts = pa.array(["Ab c.d", None, "", "\tx  y\n\nZ", ".", "É!é"])
    words, piece, text = phrases.words_of(texts)
    assert words.to_pylist() == ["ab", "c", "d", "x", "y", "z", "É", "é"]
    assert text.tolist() == [0, 0, 0, 3, 3, 3, 5, 5]
    same = np.diff(piece) == 0
    assert same.tolist() == [True, False, False, True, False, False, False]


@pytest.mark.parametrize("burst, limit, depth", [(1, 5, 1), (3, 40, 2), (8, 10**9, 3), (2, 60, 5)])
def test_trie_counts_exactly(monkeypatch, burst, limit, depth):
    monkeypatch.setattr(hattrie, "BURST", burst)
    rng = np.random.default_rng(burst)
    trie, want, got = hattrie.HatTrie(depth, limit), Counter(), Counter()
    runs = []
    for _ in range(12):
        rows = np.minimum(rng.geometric(0.2, (80, depth)), 30).astype(np.int32) - 2
        rows[0] = hattrie.LAST
        want.update(map(tuple, rows.tolist()))
        runs += trie.add(rows)
        assert trie.root.n <= limit
    runs += trie.rest()
    for rows, counts in runs:
        listed = list(map(tuple, rows.tolist()))
        assert listed == sorted(set(listed))  # a sorted run
        got.update(dict(zip(listed, counts.tolist())))
    assert got == want and trie.root.n == 0
