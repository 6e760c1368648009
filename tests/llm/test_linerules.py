"""Line rules against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from footfall.llm import linerules
from footfall.llm.linerules import Limits

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, limits):
    """{row number: (numbers, left words, base_failed, kept, removed)} of (id, text, host)."""
    texts = [t or "" for _, t, _ in rows]
    norm = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", line.translate(LOWER))).strip(" ")
    held, hosts = defaultdict(set), defaultdict(set)
    for (_, _, host), text in zip(rows, texts):
        hosts[host].add(text)
        for line in text.split("\n"):
            if WORD.search(line):
                held[host, norm(line)].add(text)
    out = []
    for (_, _, host), text in zip(rows, texts):
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        inside = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
        lines = [(i, x) for i, x in enumerate(text.split("\n")) if WORD.search(x)]
        removed = [
            i for i, x in lines
            if len(held[host, norm(x)]) > limits.min_docs
            and 100 * len(held[host, norm(x)]) > limits.share * len(hosts[host])
        ]
        left = len(words) - sum(len(WORD.findall(x)) for i, x in lines if i in removed)
        failed = len(words) < limits.base_words or 100 * len(inside) > limits.base_repeat * len(words)
        kept = not failed and left >= limits.min_words and 100 * left >= limits.min_left * len(words)
        out.append((
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len({x for _, x in lines}), len(inside), left, failed, kept, removed,
        ))
    return out


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FIELDS = [*linerules.NUMBERS, "left_words", "base_failed", "kept", "removed"]
LIMITS = Limits(base_words=4, min_docs=2, share=5, min_words=2, min_left=30)


def body(i):
    return " ".join(f"w{i}x{j}" for j in range(9))


ROWS = [
    *[(i, f"Page {i} of 12\n{body(i)}\n\n \nALL  rights\treserved  \n# tail {i}x", "a") for i in range(6)],
    (10, None, "a"),
    (11, "", None),
    (12, "all rights reserved\npage 9 of 9", "a"),  # nothing is left of it
    (13, "all rights reserved\npage 9 of 9", "b"),  # another host
    (14, body(14) + "\n" + body(14), "b"),  # repeated windows and lines
    (15, "  été   \x0b\x0c 1 2 3 | <> *\r\nzwei drei", None),
    (None, "no id here, but words", "b"),
    (16, "same text twice over", "c"),
    (16, "same text twice over", "c"),
    (17, "\n".join("one line again and again" for _ in range(40)), "c"),
    (18, "x " * 60_000 + "y", "c"),
]


@pytest.fixture(scope="module")
def docs(make):
    return make(ROWS, "doc_id long, text string, host string").selectExpr("*", "'q' AS row", "2 AS line", "1 AS removed")


def test_verdicts(docs):
    got = linerules.line_verdicts(docs, LIMITS, host_col="host").collect()
    want = sorted(((r[0], *w) for r, w in zip(ROWS, plain(ROWS, LIMITS))), key=repr)
    assert sorted(((r.doc_id, *(r[f] for f in FIELDS)) for r in got), key=repr) == want
    assert any(w[-1] for w in want) and any(not w[-2] and not w[-3] for w in want)


def test_clean_texts_keep_all_columns(docs):
    out = linerules.line_verdicts(docs, LIMITS, host_col="host", keep_columns=True)
    assert out.columns == docs.columns
    want = []
    for (i, text, _), w in zip(ROWS, plain(ROWS, LIMITS)):
        if w[-2]:
            want.append((i, "\n".join(x for n, x in enumerate(text.split("\n")) if n not in w[-1])))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert {r.row for r in out.collect()} == {"q"}


def test_empty_table(docs):
    assert linerules.line_verdicts(docs.limit(0), LIMITS, host_col="host").count() == 0


def test_copies_are_one_document(make):
    rows = [(i, "first line of a copy\nsecond one", "a") for i in range(30)]
    out = linerules.line_verdicts(make(rows, "doc_id long, text string, host string"), LIMITS, host_col="host")
    assert out.where("kept").count() == 30


@pytest.mark.parametrize("window", [1, 2, 3, 5, 8, 11])
def test_windows_of_any_size(window):
    rng = np.random.default_rng(window)
    texts = [rng.integers(0, 3, n) for n in (0, 1, window, 40, 200)]
    at = np.cumsum([0, *map(len, texts)])
    got = linerules.repeated_words(np.concatenate(texts), at, window)
    for t, n in zip(texts, got):
        seen = Counter(tuple(t[i : i + window]) for i in range(len(t) - window + 1))
        want = {i + j for i in range(len(t) - window + 1) if seen[tuple(t[i : i + window])] > 1 for j in range(window)}
        assert n == len(want)
