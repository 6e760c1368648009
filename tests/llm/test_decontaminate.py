import re

import pytest

from footfall.llm import decontaminate

ITEM = "item_id long, text string"


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def brute(docs, items, width=10):
    windows = set()
    for i, text in items:
        w = words(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.add((str(i) if i is not None else "null", tuple(w[k : k + width])))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, p in windows:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    found.add(item)
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


LONG = " ".join(f"q{i}" for i in range(15))
ITEMS = [(1, LONG), (10, "Short Item"), (2, None), (3, "..."), (4, "q3 q4"), (10, "short item"), (None, "été 7"), (5, LONG.upper())]
DOCS = [
    (1, f"Before, {LONG.replace(' ', ', ')}! After"), (2, "a short-item; not shortitem"), (3, None), (4, ""), (5, "--"),
    (6, LONG[:-4]), (7, "q3 q4 q3 q4 q5"), (8, "x Été 7 été 77 ÉTÉ"), (2, "twice short item short item"), (None, LONG * 3),
    (9, ("filler " * 3000 + LONG + " ") * 3), (11, " ".join(f"q{i}" for i in range(1, 10))),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_as_by_trying_all(make, ready, block_bytes):
    found = decontaminate.find_contamination(make(DOCS), ready.createDataFrame(ITEMS, ITEM), block_bytes=block_bytes)
    rows = found.collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows), key=repr) == brute(DOCS, ITEMS)
    for r in rows:  # spans cover the hit words of the original
        text = next(t for i, t in DOCS if i == r["doc_id"] and len(words(t)) == r["n_words"])
        assert sum(len(words(text[s["start"] : s["end"]])) for s in r["spans"]) == r["n_hit"]


def test_clean_documents_stay(make, ready):
    docs = make(DOCS)
    kept = decontaminate.find_contamination(docs, ready.createDataFrame(ITEMS, ITEM), keep_columns=True)
    assert kept.columns == docs.columns
    clean = [(i, n) for i, n, hit, _ in brute(DOCS, ITEMS) if not hit]
    assert sorted((r["doc_id"], len(words(r["text"]))) for r in kept.collect()) == sorted(clean)


def test_empty_tables(make, ready):
    none = ready.createDataFrame([], ITEM)
    assert decontaminate.find_contamination(make([]), ready.createDataFrame(ITEMS, ITEM)).count() == 0
    assert [r["n_hit"] for r in decontaminate.find_contamination(make(DOCS), none).collect()] == [0] * len(DOCS)
