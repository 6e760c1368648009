import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from footfall.llm import langid

DE = "der die das und nicht ist ein eine auf mit sich von dem zu für schön größe straße"
EN = "the of and to in is that it was for on are with as his they at be this have from"
FR = "le la les des est une que pour dans qui avec être été où garçon voilà très déjà"
ROWS = [(i, " ".join(x.split()[(i + k) % 15] for k in range(12)), lang) for lang, x in (("de", DE), ("en", EN), ("fr", FR)) for i in range(20)]


def profile(texts, size):
    c = Counter()
    for t in texts:
        for w in re.findall(r"[^\W\d_]+", (t or "").lower()):
            c.update(w)
            for n in (2, 3):
                c.update(f" {w} "[k : k + n] for k in range(len(w) + 3 - n))
    code = lambda g: sum(ord(x) << (21 * k) for k, x in enumerate(g))
    ranked = sorted(c, key=lambda g: (-c[g], code(g)))[:size]
    return {g: r for r, g in enumerate(ranked)}


def brute(rows, texts, size):
    models = {l: profile([t for _, t, x in rows if x == l], size) for l in sorted({x for *_, x in rows if x})}
    out = []
    for t in texts:
        own = profile([t], size)
        if not own or not models:
            out.append(("und", 0.0))
            continue
        far = {l: sum(abs(r - m[g]) if g in m else size for g, r in own.items()) for l, m in models.items()}
        best = min(far, key=lambda l: (far[l], l))
        out.append((best, 1 - far[best] / (size * len(own))))
    return out


@pytest.mark.parametrize("size", [40, 400])
def test_as_counted_by_hand(ready, make, size):
    train = ready.createDataFrame([*ROWS, (1, "ignored", None), (2, None, "de"), (3, "", "en")], "doc_id long, text string, lang string")
    probes = [
        "The and of!", "größe und STRASSE", "où est le garçon", None, "", "123 ---", "und the", "ç", "x" * 5000 + " the",
        EN * 500, "the", "the",
    ]
    docs = make(list(enumerate(probes)))
    got = langid.identify(docs, langid.learn_profiles(train, size=size), size=size).orderBy("doc_id").collect()
    for r, (lang, score) in zip(got, brute(ROWS, probes, size)):
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-9, (r, lang, score)


def test_nothing_learned_or_asked(ready, make):
    none = langid.learn_profiles(ready.createDataFrame([], "doc_id long, text string, lang string"))
    assert [tuple(r)[1:] for r in langid.identify(make([(1, "abc"), (None, "x")]), none).collect()] == [("und", 0.0)] * 2
    assert langid.identify(make([]), none).count() == 0


def test_held_out_texts(ready, small):
    docs = ready.read.parquet(f"{small}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    out = langid.train_and_identify(docs, ~held).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    out = out[[zlib.crc32(str(i).encode()) % 3 == 1 for i in out["doc_id"]]]
    assert (out["lang"] == out["lang_pred"]).mean() > 0.97
