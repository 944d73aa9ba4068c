import random
import re

import pytest

from conftest import SF_SMALL
from warnindex.llm import licenses as L
from warnindex.llm.queries import op12_license_scan


def fold(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, templates, percent):
    """All blocks, word by word, without any index."""
    w, out = fold(text), []
    for t in templates:
        tw = fold(t.text)
        if t.phrase:
            out += [(t.label, True, i, i + len(tw) - 1, 1.0) for i in range(len(w)) if w[i:i + len(tw)] == tw]
            continue
        own, merged = set(tw), []
        for i in range(len(w)):
            block = w[i:i + len(tw)]
            got = own & set(block)
            if w[i] in own and 100 * len(got) >= percent * len(own):
                end = max(k for k, x in enumerate(block) if x in own) + i + 1
                c = len(got) / len(own)
                if merged and i < merged[-1][1]:
                    merged[-1] = (merged[-1][0], end, max(merged[-1][2], c))
                else:
                    merged.append((i, end, c))
        out += [(t.label, False, a, b - 1, c) for a, b, c in merged]
    return sorted(out)


def scanned(spark, texts, templates, percent=80):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = L.license_links(df, templates, percent).collect()
    return {r["doc_id"]: (r["n_words"], sorted(tuple(x) for x in r["links"])) for r in rows}


def texts(rng, templates):
    out = [None, "", " \n.,;", "license", "MIT License", "x MIT\nLICENSE. mit license y", "mit-license gnu  general\tpublic_license", "ſ MIT Licenſe", "CC BY-NC 4.0 cc by cc by",
           "apacheé license", "license " * 5000, ("mit license " * 3000).strip()]
    words = sorted({w for t in templates for w in fold(t.text)}) + ["foo", "été", "日本", "bar"] * 10
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            t = fold(rng.choice(templates).text)
            k = rng.randrange(4)
            if k == 0:
                parts += t
            elif k == 1:
                parts += [rng.choice(words) if rng.random() < 0.15 else x for x in t if rng.random() > 0.1]
            elif k == 2:
                parts += rng.sample(t, len(t))
            parts += [rng.choice(words) for _ in range(rng.randrange(0, 30))]
        out.append(" ".join(x.upper() if rng.random() < 0.2 else x for x in parts))
    return out


@pytest.mark.parametrize("percent", [80, 55, 100, 1])
def test_equals_brute_force(spark, percent):
    templates = L.PHRASES + L.NOTICES + (L.Template("twice", "a b a b", True), L.Template("dup", "of the of the of a b c"))
    t = texts(random.Random(percent), templates)
    got = scanned(spark, t, templates, percent)
    for i, text in enumerate(t):
        assert got[i] == (len(fold(text)), brute(text, templates, percent)), text


def test_order_is_by_documents_and_prefix_words_are_the_rarest(spark):
    t = L.Template("x", "common rare middle other")
    df = spark.createDataFrame([("common common middle",), ("common middle",), ("common rare",), (None,)], "text string")
    n = L.documents_with(df, [t])
    assert n == {b"common": 3, b"middle": 2, b"rare": 1}
    index = L.build_index([t], n, 75)
    assert sorted(index.rank, key=index.rank.get) == [b"other", b"rare", b"middle", b"common"]
    assert set(index.prefix) == {b"other", b"rare"}
    assert set(L.build_index([L.Template("x", "common rare middle other", True)], n).prefix) == {b"other"}


def test_edges(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.license_links(df).collect() == []
    extra = spark.createDataFrame([(1, "mit license", 2, "x", 3), (1, "mit license", 2, "x", 3), (None, None, 0, "", 0)], "doc_id long, text string, n_words int, links string, label int")
    rows = L.license_links(extra).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], len(r["links"])) for r in rows) == [(0, 0, 0), (1, 2, 1), (1, 2, 1)]
    with pytest.raises(ValueError, match="no words"):
        L.license_links(extra, [L.Template("x", " - ")])


def test_query_on_a_given_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op12_license_scan(spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    assert sum(r["n_base"] > 0 for r in rows) > 0
    for r in rows:
        links = brute(docs[r["doc_id"]], L.PHRASES + L.NOTICES, 80)
        base = [x for x in links if x[1]]
        assert (r["n_words"], r["n_base"]) == (len(fold(docs[r["doc_id"]])), len(base))
        assert (r["first_word"], r["last_word"]) == (min((x[2] for x in base), default=None), max((x[2] for x in base), default=None))
        assert (r["base_labels"], r["labels"]) == (",".join(sorted({x[0] for x in base})), ",".join(sorted({x[0] for x in links})))
        assert r["score"] == max((x[4] for x in links), default=0.0)
