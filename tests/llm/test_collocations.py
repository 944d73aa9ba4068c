import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from warnindex.llm.collocations import CollocationParams, collocations, equal_partitions, phrase_counts
from warnindex.llm.queries import op13_phrase_collocations


def counts(rows, most):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        c = f.setdefault(lang, Counter())
        t = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, most + 1):
                c.update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    return f, n


def brute(rows, p):
    f, n = counts(rows, p.max_words)
    out = []
    for lang, c in f.items():
        cand = {k: a for k, a in c.items() if len(k) >= 2 and a >= p.min_count}
        drop = {k[i:i + m] for k, a in cand.items() for m in range(2, len(k)) for i in range(len(k) - m + 1)
                if 100 * a >= p.longer_percent * cand[k[i:i + m]]}
        res = []
        for k, a in cand.items():
            if k not in drop:
                s, i = min((1000000 * a * a // (c[k[:i]] * c[k[i:]]), i) for i in range(1, len(k)))
                res.append((-s, -a, " ".join(k).encode(), c[k[:i]], c[k[i:]]))
        out += [(lang, r, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for r, x in enumerate(sorted(res)[:p.top], 1)]
    return sorted(out)


def mined(spark, rows, p):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return sorted(tuple(r) for r in collocations(df, p).collect())


def rows():
    rng = np.random.default_rng(3)
    words = ["the", "The", "of", "é", "naïve", "x1", "a-b", "日本", "\x00", "\x1c", "\xa0z", "_"]
    out = [(None, None), ("en", None), ("de", ""), ("de", " \t.,;:!?\n\x0b\x0c\r"), (None, "a b. a b, A B"), ("und", "a b")]
    for i in range(300):
        lang = ["en", "en", "en", "fr", None][i % 5]
        text = "".join(str(rng.choice(words)) + str(rng.choice([" ", " ", " ", "\t ", ". ", "\n", "?!"])) for _ in range(rng.integers(0, 60)))
        out.append((lang, text))
    out += [("en", "of the hot pair " * 400), ("en", "one " * 3000), ("es", "repeat this row")] + [("es", "repeat this row")] * 12
    return out


def test_equals_brute_force_with_groups_split_and_whole(spark):
    r = rows()
    for p in (CollocationParams(), CollocationParams(group_entries=40, least_group=5, routes=3, chunk_words=200, part_bytes=64),
              CollocationParams(max_words=5, min_count=2, group_entries=20, least_group=2, top=50, longer_percent=90), CollocationParams(max_words=2, min_count=1)):
        assert mined(spark, r, p) == brute(r, p)


def test_all_counts_from_one_to_three_words(spark):
    r = rows()
    p = CollocationParams(min_count=4, group_entries=50, least_group=9, routes=2)
    f, n = counts(r, 3)
    phrases, sizes = phrase_counts(spark.createDataFrame(r, "lang string, text string"), p)
    assert {(x["lang"], x["phrase"]): x["f"] for x in phrases.collect()} == {(k, " ".join(w)): a for k, c in f.items() for w, a in c.items() if a >= 4}
    assert phrases.count() == phrases.select("lang", "phrase").distinct().count()
    assert {x["lang"]: x["n"] for x in sizes.collect()} == {k: v for k, v in n.items() if v}


def test_products_beyond_64_bits(spark):
    # the largest counts the types allow, without so much text: the score expression alone
    a = 10**13
    s = spark.sql(f"select CAST(1000000 AS DECIMAL(7,0)) * CAST({a}L AS DECIMAL(14,0)) * CAST({a}L AS DECIMAL(14,0)) div (CAST({a + 7}L AS DECIMAL(14,0)) * CAST({a + 1}L AS DECIMAL(14,0))) as s")
    assert s.first()["s"] == 1000000 * a * a // ((a + 7) * (a + 1))


def test_empty_table_and_clashing_columns(spark):
    assert mined(spark, [], CollocationParams()) == []
    df = spark.createDataFrame([("en", "a b", "x", 1, 2)] * 10, "lang string, text string, phrase string, n int, score int")
    assert [tuple(r) for r in collocations(df).collect()] == [("en", 1, "a b", 10, 10, 10, 20, 1000000)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 2), st.integers(1, 5)), max_size=200), st.integers(1, 12), st.integers(1, 40))
def test_equal_partitions_are_counts(items, least, leaf):
    a = np.array(items, dtype=np.int64).reshape(-1, 4)
    keys, w = list(a[:, :3].T), a[:, 3]
    got = {}
    order = {0: [], 1: [], 2: []}
    for d, ptr, size in equal_partitions(keys, w, least, leaf):
        for q, s in zip(ptr.tolist(), size.tolist()):
            k = tuple(a[q, :d + 1].tolist())
            assert k not in got
            got[k] = s
            order[d].append(k)
    want = Counter()
    for x, y, z, n in items:
        for k in ((x,), (x, y), (x, y, z)):
            want[k] += n
    assert got == {k: n for k, n in want.items() if n >= least}
    assert all(v == sorted(v) for v in order.values())


def test_query_on_a_given_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "text").collect()
    assert sorted(tuple(r) for r in op13_phrase_collocations(spark, SF_SMALL).collect()) == brute([tuple(r) for r in docs], CollocationParams())
