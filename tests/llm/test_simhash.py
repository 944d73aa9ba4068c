import random

import numpy as np
import pytest
import xxhash

from warnindex.llm import simhash_dedup as S


def brute_fp(text, k=4):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))) if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, most=4):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= most:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return {(rows[i][0], rows[i][1]): min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(rows))}


@pytest.mark.parametrize("text", [None, "", "  \t", "One", "a b c", "A B c d", "É a b c d e É", "x " * 500])
def test_fingerprint_matches_definition(text):
    assert S.simhash(text) == brute_fp(text)


def test_patterns_cover_every_viable_difference():
    rng = random.Random(1)
    for seg, most, zeros in ((8, 4, 3), (8, 4, 2), (16, 4, 4), (8, 3, 3)):
        pats, w = S.zero_patterns(seg, most, zeros), 64 // seg
        for _ in range(2000):
            x = 0
            for _ in range(most):
                x |= 1 << rng.randrange(64)
            box = [x >> (i * w) & ((1 << w) - 1) for i in range(seg)]
            ok = False
            for s in range(seg):
                if any(all(box[(s + o) % seg] == 0 for o in p) for p in pats) and len(
                        S._linked(np.array([x], dtype=np.uint64), s, seg, most)):
                    ok = True
            assert ok


def near_rows(rng, n):
    rows, words = [], [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    for i in range(n):
        t = list(base) if i % 3 else [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 6)):
            if t:
                t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i + 5, " ".join(t)))
    return rows + [(1000, None), (1001, ""), (None, "lonely text nobody else has written down"), (None, rows[1][1]), rows[1]]


@pytest.mark.parametrize("max_run", [20_000, 6])
def test_components_match_brute_force(spark, max_run):
    rows = near_rows(random.Random(7), 150)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = S.simhash_components(docs, max_run=max_run).collect()
    want = brute_components([(i, brute_fp(t)) for i, t in rows])
    assert len(got) == len(rows)
    assert {(r.doc_id, r.fp & (2**64 - 1)): r.component_id for r in got} == want


def test_keep_one(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (None, "zz yy xx ww vv"), (None, "zz yy xx ww vv"),
            (3, None), (4, ""), (None, "a b c d e f")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, component_id string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in S.keep_one(docs).collect())
    assert got == [(False, 1, "a b c d e f"), (False, 3, ""), (True, 0, "zz yy xx ww vv")]


@pytest.mark.parametrize("bound", [500_000, 0])
def test_keep_one_matches_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(S, "IDS_TO_BROADCAST", bound)
    rows = near_rows(random.Random(11), 120)
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, fp int")
    want = brute_components([(i, brute_fp(t)) for i, t in rows])
    kept = S.keep_one(docs)
    got = kept.collect()
    assert kept.columns == docs.columns
    heads = {c for c in want.values() if c is not None}
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(heads)
    assert sum(r.doc_id is None for r in got) == len({f for (i, f), c in want.items() if c is None})


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_components(none).collect() == [] and S.keep_one(none).collect() == []


def test_query_on_a_given_table(spark):
    from conftest import SF_SMALL
    from warnindex.llm.queries import op9_simhash_near_dedup

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, brute_fp(r.text)) for r in docs]
    want = brute_components(rows)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op9_simhash_near_dedup(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    assert {i: g[0] for i, g in got.items()} == {i: f"{fp:016x}" for i, fp in rows}
    assert {i: g[1] for i, g in got.items()} == {i: want[i, fp] for i, fp in rows}
