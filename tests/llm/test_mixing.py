import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import duckdb
import pytest

from conftest import SF_MID, SF_SMALL
from warnindex.llm import mixing as M
from warnindex.llm.queries import ORACLES, op5_mixing_budgets

P = M.MixParams(levels=("a", "b"), weights={"a": {"x": 3, "y": 1, "z": 0}, "b": {"p": 2}}, budget_share=0.7, max_epochs=2, seed="s")


def water(budget, kids):
    """Exact water level over [(cap, w)]."""
    share, open_ = {}, {k for k, (c, w) in kids.items() if w > 0}
    rest = Fraction(budget)
    while open_:
        total = sum(kids[k][1] for k in open_)
        full = [k for k in open_ if kids[k][0] * total <= rest * kids[k][1]]
        if not full:
            break
        for k in full:
            share[k] = Fraction(kids[k][0])
        rest -= sum(kids[k][0] for k in full)
        open_ -= set(full)
    for k in open_:
        share[k] = rest * kids[k][1] / sum(kids[j][1] for j in open_)
    return share


def make(rng, n=300):
    rows = []
    for i in range(n):
        a = rng.choice(["x", "x", "x", "y", "z", None])
        b = rng.choice(["p", "q", "", None])
        rows.append((rng.choice([i, i, i // 2, None]), a, b, rng.choice([None, "", " \t", " ".join(["w"] * rng.randrange(1, 40))])))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = make(random.Random(seed))
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, a string, b string, text string, copies int")
    supply, docs_of = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for i, a, b, t in rows:
        n = len((t or "").split())
        supply[a, b] += n
        docs_of[a, b][i] += n
    supply = {k: v for k, v in supply.items() if v}
    total = sum(supply.values())
    cap = {k: 2 * v * (k[0] != "z") for k, v in supply.items()}
    wa, wb = {"x": 3, "y": 1, "z": 0}, {"p": 2}
    top = water(min(int(total * 0.7), sum(cap.values())), {a: (sum(c for k, c in cap.items() if k[0] == a), wa.get(a, 1)) for a in {k[0] for k in cap}})
    got_b = {(r._k0[1:] if r._k0 != "n" else None, r._k1[1:] if r._k1 != "n" else None): r for r in M.plan(docs, P)[1].collect()}
    assert sum(r.budget for r in got_b.values()) == min(int(total * 0.7), sum(cap.values()))
    want = {}
    for a in top:
        low = water(top[a], {b: (cap[a, b], wb.get(b, 1)) for x, b in cap if x == a})
        for b, share in low.items():
            assert abs(got_b[a, b].budget - share) < 3
            assert got_b[a, b].budget <= cap[a, b]
    for leaf, r in got_b.items():
        e, rest = divmod(r.budget, r.supply)
        run, stop = 0, False
        for i in sorted((i for i in docs_of[leaf] if docs_of[leaf][i]), key=lambda i: hashlib.md5(f"s|{e}|{'null' if i is None else i}".encode()).hexdigest()):
            run += docs_of[leaf][i]
            stop |= run > rest
            want[leaf, i] = e + (not stop)
    got = M.copies(docs, P).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.copies == (want.get(((r.a, r.b), r.doc_id), 0) if r.n_tokens else 0)
    mixed = M.mix(docs, P)
    assert mixed.columns == [*docs.columns, "_copies"]
    key = lambda r, n: (r.doc_id is None, r.doc_id or 0, r.a or "", r.b or "", n)
    assert sorted(key(r, r._copies) for r in mixed.collect()) == sorted(key(r, r.copies) for r in got if r.copies)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, a string, b string, text string")
    assert M.copies(docs, P).collect() == [] and M.mix(docs, P).collect() == []


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = op5_mixing_budgets(spark, sf)
    cur = con.execute(ORACLES["op5_mixing_budgets"])
    assert [d[0] for d in cur.description] == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(cur.fetchall())


def test_columns_of_the_same_names_stay(spark):
    from warnindex.llm.mixing import mix_by_source
    from warnindex.llm.toxicity import score

    rows = [(i, "a b c", "en", f"site{i % 4}", 9, f"own{i}", "x") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, copies int, domain string, score string")
    out = mix_by_source(docs)
    assert out.columns == [*docs.columns, "_copies"]
    plain = mix_by_source(docs.drop("copies", "domain"))
    assert {r.doc_id: r._copies for r in out.collect()} == {r.doc_id: r.copies for r in plain.collect()} != {}
    assert all((r.copies, r.domain) == (9, f"own{r.doc_id}") for r in out.collect())
    weights = spark.createDataFrame([(-1, 0.5)], "idx long, weight double")
    scored = score(docs, weights)
    assert scored.columns == [*docs.columns, "_score"] and {r.score for r in scored.collect()} == {"x"}
