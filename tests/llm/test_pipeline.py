import random

import corpus_pipeline as C
from conftest import SF_MID, SF_SMALL
from test_decontaminate import brute as edit_brute
from test_secrets import base, entropy
from test_simhash import brute_fp
from warnindex.llm import decontaminate as D
from warnindex.llm import mixing as M


def groups(rows):
    """doc_ids kept by brute force over all pairs of fingerprints."""
    fps = [(r.doc_id, brute_fp(r.text)) for r in rows]
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        least[find(i)] = min(d, least.get(find(i), d))
    return set(least.values())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols, frames, df = docs.columns, {}, docs
    for name, stage in C.STAGES:
        df = C.written(stage(spark, df, SF_SMALL), "t")
        frames[name] = df
        assert df.columns == (cols if name != "mixing" else [*cols, "copies"])
    tox, sim, dec, sec, mix = (f.collect() for f in frames.values())
    assert 0 < len(tox) <= docs.count()
    assert {r.doc_id for r in sim} == groups(tox) and len(sim) == len({r.doc_id for r in sim})
    items = [D.words_of(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]

    def leaks(text):
        w = D.words_of(text)
        return any(len(set(b) & set(w)) >= 0.6 * len(set(b)) and edit_brute(b, w) <= int(0.2 * len(b) + 1e-9) for b in items)

    assert {r.doc_id for r in dec} == {r.doc_id for r in sim if not leaks(r.text)}
    before = {r.doc_id: r for r in dec}
    assert {r.doc_id for r in sec} == set(before)
    for r in sec:
        spans = [*base(before[r.doc_id].text), *entropy(before[r.doc_id].text)]
        assert (r.text != before[r.doc_id].text) == bool(spans)
        assert "[SECRET]" in r.text if spans else r.n_chars == before[r.doc_id].n_chars
        assert r.n_chars == len(r.text) or not spans
    want = {r.doc_id: r.copies for r in M.copies(M.with_domain(frames["secret_scan"])).collect() if r.copies}
    assert {r.doc_id: r.copies for r in mix} == want
    assert sorted(r.doc_id for r in C.run(spark, SF_SMALL).collect()) == sorted(want)


def test_planted(spark, tmp_path):
    """Copies, a leak and toxic rows planted among the given documents are caught; clean ones stay."""
    rng = random.Random(2)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    bench = spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()
    words = [f"{a}{b}" for a in "pelorinda" for b in ("ba", "ku", "mi", "zo", "tre", "lan")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    clean = {900_001 + i: prose(150 + i) for i in range(30)}
    leak = {910_000 + i: f"{prose(40)} {bench[i].text.upper()} {prose(30)}" for i in range(10)}
    copy = {920_000 + i: clean[900_001 + i] for i in range(10)}
    rows = docs + [(i, t, "en", "src1", len(t)) for i, t in {**clean, **leak, **copy}.items()]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    spark.read.parquet(f"{SF_MID}/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
    df = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        df = C.written(stage(spark, df, d), "p")
    kept = {r.doc_id for r in df.collect()}
    assert set(clean) <= kept
    assert not kept & (set(leak) | set(copy))


def test_empty(spark, tmp_path):
    d = str(tmp_path)
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    assert C.run(spark, d).collect() == []
