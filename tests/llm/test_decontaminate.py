import random

import pytest

from conftest import SF_SMALL
from warnindex.llm import decontaminate as D
from warnindex.llm.queries import op8_benchmark_decontamination


def brute(item, text):
    """Smallest word edit distance of ``item`` to any run of ``text``."""
    prev = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        cur = [i]
        for j, b in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (a != b)))
        prev = cur
    return min(prev)


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def test_alignment_is_exact():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(0, 6) for _ in range(rng.randrange(0, 20))]
        d, s, e = D.best_alignment(item, text)
        assert d == brute(item, text) and distance(item, text[s:e]) == d


def mutate(rng, words, k):
    w = list(words)
    for _ in range(k):
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            del w[at]
        else:
            w[at:at + (kind == 1)] = ["new" + str(rng.randrange(1000))]
    return w


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2])
def test_recall_and_precision_against_brute_force(share):
    rng = random.Random(int(share * 100))
    common = [f"c{i}" for i in range(30)]
    vocab = common * 20 + [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(6, 70)))) for i in range(60)]
    texts, planted = [], set()
    for d in range(240):
        body = [rng.choice(vocab) for _ in range(rng.randrange(0, 150))]
        if d % 2:
            i, t = rng.choice(items)
            w = t.split()
            at = rng.randrange(len(body) + 1)
            body[at:at] = mutate(rng, w, int(share * len(w)))
        texts.append(" ".join(x.upper() if d % 5 == 0 else x for x in body))
    ix = D.LeakIndex(items)
    found = {(d, h[0]): h for d, hs in enumerate(ix.search(texts, chunk_words=500)) for h in hs}
    want = {}
    for d, t in enumerate(texts):
        w = D.words_of(t)
        for i, x in items:
            b = D.words_of(x)
            dist = brute(b, w)
            if dist <= int(0.2 * len(b) + 1e-9):
                want[d, i] = dist
    assert set(found) <= set(want)
    assert all(found[k][3] == want[k] for k in found)
    assert len(found) >= (1.0 if share == 0 else 0.95) * len(want) and len(want) >= 100


@pytest.mark.parametrize("n", [31, 64, 127])
@pytest.mark.parametrize("place", [0.0, 0.5, 1.0])
def test_recall_of_edits_in_one_half(n, place):
    rng = random.Random(n)
    vocab = [f"v{i}" for i in range(2000)]
    items = [[rng.choice(vocab) for _ in range(n)] for _ in range(30)]
    ix = D.LeakIndex([(i, " ".join(w)) for i, w in enumerate(items)])
    assert all(c.recall >= 0.98 for c in ix.classes.values())
    texts, low = [], int(place * (n - n // 2))
    for d in range(300):
        w = list(items[d % 30])
        for at in sorted(rng.sample(range(low, low + n // 2), n // 5), reverse=True):
            w[at:at + 1] = rng.choice([[], ["new"], ["new", w[at]]])
        texts.append(" ".join([rng.choice(vocab) for _ in range(rng.randrange(60))] + w))
    assert sum(any(h[0] == d % 30 for h in hs) for d, hs in enumerate(ix.search(texts))) >= 0.95 * 300


def whole_search(items, texts):
    want = {}
    for d, t in enumerate(texts):
        w = D.words_of(t)
        for i, x in items:
            b = D.words_of(x)
            dist = brute(b, w)
            if b and dist <= int(0.2 * len(b) + 1e-9):
                want[d, i] = dist
    return want


def test_short_items_are_found_exactly():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(1 + i % 4))) for i in range(24)] + [(90, ""), (91, None), (92, "absent"), (93, "...")]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 25))) for _ in range(80)] + [None, "", "W1, w2!"]
    found = {(d, h[0]): h[3] for d, hs in enumerate(D.LeakIndex(items).search(texts, chunk_words=100)) for h in hs}
    assert found == whole_search(items, texts) and found


def test_a_class_below_the_target_is_searched_exactly():
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(5, 40)))) for i in range(30)]
    texts = []
    for d in range(120):
        w = rng.choice(items)[1].split()
        body = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        at = rng.randrange(len(body) + 1)
        body[at:at] = mutate(rng, w, rng.randrange(len(w) // 5 + 2))
        texts.append(" ".join(body))
    ix = D.LeakIndex(items, D.LeakParams(max_tables=1, trials=50, target_recall=1.01))
    assert not ix.classes
    found = {(d, h[0]): h[3] for d, hs in enumerate(ix.search(texts, chunk_words=300)) for h in hs}
    assert found == whole_search(items, texts) and len(found) > 60


def test_edges(spark):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "", 0), (4, "too short", 0), (None, item, 0)], "item_id long, text string, leaks int")
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "intro " * 30_000 + item, 1), (None, item.upper() + "!!", 1),
                                  (5, "one two three four five", 1), (3, "clean", 1), (3, "clean", 1)], "doc_id long, text string, leaks int")
    got = sorted((r.doc_id or 0, r.item_id or 0, r.start_word, r.n_words, r.distance) for r in D.find_leaks(docs, bench).collect())
    assert got == [(0, 0, 0, 10, 0), (0, 1, 0, 10, 0), (3, 0, 30_000, 10, 0), (3, 1, 30_000, 10, 0)]
    kept = D.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 3, 5]
    assert D.find_leaks(docs, bench.limit(0)).collect() == [] and D.find_leaks(docs.limit(0), bench).collect() == []
    small = D.LeakParams(block_chars=40)  # several blocks of the query set
    assert sorted((r.doc_id or 0, r.item_id or 0, r.start_word, r.n_words, r.distance) for r in D.find_leaks(docs, bench, small).collect()) == got


def test_query_against_brute_force(spark):
    got = {(r.doc_id, r.item_id) for r in op8_benchmark_decontamination(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    want = set()
    for r in docs:
        w = D.words_of(r.text)
        for i in items:
            b = D.words_of(i.text)
            if len(b) >= 5 and len(set(b) & set(w)) >= 0.7 * len(set(b)) and D.best_alignment(
                    *[[hash(x) for x in y] for y in (b, w)])[0] <= int(0.2 * len(b) + 1e-9):
                want.add((r.doc_id, i.item_id))
    assert got <= want and len(got) >= 0.95 * len(want) and want
