import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import prefixjoin
from tests.llm import awkward


def slow_set(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def slow(rows, percent=90):
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (x, _) in enumerate(rows):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return sorted(((x, len(s), least.get(find(i)) if s else x) for i, ((x, _), s) in enumerate(zip(rows, sets))), key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in prefixjoin.similar(df, **options).collect()), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "x" + str(rng.randrange(10 ** 6))
    return " ".join(words)


def test_awkward_rows_by_brute_force(spark):
    docs = awkward.frame(spark)
    got = sorted((tuple(r) for r in prefixjoin.similar(docs, counters=4096).collect()), key=repr)
    assert got == slow([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert prefixjoin.similar(awkward.empty(spark), counters=4096).count() == 0


@pytest.mark.parametrize("percent,counters", [(90, 4096), (80, 64)])
def test_near_copies_by_brute_force(spark, percent, counters):
    """Chains of edits, a hot group, boilerplate, and a threshold met exactly;
    with 64 counters nearly every shingle looks frequent."""
    rng = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(3, 150))
        for _ in range(rng.randint(1, 6)):
            rows.append(" ".join(base))
            base = edited(rng, base, rng.randint(1, 3)).split()
    hot = rng.choices(vocabulary, k=120)
    rows += [edited(rng, hot, rng.randint(0, 3)) for _ in range(60)]
    passage = rng.choices(vocabulary, k=90)
    rows += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(25)]
    exact = [f"e{i}" for i in range(21)]  # 19 shingles; one word more or less at the end: 18 of 19 or 19 of 20
    rows += [" ".join(exact[:k]) for k in (20, 19, 18)] + [" ".join(exact[:11]), " ".join(exact[:12]), " ".join(exact[:20]).upper()]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert run(spark, rows, percent=percent, counters=counters, block_sets=16, block_shingles=1200) == slow(rows, percent)


def test_whole_sets_are_read_for_enough_matches_only(spark, monkeypatch):
    """A table of one cell tells nothing: a passage of all documents enters
    their prefixes, and ties them, but only near copies match more."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(10)]
    rows = [" ".join(passage + [f"o{i}x{k}" for k in range(90)]) for i in range(60)]
    rows = list(enumerate(rows + [edited(rng, rows[0].split(), 1), edited(rng, rows[1].split(), 1)]))
    tables = {}

    def written(df, name, write=prefixjoin.written):
        tables[name] = write(df, name)
        return tables[name]

    monkeypatch.setattr(prefixjoin, "written", written)
    assert run(spark, rows, counters=1) == slow(rows)
    assert 4 <= tables["sets"].count() < 20


def test_codes_of_counts_keep_their_order():
    counts = np.array([0, 1, 2, 127, 128, 200, 1000, 5000, 10 ** 6, 4 * 10 ** 9])
    code = prefixjoin.coded(counts)
    assert (np.diff(code.astype(int)) >= 0).all() and (code[:4] == counts[:4]).all()
    assert (np.abs(prefixjoin.decoded()[code[:9]] / np.maximum(counts[:9], 1) - 1)[1:] < 0.1).all()


def test_prefixes_of_pairs_share_enough():
    """The smaller m of two similar sets is met by their prefixes, whichever
    m each of them takes."""
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 60)
        base = [f"t{rng.randrange(400)}" for _ in range(n + 2)]
        texts = [" ".join(base), edited(rng, base, rng.randint(0, 2))]
        s = prefixjoin.Shingles(pa.array(texts), 3)
        rank = prefixjoin.cell_of(s.hashes, 16)
        order = np.lexsort((s.hashes, rank, s.doc))
        weight = np.array([rng.random() * 9 for _ in order])
        m, length = prefixjoin.choose(s.n, s.first, weight, 80, 4)
        x, y = (s.hashes[order][s.first[i]:s.first[i + 1]] for i in (0, 1))
        both = len(set(x.tolist()) & set(y.tolist()))
        if 180 * both >= 80 * (len(x) + len(y)):
            assert len(set(x[:length[0]].tolist()) & set(y[:length[1]].tolist())) >= min(m)


def test_costly_prefixes_ask_for_more_matches():
    n, first = np.array([100]), np.array([0, 100])
    cheap = np.full(100, 0.01)
    m, length = prefixjoin.choose(n, first, np.concatenate([np.full(11, 50.0), cheap[11:]]), 90, 4)
    assert m[0] == 4 and length[0] == 14
    m, length = prefixjoin.choose(n, first, np.concatenate([cheap[:11], np.full(89, 50.0)]), 90, 4)
    assert m[0] == 1 and length[0] == 11


def test_overlaps_of_frequent_and_rare_tokens():
    rng = np.random.default_rng(4)
    for n, kinds in ((30, 5), (40, 4000)):
        sets = [np.unique(rng.integers(0, kinds, rng.integers(0, 60))) for _ in range(n)]
        flat = np.concatenate(sets), np.repeat(np.arange(n), [len(x) for x in sets])
        got = prefixjoin.overlaps(flat, flat, (n, n))
        assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets] for x in sets]


def test_frequencies_count_every_row(spark):
    rows = [(f"a b c {'d ' * (i % 3)}",) for i in range(50)]
    table = prefixjoin.frequencies(spark.createDataFrame(rows, "text string").repartition(5), 3, 8192)
    hashes = prefixjoin.Shingles(pa.array(["a b c"]), 3).hashes
    assert table[prefixjoin.cell_of(hashes, 8192)[0]] == 50
    assert table.sum() == sum(len(slow_set(t)) for t, in rows)
