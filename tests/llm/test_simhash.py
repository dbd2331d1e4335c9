import random
import re

import numpy as np
import xxhash

from tessera.llm import simhash, stages
from tessera.llm.components import components
from tests.llm import awkward


def slow_fingerprint(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, ids, radius=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(fps))]


def test_awkward_rows_by_brute_force(spark):
    docs = awkward.frame(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    fps = [slow_fingerprint(t) if len(t or "") < 5000 else simhash.fingerprint(t.encode(), 4) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], fps, groups(fps, [i for i, _ in rows])), key=repr)
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == want
    assert simhash.near_duplicates(awkward.empty(spark)).count() == 0


def test_tiles_find_every_link(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(80)]
    fps = set(base) | {0, (1 << 64) - 1, 1 << 63}
    for b in base[:40]:  # chains: each step within the radius, the ends far apart
        x = b
        for _ in range(rng.randint(1, 6)):
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    roots = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in components(simhash.links(df, 4, tile=16)).collect()}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    want = groups(fps, signed)
    assert [int(np.uint64(roots.get(f, f)).view(np.int64)) for f in fps] == want


def test_layout_pairs_are_those_within_the_radius():
    counts = {0: 1, 3: 2, 9: 40, 10: 100, 11: 7, 20: 5, 64: 1}
    place, reach = simhash.layout(counts, 16, 4)
    tiles = {}
    for p, (first, parts) in place.items():
        for t in range(first, first + parts):
            tiles.setdefault(t, []).append(p)
    for t, low, high in reach:
        for u in tiles:
            near = min(abs(a - b) for a in tiles[t] for b in tiles[u]) <= 4
            assert not near or low <= u <= high


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, k) for k in range(1001, 1300)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[k] for k in range(1000, 1300)} == {1000}
    assert 5000 not in got


def test_rows_that_share_an_id_but_not_a_group(spark):
    own, other, third, fourth = (awkward.words(80, seed) for seed in (201, 202, 203, 204))
    rows = [(1, other), (7, own), (7, other), (7, third), (7, third.upper()), (7, third), (9, fourth), (8, own), (None, own), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", len(t or "")) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted([(1, other), (7, own), (7, third.upper()), (9, fourth), (None, own), (None, None)], key=repr)
    for parts in (1, 5):
        got = stages.near_duplicates(spark, docs.repartition(parts), "")
        assert got.columns == stages.COLUMNS
        assert sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=repr) == want
    assert stages.near_duplicates(spark, awkward.empty(spark), "").count() == 0
