import random
import zlib
from hashlib import sha256

import pytest

from tessera.llm import merkle
from tests.llm import awkward

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    values = [row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + more, row["text"]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def way(tree, i):
    for nodes in tree[:-1]:
        j = i ^ 1
        yield (j < i, nodes[j]) if j < len(nodes) else None
        i //= 2


def slow(rows):
    runs = {}
    for row in rows:
        runs.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), leaf(row, 1), row["doc_id"]))
    names = sorted(runs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([r[2] for r in sorted(runs[x])]) for x in names}
    top = levels([trees[x][-1][0] for x in names])
    out = []
    for x in names:
        for i, (_, _, node, tampered, doc_id) in enumerate(sorted(runs[x])):
            path = [*way(trees[x], i), *way(top, names.index(x))]
            changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            end = tampered if changed else node
            for step in path:
                end = h(end) if step is None else h(step[1], end) if step[0] else h(end, step[1])
            out.append((doc_id, node, trees[x][-1][0], top[-1][0], h(*[s[1] for s in path if s]), end, end == top[-1][0]))
    return sorted(out, key=repr)


def run(docs, height):
    rows, log, top = merkle.manifest(docs, FIELDS, height=height)
    got = merkle.verify(rows).selectExpr("doc_id", "leaf", "subroot", "root", "sha2(array_join(path, ''), 256)", "folded_root", "verified")
    return sorted((tuple(r) for r in got.collect()), key=repr), log


@pytest.mark.parametrize("height", [2, 7])
def test_awkward_rows_by_brute_force(spark, height):
    docs = awkward.frame(spark)
    got, _ = run(docs, height)
    assert got == slow([r.asDict() for r in docs.collect()])
    assert run(awkward.empty(spark), height)[0] == []


def test_tiers_by_brute_force(spark):
    """Runs of 1 to 150 rows under builders of 4 leaves: up to four tiers;
    more runs than one builder of the top tree holds."""
    rng = random.Random(2)
    rows, ids = [], list(range(1000))
    rng.shuffle(ids)
    for k, n in enumerate([1, 2, 3, 4, 5, 16, 17, 64, 65, 150]):
        rows += [(ids.pop(), f"t{i}", None if k == 0 else f"l{k}", "s", i if i % 3 else None) for i in range(n)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got, log = run(docs, 2)
    assert got == slow([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])
    assert log.agg({"tier": "max"}).first()[0] == 3


def postorder(tree, k, j, out):
    if k:
        for i in (2 * j, 2 * j + 1):
            if i < len(tree[k - 1]):
                postorder(tree, k - 1, i, out)
    out.append((k, j))
    return out


def test_places_are_the_postorder():
    for n in range(1, 70):
        tree = levels([h(str(i)) for i in range(n)])
        order = postorder(tree, len(tree) - 1, 0, [])
        assert [merkle.place(k, j, n) for k, j in order] == list(range(len(order)))
        log = merkle.completed(tree[0], merkle.depth(n))
        assert log == [tree[k][j] for k, j in order]
        packed = "".join(log).encode()
        for i in range(n):
            assert merkle.siblings(packed, i, n, merkle.depth(n)) == [s for s in way(tree, i) if s]


def test_segments_of_tier_0_are_one_log(spark):
    """Aligned builders write what one writer of all leaves would, but for
    the nodes above them."""
    leaves = [h(str(i)) for i in range(43)]
    rows = [(0, i, 43, x) for i, x in enumerate(leaves)]
    log = merkle.build(spark.createDataFrame(rows, "run long, at long, n long, node string"), 3)
    whole = merkle.completed(leaves, merkle.depth(43))
    got = {r["place"]: r["digest"] for r in merkle.log_rows(log).collect()}
    assert all(whole[p] == d for p, d in got.items())
    assert len(got) == sum(merkle.size(min(8, 43 - x), 3) for x in range(0, 43, 8))
    assert merkle.roots(log, 3).first()["root"] == whole[-1]
