"""The pipeline's stages, each on its own input, and a whole run."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from tessera.llm import bpe, stages
from tessera.llm.queries import q_factorisation_machine
from tests.conftest import SF001
from tests.llm import awkward
from tests.llm.test_simhash import groups, slow_fingerprint

WINDOW = 50


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def tuples(frame):
    return [tuple(r) for r in frame.select(stages.COLUMNS).collect()]


def without_passages(rows):
    """What the substring stage leaves of (doc_id, text, lang, source, n_chars) rows."""
    first = {}
    for i, text, *_ in rows:
        w = words_of(text)
        for at in range(len(w) - WINDOW + 1) if i is not None else ():
            key = tuple(w[at:at + WINDOW])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, text, lang, source, n_chars in rows:
        w = words_of(text)
        gone = set()
        for at in range(len(w) - WINDOW + 1) if i is not None else ():
            if first[tuple(w[at:at + WINDOW])] < i:
                gone.update(range(at, at + WINDOW))
        if not gone:
            out.append((i, text, lang, source, n_chars))
        elif len(gone) < len(w):
            kept = " ".join(x for at, x in enumerate(w) if at not in gone)
            out.append((i, kept, lang, source, len(kept)))
    return out


def plain_targets(sizes):
    """Each source's target: shares dealt by weight, the excess anew until none is above twice its source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else level * weight[s]
        if not full:
            break
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def check_mix(before, after):
    have, took = Counter(before), Counter(after)
    assert all(took[row] <= 2 * have[row] for row in took)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for row, n in have.items():
        size = len(words_of(row[1]))
        sizes[row[3]] += n * size
        largest[row[3]] = max(largest[row[3]], size)
    for row, n in took.items():
        taken[row[3]] += n * len(words_of(row[1]))
    for source, target in plain_targets(dict(sizes)).items():
        assert abs(taken[source] - target) <= 2 * largest[source], source


def coded(rows):
    enc = bpe.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = []
    for i, text, _, source, _ in rows:
        ids = enc.encode_ordinary(text or "")
        out.append((i, source, len(ids), ids, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def codes_of(frame):
    assert frame.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]
    return sorted([(r["doc_id"], r["source"], r["n_tokens"], list(r["ids"]), r["decoded_sha256"]) for r in frame.collect()], key=repr)


def test_quality_keeps_whole_rows_of_any_kind(spark):
    rows = Counter(tuples(awkward.frame(spark)))
    out = stages.quality(spark, awkward.frame(spark), SF001)
    assert out.columns == stages.COLUMNS
    assert not Counter(tuples(out)) - rows


def test_substrings_on_awkward_rows(spark):
    docs = awkward.frame(spark)
    want = sorted(without_passages(tuples(docs)), key=repr)
    for parts in (1, 5):
        out = stages.substrings(spark, docs.repartition(parts), SF001)
        assert out.columns == stages.COLUMNS
        assert sorted(tuples(out), key=repr) == want


def test_mix_on_awkward_rows(spark):
    docs = awkward.frame(spark)
    out = stages.mix(spark, docs, SF001)
    assert out.columns == stages.COLUMNS
    once = tuples(out)
    check_mix(tuples(docs), once)
    assert sorted(tuples(stages.mix(spark, docs, SF001)), key=repr) == sorted(once, key=repr)


def test_encode_on_awkward_rows(spark):
    docs = awkward.frame(spark)
    assert codes_of(stages.encode(spark, docs, SF001)) == coded(tuples(docs))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_no_rows(spark, name, stage):
    out = stage(spark, awkward.empty(spark), SF001)
    assert out.count() == 0
    if name != "encode":
        assert out.columns == stages.COLUMNS


def test_a_whole_run_stage_by_stage(spark, monkeypatch):
    inputs = []

    def noted(stage):
        def run(spark, docs, sf_dir):
            inputs.append(docs)
            return stage(spark, docs, sf_dir)
        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, noted(stage)) for name, stage in corpus_pipeline.STAGES])
    result = corpus_pipeline.run(spark, SF001)
    raw, good, single, cut, mixed = [tuples(docs) for docs in inputs]

    accepted = {r["doc_id"] for r in q_factorisation_machine(spark, SF001).where("predicted = 1").collect()}
    assert Counter(good) == Counter(row for row in raw if row[0] in accepted)
    fps = [slow_fingerprint(row[1]) for row in good]
    ids = [row[0] for row in good]
    assert Counter(single) == Counter(row for row, root in zip(good, groups(fps, ids)) if row[0] == root)
    assert Counter(cut) == Counter(without_passages(single))
    check_mix(cut, mixed)
    assert codes_of(result) == coded(mixed)
