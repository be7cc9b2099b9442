import random
import re
from collections import defaultdict

import pytest
import xxhash

from caseloom.llm import simhash
from caseloom.llm.common import connected
from caseloom.llm.queries import QUERIES

from .samples import documents, empty


def by_hand(text, width=3):
    s = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", s)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, bits):
    """Smallest member of each member's component, over all pairs."""
    parent = {f: f for f in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= bits:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def component_ids(rows, bits=3):
    roots, least = groups({f for _, f in rows}, bits), defaultdict(list)
    for i, f in rows:
        if i is not None:
            least[roots[f]].append(i)
    return sorted((str(i), f, min(least[roots[f]], default=None)) for i, f in rows)


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], by_hand(r["text"])) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op5_simhash"](spark, folder).collect()
    assert sorted((str(r["doc_id"]), int(r["fingerprint"], 16), r["component_id"]) for r in got) == component_ids(docs)


def test_awkward_rows(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], by_hand(r["text"])) for r in docs.collect()]
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fp", "component_id"]
    assert sorted((str(r["doc_id"]), r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got.collect()) == component_ids(rows)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_pieces_of_a_long_text_make_the_same_fingerprint(monkeypatch):
    text = " ".join(random.Random(3).choices(["alpha", "Beta", "γ", "d"], k=5000)).encode()
    whole = simhash.fingerprint(text)
    chunks = simhash.word_chunks
    monkeypatch.setattr(simhash, "word_chunks", lambda data: chunks(data, 97))
    assert simhash.fingerprint(text) == whole == (by_hand(text.decode()) ^ (1 << 63)) - (1 << 63)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_no_link_is_lost(spark, bits):
    """Chains and clouds of fingerprints around a few centres, at every distance near the radius."""
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(20)}
    for f in list(fps)[:8]:
        for _ in range(12):
            for b in rng.sample(range(64), rng.randint(0, bits + 1)):
                f ^= 1 << b
            fps.add(f)
    signed = [(f ^ (1 << 63)) - (1 << 63) for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits)
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= bits for a, b in edges.collect())
    found = {r["node"] & (1 << 64) - 1: r["root"] for r in connected(edges).collect()}
    want = groups(fps, bits)
    sets = defaultdict(set)
    for f in fps:
        sets[found.get(f, (f ^ (1 << 63)) - (1 << 63))].add(f)
    expected = defaultdict(set)
    for f in fps:
        expected[want[f]].add(f)
    assert sorted(map(sorted, sets.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    hub = [(5, i) for i in range(1000, 1300)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame([*path, *hub, (7, 7)], "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {5: 5} | {i: 5 for i in range(1000, 1300)}
