"""Importance resampling, SimHash components and phrase collocations against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from carelake.llm import collocations, hattrie, resample, simhash
from conftest import ROOT

# names that clash with the operators' own columns
SCHEMA = "doc_id long, text string, lang string, rank int, score string, fp int, rest string, h int, n string, a int"


def _texts():
    r = random.Random(11)
    vocabulary = ["w%d" % i for i in range(40)] + ["The", "the", "été", "日本", "x" * 70, "a-b", "10"]
    line = lambda n: " ".join(r.choice(vocabulary) + r.choice(["", "", "", ",", ".", "\n", "\t"]) for _ in range(n))
    base = line(300)
    out = [None, "", " \n\t", "one", "One two", base, base, base + " more", base.replace("w3 ", "w4 ", 1), "New York, new york! " * 60]
    out += ["big red dog ran " * 35, "q" * 5000, line(4000)]
    return out + [line(r.randrange(1, 120)) for _ in range(40)]


LANGS = [None, "en", "en", "fr", "und"]
ROWS = [(3 * i, t, LANGS[i % 5], 1, "s", 2, "r", 3, "n", 4) for i, t in enumerate(_texts())]
ROWS += [ROWS[5], (None, ROWS[5][1], None, 1, "s", 2, "r", 3, "n", 4), (None, None, "en", None, None, None, None, None, None, None)]


def low(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


@pytest.fixture(scope="module")
def docs(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark, docs):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def target(spark, docs):
    return spark.createDataFrame([(1, "the w1 w2 w3"), (2, None), (3, "New york, w1")], "item_id long, text string")


# --- resampling ---------------------------------------------------------------------------------------------

def runs(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    return len(w), [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def weights(rows, targets):
    s, t = collections.Counter(), collections.Counter()
    for counter, texts in ((s, [r[1] for r in rows]), (t, targets)):
        for x in texts:
            counter.update(zlib.crc32(f.encode()) % 10000 for f in runs(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    out = []
    for r in rows:
        n, f = runs(r[1])
        w = sum(gain(zlib.crc32(x.encode()) % 10000) for x in f)
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return out


@pytest.mark.parametrize("percent", [5, 40, 100, 0])
def test_op11_rows(docs, target, percent):
    got = resample.resample_weights(docs, target, percent).collect()
    want = weights(ROWS, ["the w1 w2 w3", "New york, w1"])
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    fit = sorted((r for r in want if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [(r["rank"], r["score"], r["doc_id"]) for r in drawn] == [(i, r[4], r[0]) for i, r in enumerate(fit[:percent * len(fit) // 100], 1)]


def test_op11_empty_and_texts(docs, none, target):
    assert resample.resample_weights(none, target).count() == 0
    assert resample.resample_weights(docs, target.where("false")).count() == len(ROWS)
    kept = resample.resampled(docs, target, percent=30)
    assert kept.columns == docs.columns
    ranked = {r.doc_id for r in resample.resample_weights(docs, target, 30).where("rank is not null").collect()}
    assert {r.doc_id for r in kept.collect()} == ranked


def test_op11_bracket_is_validated_and_widened(spark):
    rows = spark.range(20000).selectExpr("id as doc_id", "cast(30 as bigint) n_words", "cast(pow(id % 1000, 2) as bigint) score").repartition(4)
    values = sorted((int((i % 1000) ** 2) for i in range(20000)), reverse=True)
    for accuracy, width in ((10000, None), (4, 1e-6)):  # the second sketch cannot be right at once
        for k in (1, 37, 10000, 20000):
            lo, hi, above = resample.bracket(rows, k, 20000, accuracy=accuracy, width=width)
            assert lo <= values[k - 1] <= hi and above == sum(v > hi for v in values) < k
    got = resample.draw(rows, percent=3, accuracy=4, width=1e-6).where("rank is not null").orderBy("rank").collect()
    assert [(r["rank"], r["doc_id"]) for r in got] == list(enumerate(
        sorted(range(20000), key=lambda i: (-((i % 1000) ** 2), i))[:600], 1))


# --- SimHash ------------------------------------------------------------------------------------------------

def fingerprint(t):
    w = low(t).encode().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(prints, ids):
    """Components of fingerprints within two bits, by brute force; the smallest id of each, null last."""
    distinct = sorted(set(prints))
    of = {p: p for p in distinct}

    def find(p):
        while of[p] != p:
            p = of[p]
        return p
    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= 2 and find(a) != find(b):
            of[find(b)] = find(a)
    least = {}
    for p, i in zip(prints, ids):
        r = find(p)
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(find(p)) for p in prints]


def test_op12_covering_masks():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for places in itertools.combinations(range(0, 64, 3 if radius == 3 else 1), radius):
            assert any(not any(m >> i & 1 for i in places) for m in masks)


def test_op12_components(docs, none):
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.fp % 2**64, r.component_id) for r in simhash.simhash_classes(docs).collect()), key=str)
    prints = [fingerprint(r[1]) for r in ROWS]
    want = sorted(((r[0] is None, r[0] or 0, p, c) for r, p, c in zip(ROWS, prints, smallest(prints, [r[0] for r in ROWS]))), key=str)
    assert got == want
    assert simhash.simhash_classes(none).count() == 0


def test_op12_links_join_all_pairs_within_the_radius(spark):
    r = random.Random(3)
    prints = set()
    for _ in range(6):  # chains that drift apart, dense balls, and strangers
        p = r.getrandbits(64)
        for _ in range(40):
            for b in r.sample(range(64), r.choice([1, 2, 2, 3])):
                p ^= 1 << b
            prints.add(p)
    ball = r.getrandbits(64)
    prints |= {ball ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)} | {r.getrandbits(64) for _ in range(300)}
    nodes = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "fp long")
    edges = simhash.links(nodes).collect()
    assert all(((e.u % 2**64) ^ (e.v % 2**64)).bit_count() <= 2 for e in edges)
    joined = {c.node % 2**64: c.component for c in simhash.components(simhash.links(nodes)).collect()}
    order = sorted(prints)
    labels = dict(zip(order, smallest(order, order)))
    groups = collections.defaultdict(set)
    for p in order:
        groups[labels[p]].add(joined.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


# --- phrases ------------------------------------------------------------------------------------------------

def brute_phrases(rows, least, most):
    count, n = collections.Counter(), collections.Counter()
    for r in rows:
        lang = r[2] or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", low(r[1])):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            count.update((lang, tuple(w[i:i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    often = {k: a for k, a in count.items() if a >= least and len(k[1]) > 1}
    longer = collections.Counter()
    for (lang, g), a in often.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                longer[lang, g[i:i + k]] = max(longer[lang, g[i:i + k]], a)
    found = collections.defaultdict(list)
    for (lang, g), a in often.items():
        if not longer[lang, g] or 100 * longer[lang, g] < 80 * a:
            s, _, x, y = min((2000000 * a // (count[lang, g[:k]] + count[lang, g[k:]]), k, count[lang, g[:k]], count[lang, g[k:]])
                             for k in range(1, len(g)))
            found[lang].append((-s, -a, " ".join(g).encode(), x, y))
    return sorted((lang, i, p.decode(), -a, x, y, n[lang], -s) for lang in found
                  for i, (s, a, p, x, y) in enumerate(sorted(found[lang])[:most], 1))


@pytest.mark.parametrize("least, most", [(30, 2000), (3, 25)])
def test_op13_phrases(docs, least, most):
    got = collocations.collocations(docs, least, 4, most)
    assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == brute_phrases(ROWS, least, most)


def test_op13_empty(none):
    assert collocations.collocations(none).count() == 0


@pytest.mark.parametrize("held, burst, hot", [(1 << 20, 1 << 15, 0), (3000, 64, 3), (200, 16, 50)])
def test_op13_trie_bursts_spills_and_merges(held, burst, hot):
    r = np.random.default_rng(1)
    trie, runs = hattrie.HatTrie(7, hot, burst=burst, held=held), collections.defaultdict(list)
    want = collections.Counter()
    for _ in range(12):
        seq = np.minimum(r.zipf(1.3, 3000), 400).astype(np.uint32) * (r.random(3000) > 0.1)
        hi, lo = collocations.phrases_of(seq.astype(np.uint32))
        ids = seq.tolist()
        want.update(tuple(ids[i:i + k]) for k in (2, 3, 4) for i in range(len(ids) - k + 1) if all(ids[i:i + k]))
        for part, *run in trie.add(hi, lo):
            runs[part].append(run)
        assert trie.sizes.sum() <= held
    split = len(trie.inner)
    for part, *run in trie.close():
        runs[part].append(run)
    assert (held > 3000) or max(map(len, runs.values())) > 1
    assert burst > 64 or split or held < 1000
    got = {}
    for part, some in runs.items():
        for hi, lo, _ in some:
            assert sorted(zip(hi.tolist(), lo.tolist())) == list(zip(hi.tolist(), lo.tolist()))
            assert (trie.part_of(hi, lo) == part).all()
        hi, lo, n = hattrie.merge_runs([hattrie.pack_run(*run) for run in some])
        for h, x, c in zip(hi.tolist(), lo.tolist(), n.tolist()):
            got[tuple(i for i in (h >> 32, h & 0xFFFFFFFF, x >> 32, x & 0xFFFFFFFF) if i)] = c
    assert got == dict(want)
