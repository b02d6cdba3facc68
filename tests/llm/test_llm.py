"""The training-data operators against brute force, on a fixture with nulls, empty and long texts, ties, repeated rows,
copies and extra columns, and on empty tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from carelake.llm import bitpack, bitslice, doubling, linechunks, lm, packing, pieces, rules, sketchjoin, suffixes
from carelake.llm.components import components
from conftest import ROOT

SCHEMA = "doc_id long, text string, block int, rest string, ids string, source string, n_chars long"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _texts():
    r = random.Random(5)
    words = ["w%d" % i for i in range(60)] + ["The", "the", "é x", "日本", "▁", "a|b", "##"]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, base = line(70), line(120)
    out = [None, "", " \n\t ", "one two", "one two", base, base, base.upper()]
    out += [" ".join(w if r.random() > 0.02 else "edit%d" % r.randrange(99) for w in base.split()) for _ in range(12)]
    out += [line(30) + "\n" + passage + "\n" + line(25) for _ in range(4)]
    shared = [line(6) for _ in range(12)]
    out += ["\n".join([line(4), *shared, line(5)]) for _ in range(3)]
    out += ["x y z " * 40, "\n".join(["same line here"] * 9), "q" * 5000, line(3000), "a  b   c", " lead", "trail \n"]
    out += [line(r.randrange(1, 90)) for _ in range(25)]
    return out


ROWS = [(i * 3, t, 1, "r", "i", "s", 0) for i, t in enumerate(_texts())]


@pytest.fixture(scope="module")
def docs(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark, docs):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark, docs):
    """A null id and a repeated row."""
    return spark.createDataFrame([*ROWS, ROWS[5], (None, ROWS[5][1], 1, "r", "i", "s", 0)], SCHEMA)


def words(t, fold=False):
    raw = (t or "").encode()
    return (raw.lower() if fold else raw).split()


TEXT = {r[0]: r[1] for r in ROWS}


def test_op1_scores(docs, none, odd):
    got = {r.doc_id: r for r in lm.score_documents(docs).collect()}
    tok = {d: [*words(t, True), None] for d, t in TEXT.items()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in tok}
    c = collections.Counter(x for d in tok if not held[d] for x in tok[d])
    total, distinct = sum(c.values()), len(c)
    for d, x in tok.items():
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in x)
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(x), sum(w in c for w in x), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and math.isfinite(r.score) and r.score < 0
    assert sum(got[d].score for d in tok if not held[d]) > sum(got[d].base_score for d in tok if not held[d])
    assert lm.score_documents(none).count() == 0
    assert lm.score_documents(odd).count() == len(ROWS) + 2


def test_op1_scores_do_not_depend_on_the_partitions(odd, monkeypatch):
    monkeypatch.setattr(lm, "TOKEN_BYTES", 6 << 13)  # more units than one a round
    monkeypatch.setattr(lm, "MERGED", 3)             # and more than one level of merging
    by_layout = [sorted(map(str, lm.score_documents(odd.repartition(n)).collect())) for n in (1, 8)]
    assert by_layout[0] == by_layout[1] and len(by_layout[0]) == len(ROWS) + 2


def test_op1_tables_follow_the_training_tokens():
    sizes = [lm.table_rows(n) for n in (0, 10**6, 10**8, 10**9, 10**14)]
    assert sizes == sorted(sizes) and sizes[0] == lm.LEAST_ROWS < sizes[2] < sizes[3] < sizes[4] == lm.MOST_ROWS


def test_op1_factors_sum_to_one():
    r = np.random.default_rng(1)
    t = lm.Trainer(lm.Model(np.log(np.full(lm.COARSE, 1 / lm.COARSE)), np.log(np.full((lm.COARSE, lm.FINE), 1 / lm.FINE))), 0.1)
    h, c = lm.mix(r.integers(0, 50, (3, 500)).astype(np.uint64)), r.integers(0, lm.COARSE * lm.FINE, 500)
    before = t.class_log_p(h, c).sum()
    t.update(h, c)
    assert t.class_log_p(h, c).sum() > before
    every = np.arange(lm.COARSE * lm.FINE)
    one = np.repeat(h[:, :1], len(every), axis=1)
    assert np.exp(t.class_log_p(one, every)).sum() == pytest.approx(1, abs=1e-4)


def test_op2_lossless_and_reproducible(docs, none, odd):
    a = {r.key: r.ids for r in pieces.sample_pieces(docs, PIECES, seed=3).collect()}
    assert a == {r.key: r.ids for r in pieces.sample_pieces(docs.coalesce(1), PIECES, seed=3).collect()}
    assert a != {r.key: r.ids for r in pieces.sample_pieces(docs, PIECES, seed=4).collect()}
    back = pieces.decode_pieces(pieces.sample_pieces(docs, PIECES, seed=3), PIECES)
    assert {r.key: r.text for r in back.collect()} == {d: t or "" for d, t in TEXT.items()}
    assert all(r.lossless for r in pieces.round_trip(odd, PIECES).collect())
    assert pieces.round_trip(none, PIECES).count() == 0


def test_op2_draws_follow_the_lattice():
    v = pieces.Vocabulary(PIECES)
    weight = {bytes(v.raw[v.raw_at[i]:v.raw_at[i] + v.raw_size[i]]).decode(): w for i, w in zip(v.ids.tolist(), v.weights.tolist())}
    want = {}
    text = " then"
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, at = [], 0
        for i, c in enumerate((*cuts, 1)):
            if c:
                parts.append(text[at:i + 1])
                at = i + 1
        if all(p in weight for p in parts):
            want[tuple(parts)] = math.exp(sum(weight[p] for p in parts))
    n = 20000
    ids, at = pieces.encode(pa.array(["then"] * n), pieces.row_keys(pa.array(range(n))), PIECES)
    name = {i: bytes(v.raw[v.raw_at[i]:v.raw_at[i] + v.raw_size[i]]).decode() for i in set(ids.tolist())}
    seen = collections.Counter(tuple(name[i] for i in ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:]))
    total = sum(want.values())
    for parts, w in want.items():
        assert abs(seen[parts] / n - w / total) < 4 * math.sqrt(0.25 / n)


def test_op2_text_without_spaces_is_walked_in_linear_time(monkeypatch):
    r = random.Random(7)
    text = "".join(r.choice(["quick", "brown", "été", "日本", "x", "qq"]) for _ in range(260_000))
    assert len(text.encode()) > 1_000_000
    column, keys = pa.array([text, "a b", text[:900]]), np.array([1, 2, 3], dtype=np.uint64)
    ids, at = pieces.encode(column, keys, PIECES, 1.0, 1)
    assert pieces.decode(ids, at, PIECES) == [text.encode(), b"a b", text[:900].encode()]
    # a chunk gets the same draws by either walk
    short = pa.array([text[:400]])
    one = pieces.encode(short, keys[:1], PIECES, 1.0, 1)[0]
    monkeypatch.setattr(pieces, "LONG", 16)
    pieces._WORKER.clear()
    assert (pieces.encode(short, keys[:1], PIECES, 1.0, 1)[0] == one).all()
    pieces._WORKER.clear()


def test_op3_top_k(spark, docs):
    r = random.Random(2)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, rows[10][1]) for i in range(9)] + [(500, [0.5]), (501, None), (502, [0.1, None]), (503, [float("nan")]), (504, [float("inf")]), (None, [1.0])]
    df = spark.createDataFrame(rows + rows[:1], "vec_id long, embedding array<float>")
    good = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in good if i % 50 == 0):
        s = sorted((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q)[:5]
        want |= {(q, k + 1, c, -m) for k, (m, c) in enumerate(s)}
    assert {tuple(x) for x in bitslice.top_k(df, F.col("vec_id") % 50 == 0).collect()} == want
    assert bitslice.top_k(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0
    assert bitslice.top_k(df.where("vec_id in (0, 7)"), F.col("vec_id") % 50 == 0).count() == 1


def test_op3_one_id_with_two_vectors(spark, docs):
    r = random.Random(4)
    rows = [(i % 70, [r.randrange(-9, 9) / 16 for _ in range(6)]) for i in range(140)]
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for q in (0, 50):  # as the SQL: the scores of all the query's rows with all rows of other ids
        s = sorted((-sum(a * b for a, b in zip(v, w)), c) for i, v in vectors if i == q for c, w in vectors if c != q)[:5]
        want += [(q, k + 1, c, -m) for k, (m, c) in enumerate(s)]
    df = spark.createDataFrame(rows + rows[3:4], "vec_id long, embedding array<float>")
    assert sorted(tuple(x) for x in bitslice.top_k(df, F.col("vec_id") % 50 == 0).collect()) == want


def test_op3_components_of_any_size(spark, docs):
    """Scores beyond 64 bits rank by their exact values; the reported score stands at the end of the range."""
    r = random.Random(8)
    low, high = -2**63, 2**63 - 1
    rows = [(i, [r.choice([1e15, -1e15, 1e18, -1e300, 3e16, 0.5, r.uniform(-1e16, 1e16)]) for _ in range(5)]) for i in range(120)]
    good = {i: [min(max(math.floor(256 * x), low), high) if abs(x) < 1e300 else (high if x > 0 else low) for x in v] for i, v in rows}
    want = set()
    for q in (0, 50, 100):
        s = sorted((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q)[:5]
        want |= {(q, k + 1, c, min(max(-m, low), high)) for k, (m, c) in enumerate(s)}
    df = spark.createDataFrame([(i, v, i, "s", b"x") for i, v in rows],
                               "vec_id long, embedding array<double>, score long, block string, exact binary")
    assert {tuple(x) for x in bitslice.top_k(df, F.col("vec_id") % 50 == 0).collect()} == want


def test_op3_slots_follow_bytes_not_queries():
    index_shuffles = [bitslice.slots_for(q, q * 512, blocks, 200) for q, blocks in ((1600, 3), (1 << 20, 1600), (1 << 24, 25600))]
    assert index_shuffles == [67, 512, 8192]
    assert bitslice.slots_for(0, 0, 1, 8) == 1 and bitslice.slots_for(3, 1536, 1, 8) == 3


def _removed(texts, n):
    low = {}
    for d, t in texts:
        w = words(t)
        for i in range(len(w) - n + 1):
            low[tuple(w[i:i + n])] = min(d, low.get(tuple(w[i:i + n]), d))
    out = []
    for d, t in texts:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if low[tuple(w[i:i + n])] < d:
                gone[i:i + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("n,first", [(13, 7), (13, 2), (5, 5), (3, 1)])
def test_op4_removal(docs, none, n, first):
    got = sorted(tuple(r) for r in doubling.removal_digest(docs, n, first).collect())
    assert got == _removed(TEXT.items(), n)
    assert doubling.removal_digest(none, n, first).count() == 0


def test_op4_bucket_rows_follow_their_keys():
    """A block of 2,000 documents spread over 4,096 buckets sends bytes by its keys, not its ids once a bucket."""
    r = np.random.default_rng(3)
    ids = np.sort(r.choice(2**40, 2000, replace=False)).astype(np.int64)
    best = r.integers(0, 2000, 20000)
    sent = 0
    for part in np.array_split(best, 4096):
        places, names = doubling.pack_docs(ids, part)
        assert (doubling.unpack_docs(places, names) == ids[part]).all()
        sent += len(places) + len(names)
    assert sent <= 9 * len(best)
    places, names = doubling.pack_docs(ids, best)
    assert len(places) == 2 * len(best) and (doubling.unpack_docs(places, names) == ids[best]).all()


def test_op4_many_rows_of_one_id_or_none(spark, docs):
    """They are one document each, wherever their rows are dealt."""
    rows = [(d, t) for t in list(TEXT.values())[:40] for d in (None, 4, 9)]
    big = 2**63 - 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((big if r[0] is None else r[0], *r[1:]) for r in doubling.removal_digest(df).collect())
    assert got == _removed([(big if d is None else d, t) for d, t in rows], 13)
    dealt = doubling.text_blocks(df.where("doc_id is null"), "doc_id", "text", 16, by_text=True)
    assert dealt.select("block").distinct().count() > 8


def test_op4_odd_rows_and_texts(odd, docs):
    big = 2**63 - 1
    want = _removed([*TEXT.items(), (ROWS[5][0], ROWS[5][1]), (big, ROWS[5][1])], 13)
    got = sorted((big if r[0] is None else r[0], *r[1:]) for r in doubling.removal_digest(odd).collect())
    assert got == want
    kept = doubling.remove_repeats(docs, removed="gone")
    assert kept.columns == [*docs.columns, "gone"]
    assert all((r.text == TEXT[r.doc_id]) == (r.gone == 0) for r in kept.collect())


def test_op5_pieces(docs, none, odd):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack_powers(docs, path, longest=256).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) == max(r.sequence_id for r in rows) + 1
    by = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r.start):
        by[r.doc_id].append(r)
    for d, t in TEXT.items():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert sum(r.length for r in by[d]) == len(ids)
        for r in by[d]:
            assert r.length & (r.length - 1) == 0 and r.length <= 256 and r.offset == 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert packing.pack_powers(none, path).count() == 0
    assert packing.pack_powers(odd, path).select("sequence_id").distinct().count() == packing.pack_powers(odd, path).count()


def _removable(texts):
    """Per document (in id order): of each line, whether a pair of lines that holds it also stands at an earlier place."""
    seen, out = set(), {}
    for d, t in texts:
        lines = (t or "").split("\n")
        flags = [False] * len(lines)
        for i, pair in enumerate(zip(lines, lines[1:])):
            if pair in seen:
                flags[i] = flags[i + 1] = True
            seen.add(pair)
        out[d] = lines, flags
    return out


def _subsequence(small, large):
    rest = iter(large)
    return all(x in rest for x in small)


def test_op6_line_chunks(docs, none, odd):
    left = {r.doc_id: r.text for r in linechunks.remove_repeated_chunks(docs).collect()}
    assert set(left) == set(TEXT) and [d for d in left if left[d] is None] == [d for d in TEXT if TEXT[d] is None]
    gone = 0
    for d, (lines, flags) in _removable(sorted(TEXT.items())).items():
        kept = (left[d] or "").split("\n")
        # what stands nowhere earlier stays, in order; what is left is the document's own, in order
        assert _subsequence([x for x, f in zip(lines, flags) if not f], kept) and _subsequence([x for x in kept if x], lines), d
        gone += len(lines) - len(kept)
    assert gone > 20
    # one copy of each line stays
    assert {x for t in TEXT.values() for x in (t or "").split("\n")} - {""} <= {x for t in left.values() for x in (t or "").split("\n")}
    for r in linechunks.chunk_digest(docs).collect():
        assert r.n_lines == len((TEXT[r.doc_id] or "").split("\n")) and (r.n_removed >= 2) == (r.n_chunks_removed > 0)
        assert r.kept_sha256 == hashlib.sha256((left[r.doc_id] or "").encode()).hexdigest()
    out = linechunks.remove_repeated_chunks(docs)
    assert out.columns == docs.columns
    assert linechunks.chunk_digest(none).count() == 0 and linechunks.chunk_digest(odd).count() == len(ROWS) + 2


def test_op6_recall_of_planted_blocks(spark):
    """Blocks of 3 to 20 lines, each in three documents of otherwise unlike lines: nine of ten repeated lines go, whole
    where anything of a block is found, and no other line goes."""
    r = random.Random(11)
    line = lambda: " ".join("w%d" % r.randrange(50000) for _ in range(r.randrange(3, 12)))
    rows, size, block = [], {}, {}
    for m in range(3, 21):
        for _ in range(25):
            shared = [line() for _ in range(m)]
            for copy in range(3):
                text = "\n".join([*[line() for _ in range(r.randrange(0, 9))], *shared, *[line() for _ in range(r.randrange(0, 9))]])
                size[len(rows)], block[len(rows)] = (m if copy else 0), set(shared)
                rows.append((len(rows), text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    left = {x.doc_id: x.text.split("\n") for x in linechunks.remove_repeated_chunks(docs).collect()}
    found = {m: 0 for m in range(21)}
    for d, text in rows:
        lost = [x for x in text.split("\n") if x not in left[d]]
        assert set(lost) <= (block[d] if size[d] else set()) and len(lost) in (0, size[d]), d
        found[size[d]] += len(lost)
    planted = {m: m * 50 for m in range(3, 21)}
    assert sum(found.values()) >= 0.9 * sum(planted.values())
    assert all(found[m] >= 0.9 * planted[m] for m in range(8, 21)), found


def test_op6_copies_go_whole(spark):
    """Copies of documents of two lines or more go, their last lines and runs of one same line included; texts without a
    repeated pair of lines stay."""
    r = random.Random(3)
    texts = ["\n".join("l%d" % r.randrange(10**9) for _ in range(n)) for n in (1, 2, 3, 4, 7, 33, 34, 65, 200)]
    texts += ["\n".join(["same line"] * 70)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:-1])], "doc_id long, text string")
    got = {x.doc_id: x for x in linechunks.chunk_digest(docs).collect()}
    for i, t in enumerate(texts[:-1]):
        n = len(t.split("\n"))
        assert got[i].n_removed == 0 and got[len(texts) + i].n_removed == (n if n > 1 else 0), n
    assert got[len(texts) - 1].n_lines == 70 and 30 <= got[len(texts) - 1].n_removed <= 68


def test_op7_files(docs, none, odd):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, start, want = Tokenizer.from_file(path), 0, []
    for d in sorted(TEXT):
        ids = [*tok.encode(TEXT[d] or "", add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in bitpack.round_trip(docs, path, 50257).collect()) == want
    assert bitpack.round_trip(none, path, 50257).count() == 0
    assert bitpack.round_trip(odd, path, 50257).count() == len(ROWS) + 2


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17])
def test_op7_format(bits):
    import io
    r = np.random.default_rng(bits)
    ids = r.integers(0, 2**bits, 1000).astype(np.uint32)
    bounds = np.array([0, 0, 10, 700, 1000])
    shard = bitpack.Reader(io.BytesIO(bitpack.to_bytes([1, None, 3, 4], ids, bounds, bits, block_ids=64)))
    assert shard.docs.to_pylist() == [1, None, 3, 4] and (shard.ids(0, 1000) == ids).all()
    assert all((shard.document(i) == ids[bounds[i]:bounds[i + 1]]).all() for i in range(4))
    assert (shard.ids(63, 130) == ids[63:130]).all()


def test_op8_passages(docs, none, odd):
    low, high, want = {}, {}, set()
    for d, t in TEXT.items():
        w = words(t)
        for i in range(len(w) - 49):
            g = tuple(w[i:i + 50])
            low[g], high[g] = min(d, low.get(g, d)), max(d, high.get(g, d))
    for d, t in TEXT.items():
        w = words(t)
        hit = [False] * len(w)
        for i in range(len(w) - 49):
            if low[tuple(w[i:i + 50])] != high[tuple(w[i:i + 50])]:
                hit[i:i + 50] = [True] * 50
        at = 0
        for k, run in itertools.groupby(hit):
            n = len(list(run))
            if k:
                want.add((d, at, n))
            at += n
    got = suffixes.repeated_passages(docs).collect()
    true = {(d, i) for d, a, n in want for i in range(a, a + n)}
    seen = {(r.doc_id, i) for r in got for i in range(r.start_word, r.start_word + r.n_words)}
    assert seen <= true and len(seen) >= 0.99 * len(true) and len(want) > 5
    assert {d for d, _ in seen} == {d for d, _ in true}
    assert suffixes.repeated_passages(none).count() == 0
    assert any(r.doc_id is None for r in suffixes.repeated_passages(odd).collect())


def test_op9_statistics_and_list(spark, docs, none):
    labels = spark.createDataFrame([(r[0], int(not re.search("[|#]", r[1] or ""))) for r in ROWS for _ in (0, 1)] + [(None, 0)], "doc_id long, quality int")
    for r in rules.judge(docs, labels).collect():
        t = TEXT[r.doc_id] or ""
        w = re.findall("[^\x20\x09-\x0D]+", t)
        c = collections.Counter(zip(w, w[1:], w[2:]))
        hit = [False] * len(w)
        for i in range(len(w) - 2):
            if c[tuple(w[i:i + 3])] > 1:
                hit[i:i + 3] = [True] * 3
        lines = [x for x in t.split("\n") if x.split()]
        assert tuple(r)[1:6] == (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), sum(hit))
        assert r.base_failed == (len(w) < 50 or 100 * sum(hit) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert rules.judge(none, labels).count() == 0
    assert rules.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_op9_learns_on_held_out_documents(spark):
    made = spark.range(4000).select(F.col("id").alias("doc_id"), F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"),
                                    (F.pmod(F.xxhash64("id"), F.lit(3)) > 0).alias("grow"))
    made = made.withColumn("bad", ((F.col("a") > 0.8) & (F.col("b") > 0.4)) | (F.col("c") < 0.1))
    found = rules.learn_list(made, ["a", "b", "c"])
    kept = rules.verdict(found, {x: F.col(x) for x in "abc"})
    test = made.withColumn("kept", kept)
    assert found and test.where(F.col("kept") == ~F.col("bad")).count() > 0.95 * 4000
    assert rules.learn_list(made.where("bad"), ["a"]) == []


def _jaccard(texts, link=lambda a, b: 100 * len(a & b) >= 80 * len(a | b)):
    sets = {}
    for d, t in texts.items():
        w = words(t, True)
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    group = {d: d for d in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and link(sets[a], sets[b])]
    for _ in sets:
        for a, b in pairs:
            group[a] = group[b] = min(group[a], group[b])
    return {(d, len(sets[d]), group[d]) for d in sets}, sets, pairs


def test_op10_components_and_links(docs, none, odd):
    want, sets, pairs = _jaccard(TEXT)
    assert {tuple(r) for r in sketchjoin.jaccard_classes(docs).collect()} == want
    links, member = sketchjoin.jaccard_links(docs)
    rep = {r.doc_id: r.rep for r in member.collect()}
    assert {(r.u, r.v) for r in links.collect()} == {(a, b) for a, b in ((rep[a], rep[b]) for a, b in pairs) if a != b}
    assert sketchjoin.jaccard_classes(none).count() == 0
    assert sketchjoin.jaccard_classes(odd).count() == len(ROWS) + 2
    assert {r.doc_id for r in sketchjoin.keep_one(docs).collect()} == {d for d, _, g in want if d == g}


def test_op10_repeated_and_null_ids_keep_their_links(spark, docs):
    r = random.Random(1)
    base = ["v%d" % r.randrange(10**6) for _ in range(120)]
    alone = " ".join("u%d" % i for i in range(80))
    rows = [(5, alone), (5, " ".join(base + ["one"])), (11, " ".join(base + ["one", "two"])), (None, " ".join(["zero"] + base)),
            (None, " ".join("n%d" % i for i in range(100))), (None, " ".join("n%d" % i for i in range(101))), (20, alone + " x"), (20, "other words")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in sketchjoin.jaccard_classes(table).collect()), key=str)
    want = [(5, 76, 5), (5, 117, 5), (11, 118, 5), (None, 117, 5), (None, 96, None), (None, 97, None), (20, 77, 5), (20, 1, 20)]
    assert got == sorted(want, key=str)
    links, member = sketchjoin.jaccard_links(table)
    assert sorted(((x.u, x.v) for x in links.collect()), key=str) == sorted([(5, 11), (5, None), (11, None), (None, None), (5, 20)], key=str)
    assert member.where("code is null").count() == 0
    # 20 stays for its other text; rows without an id stay
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in sketchjoin.keep_one(table).collect()) == [(False, 5), (False, 5), (False, 20), (False, 20)] + [(True, 0)] * 3


def test_op10_sketch_bounds():
    r = np.random.default_rng(3)
    m = sketchjoin.Measure()
    for a in range(1, 60):
        for b in range(a, 90):
            best = max((x for x in range(a + 1) if m.linked(a, b, x) or not x), default=0)
            least = next((x for x in range(1, a + 1) if m.linked(a, b, x)), None)
            assert (least is not None) == (b <= m.most(a)) and best >= 0
            if least is not None:
                assert m.max_difference(a, b) == a + b - 2 * least
    x = r.integers(0, 2**63, 300).astype(np.uint64)
    y = np.concatenate([x[:280], r.integers(0, 2**63, 15).astype(np.uint64)])
    assert np.bitwise_count(sketchjoin.parity_sketch(x) ^ sketchjoin.parity_sketch(y)).sum() <= 35


def test_op10_allowed_covers_every_size_pair():
    m = sketchjoin.Measure()
    allowed = {(a, band): m.allowed(a, band) for a in range(1, 3000) for band in m.bands(a)}
    for a in range(1, 3000):
        for b in range(a, min(m.most(a), 2999) + 1):
            both = set(m.bands(a)) & set(m.bands(b))
            assert any(min(allowed[a, x], allowed[b, x]) >= m.max_difference(a, b) for x in both), (a, b)


def test_op10_short_documents_with_added_words(spark, docs):
    rows, want = [], {}
    for short, long in ((10, 11), (16, 19), (28, 34)):
        for i in range(30):
            d, w = len(rows), ["s%dw%dx%d" % (short, i, j) for j in range(long)]
            at = i % (long - short + 1)  # the added words stand before, after or on both sides
            rows += [(d, " ".join(w[at:at + short])), (d + 1, " ".join(w))]
            want |= {d: d, d + 1: d}
    got = sketchjoin.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_op10_open_pairs_outlive_a_new_largest_component(spark, docs):
    """At one key: 2 fails with 0, the nearest of {0, 1}, and joins 3 and 4 to a larger component before it meets 1."""
    sets = {d: np.arange(10 * d, 10 * d + 100, dtype=np.uint64) for d in range(5)}
    sketch = {d: bytes([3 if d == 1 else 0] + [0] * (sketchjoin.SKETCH_BITS // 8 - 1)) for d in sets}
    kept = spark.createDataFrame([(d, 100, [7], sketch[d], x.tobytes()) for d, x in sets.items()],
                                 "doc_id long, n long, keys array<long>, sketch binary, shingles binary")
    found = sketchjoin._all_labels(kept, sketchjoin.Measure()).collect()
    assert {r.doc_id: r.label for r in found} == {d: 0 for d in sets}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 100 + i) for i in range(40)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 100}


def test_pipeline_stages(spark, docs, tmp_root):
    import corpus_pipeline
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    table = docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))
    table.write.parquet(f"{tmp_root}/documents.parquet")
    spark.createDataFrame([(r[0], 1) for r in ROWS], "doc_id long, quality int").write.parquet(f"{tmp_root}/labels.parquet")
    d = spark.read.parquet(f"{tmp_root}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, d, tmp_root).write.parquet(f"{tmp_root}/{i}")
        d = spark.read.parquet(f"{tmp_root}/{i}")
        assert d.columns == columns, name
    left = {r.doc_id for r in d.collect()}
    out = corpus_pipeline.run(spark, tmp_root).collect()
    assert {r.doc_id for r in out} == left and left
