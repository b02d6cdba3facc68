"""What one Python worker holds: the tokenizer's results, and what it keeps for the next task."""
import numpy as np
import pyarrow as pa
import public_tokenizers

from carelake.llm import blocks, collocations, packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_distinct_chunks_are_encoded_some_at_a_time(monkeypatch):
    monkeypatch.setattr(tokens, "_CACHES", {})
    chunks = [f" word{i}" for i in range(3 * tokens.ENCODED + 5)]
    cache = tokens._cache(PATH)
    whole = [e.ids for e in cache.encoder.encode_batch(chunks, add_special_tokens=False)]
    asked = []

    class Counting:
        def encode_batch_fast(self, some, **kw):
            asked.append(len(some))
            return real.encode_batch(some, **kw)

    real, cache.encoder = cache.encoder, Counting()
    Counting.encode_batch = Counting.encode_batch_fast
    flat, size = cache.encode(chunks)
    assert max(asked) <= tokens.ENCODED and sum(asked) == len(chunks)
    assert size.tolist() == [len(x) for x in whole] and flat.tolist() == [i for x in whole for i in x]
    assert [len(x) for x in cache.encode([])] == [0, 0]


def test_workers_hand_freed_memory_back(monkeypatch):
    done = []
    for module in (packing, collocations):
        monkeypatch.setattr(module, "give_back", lambda: done.append(1))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2]), "text": pa.array(["a b c", None]), "row_key": pa.array([0, 1])})
    assert sum(b.num_rows for b in packing._pieces(PATH, 1, 2048, False)(iter([batch]))) > 0 and len(done) == 1
    text = pa.RecordBatch.from_pydict({"lang": pa.array(["fr", "fr"]), "text": pa.array(["a b a", "b a"])})
    assert sum(x for b in collocations._count_words()(iter([text])) for x in b.column("n").to_pylist()) == 5 and len(done) == 2
    ids = pa.RecordBatch.from_pydict({"ids": pa.array([np.array([1, 2, 1], np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()], pa.binary())})
    assert list(collocations._count_phrases(2, 0, 4)(iter([ids]))) and len(done) == 3
    blocks.give_back()


def _counting(monkeypatch, path):
    """A fresh cache whose tokenizer notes the texts it is given."""
    monkeypatch.setattr(tokens, "_CACHES", {})
    cache, asked = tokens._cache(path), []

    class Counting:
        def encode(self, one, **kw):
            asked.append(one)
            return real.encode(one, **kw)

        def encode_batch_fast(self, some, **kw):
            asked.extend(some)
            return real.encode_batch(some, **kw)

        encode_batch = encode_batch_fast

    real, cache.encoder = cache.encoder, Counting()
    return cache, real, asked


def test_new_chunks_are_encoded_side_by_side(monkeypatch):
    odd = ["a" + " word" * 3 + "\n\n x. ´é é ́b", " <|endoftext|> y<|endoftext|", "|> I'M it's '　 z  ", None, "", " ﬁ İ ＡＢ 12,5 ß\t\tq", "̸= = ̸"]
    texts = odd + [" ".join(f"w{i}x{i * 7 % 1000}" for i in range(900))] + odd[::-1]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        _, real, asked = _counting(monkeypatch, path)
        ids, bounds = tokens.encode_rows(pa.array(texts), path, 1)
        whole = [real.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == whole
        assert len(asked) < 60, len(asked)  # more than 900 distinct chunks


def test_offsets_out_of_order_tell_nothing(monkeypatch):
    cache, real, asked = _counting(monkeypatch, PATH)
    chunks, whole = [" one", " two", " threefold"], [real.encode(c).ids for c in (" one", " two", " threefold")]
    odd = type("Odd", (), {"ids": [1, 2, 3], "offsets": [(5, 6), (0, 1), (9, 10)]})
    monkeypatch.setattr(type(cache.encoder), "encode", lambda self, one, **kw: odd)
    flat, size = cache.encode_joined(chunks)
    assert flat.tolist() == sum(whole, []) and size.tolist() == [len(x) for x in whole] and asked == chunks


def test_a_full_cache_starts_again(monkeypatch):
    monkeypatch.setattr(tokens, "_CACHES", {})
    monkeypatch.setattr(tokens, "MAX_CACHED", 50)
    text = [" ".join(f"n{i + k}" for i in range(40)) for k in range(0, 90, 30)]
    real = tokens._cache(PATH).encoder
    for t in text:
        ids, _ = tokens.encode_rows(pa.array([t]), PATH)
        assert ids.tolist() == real.encode(t, add_special_tokens=False).ids
