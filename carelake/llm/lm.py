"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax (operator 1).

P(word | history) = P(coarse class | history) * P(fine class | coarse class, history) * P(word | class).

The ``head`` most frequent training words have a class of their own; all other words share ``tail`` classes, chosen by
hash. Inside a tail class words have their smoothed training frequency. The two softmax factors are
maximum-entropy models over three hashed features of the history: the previous word (bigram), the word before it
(skip), and both (trigram); each names a row of a weight table by its hash. History ends at the document's start.

Training takes every document once, in ``ROUNDS`` rounds. Documents are dealt to units by a hash of their id and text;
a round's units each make mini-batch gradient updates (AdaGrad) over their own documents, starting from the merged
model of the round before (the first from the class frequencies), and the units' weights are averaged, each row by how
often a unit met it, in a tree of shuffles by row range (weights travel in half precision). So the model does not depend on how the input is partitioned.
The number of weight rows follows the square root of the training tokens up to ``MOST_ROWS`` (50 MB of weights, the most
that is broadcast), and a unit's text follows the size of the tables, so what units ship stays in proportion to the corpus.
Scores are computed in sparse numpy batches: of a token only the few weight rows its features name are read.

Counts are exact and over all training documents. A block of documents asks for the counts of its distinct words
(``blocks.py``); the vocabulary is never in one place. Only sums, the ``head`` words and the weight tables come
to the driver: their sizes are parameters.

Defined cases: null text is empty (one token, the end); a null id counts as the text "" for the split; rows with the same id are
scored each; without training documents every count is 0 and the model is uniform over classes.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.blocks import bucket_cuts, in_slices, plan_blocks, text_blocks
from carelake.llm.words import Words, mix
from carelake.session import pin

END = mix(np.array([0x656E64], dtype=np.uint64), seed=81)[0]  # the end token's hash; no word has it but by chance
COARSE = FINE = 32
HEAD = 768          # words with a class of their own
LEAST_ROWS, MOST_ROWS = 1 << 12, 1 << 16  # weight rows of each feature template
ROUNDS = 3          # merge-and-continue rounds of training
RANGE = 1024        # weight rows that travel together
TOKEN_BYTES = 6     # of text, about
MERGED = 64         # units whose weights meet in one group
TEMPLATES = 3
BATCH = 8192        # tokens of one gradient update
_TAIL = COARSE * FINE - HEAD


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, first token of each row): every row's words, then the end."""
    out = np.empty(len(words.hashes) + words.n_rows, dtype=np.uint64)
    ends = words.bounds[1:] + np.arange(words.n_rows)
    body = np.ones(len(out), dtype=bool)
    body[ends] = False
    out[body], out[ends] = words.hashes, END
    return out, words.bounds + np.arange(words.n_rows + 1)


def held_out(ids: list) -> np.ndarray:
    """True for documents that are not learnt from."""
    return np.array([zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i in ids], dtype=bool)


def classes(hashes: np.ndarray, head: np.ndarray, head_class: np.ndarray) -> np.ndarray:
    """The class of every token: a head word's own, else a tail class by hash."""
    out = HEAD + (mix(hashes, seed=82) % np.uint64(_TAIL)).astype(np.int64)
    if len(head):
        i = np.minimum(np.searchsorted(head, hashes), len(head) - 1)
        out = np.where(head[i] == hashes, head_class[i], out)
    return out


def features(tok: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(3, tokens) hash of the bigram, skip and trigram history of every token."""
    start = np.zeros(len(tok), dtype=bool)
    start[first[:-1]] = True
    second = np.zeros(len(tok), dtype=bool)
    second[1:] = start[:-1]
    none = np.uint64(0x7F4A7C15)
    one = np.concatenate([[none], tok[:-1]])
    one[start] = none
    two = np.concatenate([[none, none], tok[:-2]])[:len(tok)]
    two[start | second] = none
    return np.stack([mix(one, seed=83), mix(two, seed=84), mix(one * np.uint64(3) + mix(two, seed=85), seed=86)])


def table_rows(train_tokens: int) -> int:
    """Weight rows of a template: the power of two at the square root of the training tokens, within bounds."""
    return int(min(MOST_ROWS, max(LEAST_ROWS, 2 ** math.ceil(math.log2(math.sqrt(train_tokens + 1))))))


class Model:
    """Weight tables: a shared start row and ``TEMPLATES * n_rows`` hashed rows for either factor. ``square``: of
    each row, the mean of its squared gradients so far."""

    def __init__(self, bias1: np.ndarray, bias2: np.ndarray, n_rows: int = LEAST_ROWS):
        self.bias1, self.bias2, self.n_rows = bias1.astype(np.float32), bias2.astype(np.float32), n_rows
        self.w = [np.zeros((TEMPLATES * n_rows, n), dtype=np.float32) for n in (COARSE, FINE)]
        self.square = [np.full(TEMPLATES * n_rows, 1e-1, dtype=np.float32) for _ in (COARSE, FINE)]

    def rows(self, hashes: np.ndarray, coarse: np.ndarray | None = None) -> np.ndarray:
        """(3, tokens) weight rows of feature hashes (with the coarse class for the second factor)."""
        if coarse is not None:
            hashes = mix(hashes + (coarse.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), seed=87)
        return (hashes % np.uint64(self.n_rows)).astype(np.int64) + np.arange(TEMPLATES)[:, None] * self.n_rows

    def _logits(self, factor: int, rows: np.ndarray, coarse: np.ndarray | None) -> np.ndarray:
        """(tokens, classes); shifted, each token's largest to 0, where exponentials could leave single precision."""
        w = self.w[factor]
        z = w.take(rows[0], axis=0)
        z += w.take(rows[1], axis=0)
        z += w.take(rows[2], axis=0)
        z += self.bias1 if coarse is None else self.bias2.take(coarse, axis=0)
        if z.size and (z.max() > 60 or z.min() < -60):
            z -= z.max(axis=1, keepdims=True)
        return z

    def p(self, factor: int, rows: np.ndarray, coarse: np.ndarray | None = None) -> np.ndarray:
        """Probabilities (tokens, classes) of one factor."""
        z = self._logits(factor, rows, coarse)
        np.exp(z, out=z)
        z /= np.einsum("ij->i", z)[:, None]
        return z

    def log_p(self, factor: int, rows: np.ndarray, target: np.ndarray, coarse: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each token's ``target`` class in one factor."""
        z = self._logits(factor, rows, coarse)
        at = z[np.arange(len(target)), target].astype(np.float64)
        np.exp(z, out=z)
        return at - np.log(np.einsum("ij->i", z).astype(np.float64))

    def class_log_p(self, hashes: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Natural log probability of every token's class given its history."""
        out = np.empty(len(cls))
        for a in range(0, len(cls), BATCH):
            h, c = hashes[:, a:a + BATCH], cls[a:a + BATCH]
            coarse, fine = c % COARSE, c // COARSE
            out[a:a + BATCH] = self.log_p(0, self.rows(h), coarse)
            out[a:a + BATCH] += self.log_p(1, self.rows(h, coarse), fine, coarse)
        return np.maximum(out, -200.0)


class Trainer(Model):
    """AdaGrad on mini-batches; remembers how often each row was met."""

    def __init__(self, start: Model, rate: float):
        super().__init__(start.bias1, start.bias2, start.n_rows)
        self.rate = rate
        self.w = [w.copy() for w in start.w]
        self.square = [np.repeat(q[:, None], w.shape[1], axis=1) for q, w in zip(start.square, start.w)]
        self.met = [np.zeros(len(w), dtype=np.int64) for w in self.w]

    def update(self, hashes: np.ndarray, cls: np.ndarray) -> None:
        coarse, fine = cls % COARSE, cls // COARSE
        for factor, rows, target, given in ((0, self.rows(hashes), coarse, None), (1, self.rows(hashes, coarse), fine, coarse)):
            grad = self.p(factor, rows, given)
            grad[np.arange(len(target)), target] -= 1
            pairs = grad.view(np.complex64)  # two classes a number: half as many steps in the sums by row
            for t in range(TEMPLATES):
                order = np.argsort((rows[t] - t * self.n_rows).astype(np.uint16), kind="stable")  # a radix sort
                sorted_rows = rows[t][order]
                first = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
                g = np.add.reduceat(pairs.take(order, axis=0), first, axis=0).view(np.float32)
                r = sorted_rows[first]
                square = self.square[factor].take(r, axis=0)
                square += g * g
                self.square[factor][r] = square
                np.sqrt(square, out=square)
                g /= square
                g *= np.float32(self.rate)
                self.w[factor][r] = self.w[factor].take(r, axis=0) - g
                self.met[factor][r] += np.diff(np.append(first, len(order)))


# --- counts ---------------------------------------------------------------------------------------

def _merge_counts(parts: list) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count(bits: int, most: int = 1 << 20):
    """Training counts of a task's words: distinct words by bucket, sent on when there are many."""
    def count(batches):
        parts, held = [], 0

        def rows():
            keys, counts = _merge_counts(parts)
            present, cuts = bucket_cuts(keys, 64 - bits)
            parts_of = list(zip(cuts[:-1], cuts[1:]))
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array(present, pa.int32()), "keys": pa.array([keys[a:b].tobytes() for a, b in parts_of], pa.binary()),
                "counts": pa.array([counts[a:b].tobytes() for a, b in parts_of], pa.binary())})

        for batch in batches:
            for _, part in in_slices(pa.Table.from_batches([batch])):
                learn = ~held_out(part.column("doc_id").to_pylist())
                if not learn.any():
                    continue
                tok, _ = tokens(Words(part.column("text").filter(pa.array(learn)), fold=True))
                k, c = np.unique(tok, return_counts=True)
                parts.append((k, c.astype(np.int64)))
                held += len(k)
                if held > most:
                    parts[:] = [_merge_counts(parts)]
                    held = len(parts[0][0])
                    if held > most // 2:
                        yield rows()
                        parts, held = [], 0
        if parts:
            yield rows()
    return count


def _vocabulary(key, table):
    """One bucket's words: total counts, sums by tail class, and the candidates for the head."""
    keys, counts = _merge_counts([(np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64))
                                  for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist())])
    tail = (mix(keys, seed=82) % np.uint64(_TAIL)).astype(np.int64)
    top = np.lexsort((keys, -counts))[:HEAD]
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([keys.tobytes()], pa.binary()),
                     "counts": pa.array([counts.tobytes()], pa.binary()),
                     "tail_n": pa.array([np.bincount(tail, weights=counts, minlength=_TAIL).astype(np.int64)], pa.list_(pa.int64())),
                     "tail_v": pa.array([np.bincount(tail, minlength=_TAIL)], pa.list_(pa.int64())),
                     "top": pa.array([[{"c": c, "h": h} for c, h in zip(counts[top].tolist(), keys[top].view(np.int64).tolist())]],
                                     pa.list_(pa.struct([("c", pa.int64()), ("h", pa.int64())])))})


class Frame:
    """What every task knows of the vocabulary: sums, the head words and their classes, the tail classes' sums."""

    def __init__(self, vocabulary: DataFrame):
        # a fixed number of words and classes, whatever the corpus
        best = (vocabulary.select(F.explode("top").alias("t")).select("t.c", "t.h").orderBy(F.col("c").desc(), "h").limit(HEAD).collect())
        sums = (vocabulary.select(F.posexplode(F.arrays_zip("tail_n", "tail_v"))).groupBy("pos")
                .agg(F.sum("col.tail_n").alias("n"), F.sum("col.tail_v").alias("v")).collect())
        tail_n, tail_v = np.zeros(_TAIL, dtype=np.int64), np.zeros(_TAIL, dtype=np.int64)
        for r in sums:
            tail_n[r["pos"]], tail_v[r["pos"]] = r["n"], r["v"]
        self.total, self.distinct = int(tail_n.sum()), int(tail_v.sum())
        head = np.array([r["h"] for r in best], dtype=np.int64).view(np.uint64)
        count = np.array([r["c"] for r in best], dtype=np.int64)
        own = (mix(head, seed=82) % np.uint64(_TAIL)).astype(np.int64)
        np.subtract.at(tail_n, own, count)
        np.subtract.at(tail_v, own, 1)
        order = np.argsort(head)
        self.n_rows = table_rows(self.total)
        self.head, self.head_class = head[order], np.arange(len(head))[order]
        self.tail_n, self.tail_v = tail_n, tail_v
        mass = np.concatenate([np.pad(count, (0, HEAD - len(count))), tail_n]) + 0.5
        leaf = np.zeros((COARSE, FINE))
        cls = np.arange(COARSE * FINE)
        leaf[cls % COARSE, cls // COARSE] = mass
        self.bias1 = np.log(leaf.sum(axis=1) / leaf.sum())
        self.bias2 = np.log(leaf / leaf.sum(axis=1, keepdims=True))

    def classes(self, hashes):
        return classes(hashes, self.head, self.head_class)

    def word_log10(self, cls: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 P(word | class): 1 for a head word, the smoothed frequency in a tail class."""
        tail = np.maximum(cls - HEAD, 0)
        p = (counts + 0.1) / (self.tail_n[tail] + 0.1 * (self.tail_v[tail] + 1))
        return np.where(cls < HEAD, 0.0, np.log10(p))


# --- training --------------------------------------------------------------------------------------

_WEIGHTS = "part int, unit long, rows binary, met binary, weights binary, square binary"


def _train(shared, rate: float):
    """The weights that one unit's documents make of the model, in row ranges."""
    def train(key, table):
        frame, model = shared.value
        trainer = Trainer(model, rate)
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        for _, part in in_slices(table):
            tok, first = tokens(Words(part.column("text"), fold=True))
            hashes, cls = features(tok, first), frame.classes(tok)
            for a in range(0, len(tok), BATCH):
                trainer.update(hashes[:, a:a + BATCH], cls[a:a + BATCH])
        out = []
        for factor in (0, 1):
            met = np.flatnonzero(trainer.met[factor])
            present, first = np.unique(met // RANGE, return_index=True)
            ranges = TEMPLATES * model.n_rows // RANGE
            for p, r in zip(present.tolist(), np.split(met, first[1:])):
                out.append((factor * ranges + p, key[0].as_py(), r, trainer.met[factor][r], trainer.w[factor][r],
                            trainer.square[factor][r].mean(axis=1)))
        return _weight_rows(out)
    return train


def _weight_rows(rows: list) -> pa.Table:
    part, unit, *arrays = zip(*rows) if rows else [()] * 6
    kinds = zip(("rows", "met", "weights", "square"), (np.int32, np.int64, np.float16, np.float32), arrays)
    return pa.table({"part": pa.array(part, pa.int32()), "unit": pa.array(unit, pa.int64())}
                    | {name: pa.array([x.astype(t).tobytes() for x in column], pa.binary()) for name, t, column in kinds})


def _average(key, table):
    """One row range of several units: weights averaged by how often each unit met the row."""
    total, square, met, base = np.zeros((RANGE, FINE)), np.zeros(RANGE), np.zeros(RANGE), 0
    table = table.sort_by("unit")  # the same sums whatever order the units came in
    for r, m, w, q in zip(*[table.column(c) for c in ("rows", "met", "weights", "square")]):
        rows, times = np.frombuffer(r.as_py(), np.int32), np.frombuffer(m.as_py(), np.int64)
        base = int(rows[0]) // RANGE * RANGE
        at = rows - base
        total[at] += times[:, None] * np.frombuffer(w.as_py(), np.float16).reshape(len(rows), -1)
        square[at] += times * np.frombuffer(q.as_py(), np.float32)
        met[at] += times
    at = np.flatnonzero(met)
    return _weight_rows([(key[0].as_py(), key[1].as_py(), at + base, met[at], total[at] / met[at, None], square[at] / met[at])])


def train_model(docs: DataFrame, frame: Frame, rate: float = 0.1, rounds: int = ROUNDS) -> Model:
    """The model of (doc_id, text) without the held-out documents. Its tables are bounded by ``MOST_ROWS``."""
    spark = docs.sparkSession
    model = Model(frame.bias1, frame.bias2, frame.n_rows)
    table_bytes = sum(w.nbytes for w in model.w)
    units = max(rounds, math.ceil(TOKEN_BYTES * frame.total / (2 * table_bytes)))
    learnt = docs.where(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 != 0)
    dealt = learnt.withColumn("unit", F.pmod(F.xxhash64("doc_id", "text"), F.lit(units)))
    ranges = TEMPLATES * frame.n_rows // RANGE
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((frame, model))  # at most MOST_ROWS a template
        mine = dealt.where(F.col("unit") % rounds == turn).withColumn("unit", F.floor(F.col("unit") / rounds).cast("long"))
        sent, left = mine.groupBy("unit").applyInArrow(_train(shared, rate), _WEIGHTS), math.ceil(units / rounds)
        while True:  # a tree: a group never takes more than MERGED units' rows of one range
            sent = sent.withColumn("unit", F.floor(F.col("unit") / MERGED).cast("long")).groupBy("part", "unit").applyInArrow(_average, _WEIGHTS)
            left = math.ceil(left / MERGED)
            if left <= 1:
                break
        merged = Model(frame.bias1, frame.bias2, frame.n_rows)
        merged.w, merged.square = [w.copy() for w in model.w], [q.copy() for q in model.square]
        for row in sent.collect():
            rows, factor = np.frombuffer(row["rows"], np.int32), row["part"] // ranges
            merged.w[factor][rows] = np.frombuffer(row["weights"], np.float16).reshape(len(rows), -1)
            merged.square[factor][rows] = np.frombuffer(row["square"], np.float32)
        model = merged
    return model


# --- scoring ------------------------------------------------------------------------------------

def _block_tokens(table: pa.Table):
    tok, first = tokens(Words(table.column("text"), fold=True))
    return tok, first, np.unique(tok)


def _ask(bits):
    def ask(key, table):
        _, _, keys = _block_tokens(table)
        present, cuts = bucket_cuts(keys, 64 - bits)
        return pa.table({"bucket": pa.array(present, pa.int32()), "block": pa.array([key[0].as_py()] * len(present), pa.int32()),
                         "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})
    return ask


def _look_up(key, asked, vocabulary):
    """The counts of each block's words in one bucket."""
    known, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if vocabulary.num_rows:
        known = np.frombuffer(vocabulary.column("keys")[0].as_py(), np.uint64)
        counts = np.frombuffer(vocabulary.column("counts")[0].as_py(), np.int64)
    out = []
    for k in asked.column("keys").to_pylist():
        k = np.frombuffer(k, np.uint64)
        i = np.minimum(np.searchsorted(known, k), max(len(known) - 1, 0))
        out.append((np.where(known[i] == k, counts[i], 0) if len(known) else np.zeros(len(k), np.int64)).tobytes())
    return pa.table({"bucket": asked.column("bucket").cast(pa.int32()), "block": asked.column("block").cast(pa.int32()),
                     "payload": pa.array(out, pa.binary())})


_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _score(shared):
    def score(key, table, replies):
        frame, model = shared.value
        tok, first, keys = _block_tokens(table)
        order = np.argsort(np.asarray(replies.column("bucket")), kind="stable")
        payload = replies.column("payload").to_pylist()
        counts = np.frombuffer(b"".join(payload[i] for i in order), np.int64)[np.searchsorted(keys, tok)]
        smooth = frame.total + 0.1 * (frame.distinct + 1)
        base = np.log10((counts + 0.1) / smooth)
        hashes, cls = features(tok, first), frame.classes(tok)
        log10 = model.class_log_p(hashes, cls) / math.log(10) + frame.word_log10(cls, counts)
        at = first[:-1]
        ids = table.column("doc_id")
        n = len(at)
        add = lambda x: pa.array(np.add.reduceat(x, at) if n else np.zeros(0))  # noqa: E731  every row has a token
        return pa.table({"doc_id": ids, "held_out": pa.array(held_out(ids.to_pylist())), "n_tokens": pa.array(np.diff(first), pa.int64()),
                         "n_known": pa.array(np.add.reduceat((counts > 0).astype(np.int64), at) if n else np.zeros(0, np.int64), pa.int64()),
                         "train_tokens": pa.array([frame.total] * n, pa.int64()), "base_score": add(base), "score": add(log10)})
    return score


def score_documents(docs: DataFrame, rate: float = 0.1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document: the smoothed unigram
    score and the model's log10 probability. Documents with crc32(id) mod 10 = 0 are not learnt from."""
    spark = docs.sparkSession
    blocks, bits = plan_blocks(docs, text)
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    counted = plain.mapInArrow(_count(bits), "bucket int, keys binary, counts binary")
    vocabulary = pin(counted.groupBy("bucket").applyInArrow(
        _vocabulary, "bucket int, keys binary, counts binary, tail_n array<long>, tail_v array<long>, top array<struct<c: long, h: long>>"), "vocabulary")
    frame = Frame(vocabulary)
    model = train_model(plain, frame, rate)
    shared = spark.sparkContext.broadcast((frame, model))  # at most MOST_ROWS a template
    texts = text_blocks(docs, id_col, text, blocks).groupBy("block")
    asked = texts.applyInArrow(_ask(bits), "bucket int, block int, keys binary")
    answered = (asked.groupBy("bucket").cogroup(vocabulary.select("bucket", "keys", "counts").groupBy("bucket"))
                .applyInArrow(_look_up, "bucket int, block int, payload binary"))
    return texts.cogroup(answered.groupBy("block")).applyInArrow(_score(shared), _SCORES)
