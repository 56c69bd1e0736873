"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation.

Entries of the model: the end mark, the most frequent tokens, and ``BUCKETS`` buckets, each for all rarer tokens with
the same last bytes.  The tokens are as many as ``words_for`` says: they grow with the fourth root of the corpus, so the cost of a token grows with its eighth.  Entries, frequent first, are cut into classes of about the square root of their number.  With vectors R for context
entries, Q for predicted entries, K for classes and C for the ``CONTEXT`` places before a token, a context's vector is
h = sum of C[i] * R[entry i places back]; the probability of an entry is that of its class, a softmax over b[k] + h . K[k], times
that within the class, a softmax over b[w] + h . Q[w].  Both normalisers are matrix products over a batch of contexts.  A rarer token's probability is its
bucket's times its smoothed share of the bucket's training tokens, so every token that was counted has a part of its own.

Training covers every training document.  Documents are dealt into logical shards by a hash of id and text; a shard is one pass over its documents in
the order of the hash, whatever the number of partitions.  Shards start from the parameters and step sizes that a sample of about ``WARM`` tokens gave, and
their results are averaged by tokens in a tree.  A corpus below ``WARM`` tokens is one shard that is passed over several times.

Counts of about ``FREQUENT`` most frequent tokens are broadcast; all others are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

#: Frequent tokens for each fourth root of the training tokens.
WORDS = 43
BUCKETS = 1024
#: Last bytes of a rarer token that choose its bucket.
TAIL = 3
DIM = 16
CONTEXT = 4
FREQUENT = 100_000
#: Noise entries and noise classes drawn for each batch; places in a batch, and where the passes are several.
NOISE, CLASS_NOISE = 32, 16
BATCH, SMALL_BATCH = 4096, 512
#: Places of a segment of a text, the unit that is dealt into batches.
SEGMENT = 16
RATE = 0.1
#: Tokens of a shard, shards at most, tokens of the starting sample, tokens gathered before they are learnt from.
SHARD = 2_000_000
SHARDS = 4096
WARM = 1_000_000
CHUNK = 500_000
#: Places scored at once.
PLACES = 32_768
#: Passes over a corpus smaller than WARM bring it to so many tokens, but they are no more than PASSES.
SMALL, PASSES = 4_000_000, 8
#: Shards that one task averages; floats in a slice of the parameters.
FAN = 32
SLICE = 16_384
#: The end mark among tokens; no word is empty.
END_TOKEN = b""
_FLUSH = 300_000
_LEVELS = 16
_CUT = 1 << 20


def tokens_of(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, then the end mark."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END_TOKEN]


def words_for(total: int) -> int:
    """How many tokens have vectors of their own in a model of so many training tokens."""
    return round(WORDS * total**0.25)


def bucket_of(token: bytes, buckets: int = BUCKETS) -> int:
    return zlib.crc32(token[-TAIL:]) % buckets


def sequence(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray]:
    """The entries of several texts, each after CONTEXT end marks, and the places that hold the texts' own entries."""
    pad = np.full(CONTEXT, end, dtype=np.int32)
    seq = np.concatenate([x for w in texts for x in (pad, w)])
    own = np.ones(len(seq), dtype=bool)
    first = np.cumsum([0, *(len(w) + CONTEXT for w in texts[:-1])])
    own[(first[:, None] + np.arange(CONTEXT)).ravel()] = False
    return seq, np.flatnonzero(own)


def hidden(rows: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Context vectors of all places of a row but the first CONTEXT; rows: the places' vectors."""
    n = rows.shape[-2]
    h = rows[..., CONTEXT - 1 : n - 1, :] * c[0]
    for i in range(1, CONTEXT):
        h += rows[..., CONTEXT - 1 - i : n - 1 - i, :] * c[i]
    return h


def class_size(n: int) -> int:
    return max(int(np.ceil(np.sqrt(n))), 1)


def first_params(share: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """[R, Q, K, C, b of entries, b of classes] before training; share: probabilities of the entries, frequent first."""
    rng, n = np.random.default_rng(seed), len(share)
    whole = np.add.reduceat(share, np.arange(0, n, class_size(n)))
    shapes = [(n, DIM), (n, DIM), (len(whole), DIM)]
    return [*(rng.normal(0, 0.1, s).astype("f4") for s in shapes), np.ones((CONTEXT, DIM), "f4"), np.log(share).astype("f4"), np.log(whole).astype("f4")]


def _spread(index: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Sum of rows by index."""
    cell = (index[:, None] * DIM + np.arange(DIM)).ravel()
    return np.bincount(cell, weights=rows.ravel(), minlength=k * DIM).reshape(k, DIM).astype("f4")


class Trainer:
    """Noise-contrastive estimation of entries and classes with per-parameter step sizes."""

    def __init__(self, state: list[np.ndarray], share: np.ndarray, seed: int) -> None:
        """state: parameters and, if training goes on from a sample, what the squares of their gradients summed up to there."""
        self.p = [x.copy() for x in state[:6]]
        self.sums = [x.copy() for x in state[6:]] or [np.full_like(x, 1e-2) for x in self.p]
        self.size = class_size(len(share))
        self.noise = [share, np.add.reduceat(share, np.arange(0, len(share), self.size))]
        self.logs = [np.log(k * x).astype("f4") for k, x in zip((NOISE, CLASS_NOISE), self.noise, strict=True)]
        self.rng = np.random.default_rng(seed)

    def learn(self, texts: list[np.ndarray], end: int, passes: int = 1) -> None:
        """Passes over the texts, cut into segments that are dealt into batches at random."""
        seq, at = sequence(texts, end)
        n = -(-(len(seq) - CONTEXT) // SEGMENT)
        own = np.zeros(CONTEXT + n * SEGMENT, dtype=bool)
        own[at] = True
        seq = np.concatenate((seq, np.zeros(len(own) - len(seq), dtype=seq.dtype)))
        own = own[CONTEXT:].reshape(n, SEGMENT)
        place = np.arange(n)[:, None] * SEGMENT
        some = max((BATCH if passes == 1 else SMALL_BATCH) // SEGMENT, 1)
        for _ in range(passes):
            order = self.rng.permutation(n)
            drawn = [self.rng.choice(len(x), size=(-(-n // some), k), p=x) for k, x in zip((NOISE, CLASS_NOISE), self.noise, strict=True)]
            for i in range(0, n, some):
                held = order[i : i + some]
                if own[held].any():
                    self.step(seq[place[held] + np.arange(CONTEXT + SEGMENT)], own[held], [d[i // some] for d in drawn])

    def step(self, seq: np.ndarray, own: np.ndarray, noise: list[np.ndarray]) -> None:
        """One batch of segments, rows of entries that start with their context; own: the places to predict."""
        r, q, k, c, b, bk = self.p
        rows = r[seq]
        w = seq[:, CONTEXT:][own]
        h = hidden(rows, c)[own]
        gh, grads = 0.0, []
        for vec, bias, pos, neg, logs in ((q, b, w, noise[0], self.logs[0]), (k, bk, w // self.size, noise[1], self.logs[1])):
            vp, vn = vec[pos], vec[neg]
            zp = np.einsum("ij,ij->i", h, vp) + (bias - logs)[pos]
            gp = -1 / (1 + np.exp(np.clip(zp, -30, 30)))
            gn = h @ vn.T
            gn += (bias - logs)[neg]
            np.clip(gn, -30, 30, out=gn)
            np.negative(gn, out=gn)
            np.exp(gn, out=gn)
            gn += 1
            np.reciprocal(gn, out=gn)
            vp *= gp[:, None]
            gh = gh + vp + gn @ vn
            gv = _spread(pos, gp[:, None] * h, len(vec))
            np.add.at(gv, neg, gn.T @ h)
            gb = np.bincount(pos, weights=gp, minlength=len(vec)).astype("f4")
            np.add.at(gb, neg, gn.sum(axis=0))
            grads.append((gv, gb))
        every = np.zeros((*own.shape, DIM), "f4")
        every[own] = gh
        gr, gc = np.zeros_like(rows), np.empty_like(c)
        for i in range(CONTEXT):
            place = slice(CONTEXT - 1 - i, seq.shape[1] - 1 - i)
            gr[:, place] += every * c[i]
            gc[i] = np.einsum("ijk,ijk->k", every, rows[:, place])
        (gq, gb), (gk, gbk) = grads
        scale = np.float32(len(w) ** -0.5)
        for x, g, s in zip(self.p, (_spread(seq.ravel(), gr.reshape(-1, DIM), len(r)), gq, gk, gc, gb, gbk), self.sums, strict=True):
            g *= scale
            s += g * g
            x -= RATE * g / np.sqrt(s)


def _log_sums(h: np.ndarray, vec: np.ndarray, bias: np.ndarray, safe: bool) -> np.ndarray:
    """Logarithms of the sums of exp(bias + h . vec) over the rows of vec."""
    z = h @ vec.T
    if safe:
        return np.log(np.exp(z, out=z) @ np.exp(bias))
    z += bias
    top = z.max(axis=1)
    return np.log(np.exp(z - top[:, None]).sum(axis=1)) + top


def log_probs(params: list[np.ndarray], seq: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural logarithms of the normalised probabilities of the entries at places at of seq, see sequence."""
    r, q, k, c, b, bk = params
    size = class_size(len(r))
    h, w = hidden(r[seq], c)[at - CONTEXT], seq[at]
    of = (w // size).astype(np.int32)
    order = np.argsort(of.astype(np.uint16), kind="stable") if len(k) <= 1 << 16 else np.argsort(of, kind="stable")
    h, w, of = h[order], w[order], of[order]
    # Far from overflow in single precision, else the largest term is taken out.
    longest = lambda x: np.sqrt(np.einsum("ij,ij->i", x, x).max())
    safe = bool(longest(h) * max(longest(q), longest(k)) < 60)
    got = np.einsum("ij,ij->i", h, q[w]) + b[w] + np.einsum("ij,ij->i", h, k[of]) + bk[of] - _log_sums(h, k, bk, safe)
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
    for x, y in zip(cuts, cuts[1:], strict=False):
        low = int(of[x]) * size
        got[x:y] -= _log_sums(h[x:y], q[low : low + size], b[low : low + size], safe)
    out = np.empty(len(w))
    out[order] = got
    return out


def token_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(token, c): occurrences over all texts of df, end marks included; counted within a task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "c"])
            seen.clear()
            return got

        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(tokens_of(text))
                if len(seen) >= _FLUSH:
                    yield out()
        yield out()

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def frequent_tokens(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """About ``most`` most frequent tokens with their counts, frequent first, ties by token.

    Levels are sixteenths of powers of two of the count.  Whole levels are taken while they fit; of the next one the tokens with the smallest hashes, as
    many as have room on average.  Only the levels' sizes and the tokens wanted reach the driver, whatever the number of partitions.
    """
    level = F.floor(F.log2("c") * _LEVELS)
    sizes = sorted(((r["level"], r["n"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()), reverse=True)
    room, wanted = most, F.lit(False)
    for at, size in sizes:
        if size > room:
            wanted = wanted | ((level == at) & (F.pmod(F.xxhash64("token"), F.lit(_CUT)) < room * _CUT // size))
            break
        room, wanted = room - size, level >= at
    got = counts.where(wanted).toArrow()
    return sorted(zip(got["token"].to_pylist(), got["c"].to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))


def _coded(text: str | None, table: dict[bytes, int], buckets: list[int]) -> np.ndarray:
    """The text's entries."""
    get = table.get
    return np.array([buckets[bucket_of(t, len(buckets))] if (i := get(t)) is None else i for t in tokens_of(text)], dtype=np.int32)


def _trained(rows: DataFrame, sent, shards: int, passes: int, most: int | None = None) -> DataFrame:
    """(shard, weight, slice, part): the parameters each shard ends with, in slices; rows: (h, text).

    A shard that stops after ``most`` tokens adds its sums of squares.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, buckets = sent.value[:2]
        for b in batches:
            coded = [_coded(t, table, buckets).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(coded, pa.binary())], ["h", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, share, start, end = sent.value
        shard, trainer, total, size, held = None, None, 0, 0, []

        def learn() -> None:
            nonlocal size
            trainer.learn(held, end, passes)
            held.clear()
            size = 0

        def out() -> pa.RecordBatch:
            if held:
                learn()
            flat = np.concatenate([x.ravel() for x in trainer.p + (trainer.sums if most else [])]).astype("<f4")
            parts = [flat[i : i + SLICE].tobytes() for i in range(0, len(flat), SLICE)]
            n = len(parts)
            return pa.RecordBatch.from_arrays([pa.array([shard] * n, pa.int64()), pa.array([float(total)] * n), pa.array(range(n), pa.int32()), pa.array(parts, pa.binary())], ["shard", "weight", "slice", "part"])

        for b in batches:
            for s, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if s != shard:
                    if trainer is not None:
                        yield out()
                    shard, trainer, total = s, Trainer(start, share, 11), 0
                if most is not None and total >= most:
                    continue
                held.append(np.frombuffer(blob, dtype=np.int32))
                total, size = total + len(held[-1]), size + len(held[-1])
                if size >= CHUNK and passes == 1:
                    learn()
        if trainer is not None:
            yield out()

    coded = rows.mapInArrow(code, "h long, w binary").withColumn("shard", F.pmod("h", F.lit(shards)))
    dealt = coded.repartition(min(shards, SHARDS), "shard").sortWithinPartitions("shard", "h").select("shard", "w")
    return dealt.mapInArrow(run, "shard long, weight double, slice int, part binary")


def _averaged(parts: DataFrame, shards: int, shapes: list[tuple[int, ...]]) -> list[np.ndarray] | None:
    """The mean of the shards' parameters by weight: FAN shards at a time, in their order, until one is left."""

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, acc, weight = None, 0.0, 0.0

        def out() -> pa.RecordBatch:
            part = (acc / max(weight, 1.0)).astype("<f4").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([weight]), pa.array([key[1]], pa.int32()), pa.array([part], pa.binary())], ["shard", "weight", "slice", "part"])

        for b in batches:
            for s, w, n, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (s // FAN, n) != key:
                    if key is not None:
                        yield out()
                    key, acc, weight = (s // FAN, n), 0.0, 0.0
                acc, weight = acc + np.frombuffer(part, "<f4").astype("f8") * w, weight + w
        if key is not None:
            yield out()

    while True:
        group = F.floor(F.col("shard") / FAN)
        parts = parts.repartition(group, "slice").sortWithinPartitions("slice", "shard").mapInArrow(mean, "shard long, weight double, slice int, part binary")
        shards = -(-shards // FAN)
        if shards <= 1:
            break
        parts = written(parts)
    got = sorted(parts.collect(), key=lambda r: r["slice"])
    if not got:
        return None
    flat = np.concatenate([np.frombuffer(r["part"], "<f4") for r in got])
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    return [x.reshape(s).copy() for x, s in zip(np.split(flat, cuts), shapes, strict=True)]


def train(rows: DataFrame, tokens: int, table: dict[bytes, int], buckets: list[int], share: np.ndarray, end: int) -> list[np.ndarray]:
    """Parameters after training on all of rows (h, text), which hold so many tokens."""
    context = rows.sparkSession.sparkContext
    start = first_params(share)
    shapes = [x.shape for x in start]
    if tokens <= WARM:
        sent = context.broadcast((table, buckets, share, start, end))
        return _averaged(_trained(rows, sent, 1, min(PASSES, max(1, SMALL // max(tokens, 1)))), 1, shapes) or start
    every = -(-tokens // WARM)
    sample = rows.where(F.pmod(F.xxhash64("h"), F.lit(every)) == 0)
    sent = context.broadcast((table, buckets, share, start, end))
    start = _averaged(_trained(sample, sent, 1, min(PASSES, SMALL // WARM), 2 * WARM), 1, shapes * 2) or start
    shards = min(-(-tokens // SHARD), SHARDS)
    sent = context.broadcast((table, buckets, share, start, end))
    return _averaged(written(_trained(rows, sent, shards, 1)), shards, shapes) or start[:6]


def fit(rows: DataFrame, counts: DataFrame, total: int, distinct: int, words: int, buckets: int, frequent: int) -> dict:
    """What scoring needs, as plain arrays and dicts; rows: training rows (h, text), counts: their tokens."""
    top = frequent_tokens(counts, frequent)
    chosen = [(t, c) for t, c in top if t != END_TOKEN][:words]
    ends = counts.where(F.col("token") == F.lit(END_TOKEN)).agg(F.sum("c")).first()[0] or 0
    in_bucket = F.crc32(F.substring("token", -TAIL, TAIL)) % buckets
    sums, kinds = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
    for r in counts.where(F.length("token") > 0).groupBy(in_bucket.alias("bucket")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        sums[r["bucket"]], kinds[r["bucket"]] = r["c"], r["n"]
    for t, c in chosen:
        sums[bucket_of(t, buckets)] -= c
        kinds[bucket_of(t, buckets)] -= 1
    known = np.concatenate(([ends], sums, [c for _, c in chosen])).astype("f8")
    order = np.argsort(-known, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    share = (known[order] + 0.5) / (known + 0.5).sum()
    table = {END_TOKEN: int(place[0])} | {t: int(place[1 + buckets + i]) for i, (t, _) in enumerate(chosen)}
    at = place[1 : 1 + buckets].tolist()
    params = train(rows, total, table, at, share, int(place[0]))
    counted = dict(top) | {END_TOKEN: int(ends)}
    return {
        "params": params, "end": int(place[0]), "buckets": at, "rest": np.log10(sums + kinds + 1.0),
        "tokens": list(counted), "counts": np.array(list(counted.values()), dtype=np.int64), "entries": np.array([table.get(t, -1) for t in counted], dtype=np.int32),
    }


def score_texts(df: DataFrame, train_when, id_col: str = "doc_id", text_col: str = "text", words: int | None = None, buckets: int = BUCKETS, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of df: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    train_when: which rows teach; words: frequent tokens of the model, as of words_for where it is None.  Null texts are empty: they hold only the end mark.  Null ids and repeated rows stay, other columns
    take no part.  With nothing to learn from, N and V are 0 and the model is nearly uniform over its entries.  Results don't depend on the
    number of partitions, but for the last digits of sums.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), train_when.alias("teaches"))
    counts = written(token_counts(rows.where("teaches"), "text"))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words = words_for(total) if words is None else words
    model = fit(rows.where("teaches").select(F.xxhash64("id", "text").alias("h"), "text"), counts, total, distinct, words, buckets, max(frequent, words))
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        known, buckets, end, params, rest = {t: i for i, t in enumerate(m["tokens"])}.get, np.array(m["buckets"], dtype=np.int32), m["end"], m["params"], m["rest"]
        # Of the known tokens and, last, for all others.
        entries, counts = np.append(m["entries"], np.int32(-1)), np.append(m["counts"], 0)
        logs_of, seen = np.log10(counts + 1.0), counts > 0
        part, n = TaskContext.get().partitionId() << 36, 0
        names = ("row", "n_tokens", "n_known", "logs", "rare_logs", "lm", "rare")
        kinds = {"row": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "rare": pa.list_(pa.binary())}
        for b in batches:
            got: dict[str, list] = {k: [] for k in names}
            held: list[np.ndarray] = []

            def model_scores(held=held, got=got) -> None:
                """Scores of the texts gathered, a bounded number of tokens at a time."""
                if not held:
                    return
                seq, at = sequence(held, end)
                logs = []
                for i in range(0, len(at), PLACES):
                    some = at[i : i + PLACES]
                    first = some[0] - CONTEXT
                    logs.append(log_probs(params, seq[first : some[-1] + 1], some - first))
                first = np.cumsum([0, *(len(x) for x in held[:-1])])
                got["lm"] += (np.add.reduceat(np.concatenate(logs), first) / np.log(10)).tolist()
                held.clear()

            size = 0
            for text in b.column(1).to_pylist():
                tokens = tokens_of(text)
                k = np.array([known(t, -1) for t in tokens], dtype=np.int32)
                w, logs, spare, gone = entries[k], logs_of[k], 0.0, []
                if (few := np.flatnonzero(w < 0)).size:
                    in_bucket = np.array([bucket_of(tokens[i], len(buckets)) for i in few.tolist()])
                    w[few] = buckets[in_bucket]
                    spare = float(logs[few].sum() - rest[in_bucket].sum())
                    gone = [tokens[i] for i in np.flatnonzero(k < 0).tolist()]
                held.append(w)
                got["row"].append(part + n)
                n += 1
                got["n_tokens"].append(len(tokens))
                got["n_known"].append(int(seen[k].sum()))
                got["logs"].append(float(logs.sum()))
                got["rare_logs"].append(spare)
                got["rare"].append(gone)
                size += len(w)
                if size >= PLACES:
                    model_scores()
                    size = 0
            model_scores()
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(got[k], kinds.get(k, pa.float64())) for k in names)], ["id", *names])

    kind = df.schema[id_col].dataType.simpleString()
    scored = written(rows.select("id", "text").mapInArrow(run, f"id {kind}, row long, n_tokens long, n_known long, logs double, rare_logs double, lm double, rare array<binary>"))
    late = scored.select("row", F.explode("rare").alias("token")).join(counts, "token").groupBy("row").agg(F.count("*").alias("more_known"), F.sum(F.log10(F.col("c") + 1.0)).alias("more_logs"))
    out = scored.drop("rare").join(late, "row", "left").fillna({"more_known": 0, "more_logs": 0.0})
    base = float(np.log10(total + distinct + 1))
    return out.select(
        F.col("id").alias("doc_id"), "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("lm") + F.col("rare_logs") + F.col("more_logs")).alias("score"),
    )
