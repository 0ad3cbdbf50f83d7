"""Scores of texts under a language model: causal self-attention over subwords, joined with the corpus' word counts.

The attention model works on subword ids (longest match in a public vocabulary). One causal attention layer weighs a fixed
number of experts, each a distribution over all subwords, so what it predicts are subwords themselves. It is trained in
numpy on all windows of all training documents, so that every subword of theirs is predicted once a pass: stretches of
windows are dealt by content and doc_id to shards of like size, each task descends over its shards, and after every pass the
parameters of all shards are averaged and the experts taken anew from the subwords that each was held responsible for,
smoothed with the counts of the whole corpus. Sums over shards are sums of integers, so the model doesn't depend on how the
table is cut in files.

Documents are read in windows that overlap by `CONTEXT` positions; each subword is scored in the one window in which it is
not context. The attention model gives the probability of the first subword of every word. The rest of the word follows from
the corpus' counts of words that begin with this subword, each discounted by a constant, and what that leaves goes to the
attention model's spelling of the word. This is mixed with the word's share of the smoothed counts, which gives every unknown
word the same, whatever their number.

The counts of frequent words, a table of bounded size, go to every task; the other words of a document are joined with
their counts by a shuffle, and as they are rare no key of that shuffle is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.bpe import read_ranks
from shoplens.llm.common import text_or_empty, worker_state
from shoplens.session import durable

# Width of the model, experts, embedding rows of single subwords and those that the others share, window, overlap.
WIDTH, EXPERTS, SINGLE, SHARED, WINDOW, CONTEXT = 16, 32, 3072, 1024, 32, 8
OWN = SINGLE + SHARED
# Windows that travel as one row, those of a shard and of a step; passes, or more where a shard is so small that these give
# fewer steps.
STRETCH, SHARD, BATCH, PASSES, LEAST_STEPS = 16, 153_600, 128, 1, 300
# Stretches from which the experts get their first form; subwords that the corpus' counts stand for in each expert.
FIRST_STRETCHES, PRIOR = 512, 800
# Sums over shards are taken of multiples of this.
GRAIN = 2.0 ** -24
# Frequent words in the table that goes to the tasks; what every known word's count gives up for the spelling of others; the
# weight of the smoothed counts.
FREQUENT, DISCOUNT, COUNT_SHARE = 150_000, 0.75, 0.5
HELD_OUT_FOLD, FOLDS = 1, 5
# Longest subword in bytes.
LONGEST = 8


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT_FOLD, F.lit(False))


def words_of(text: str) -> list[bytes]:
    """Words with A-Z in lower case, then the end, an empty one."""
    w = text.encode().lower().split()
    w.append(b"")
    return w


# ---- subwords


class Subwords:
    """Longest matches of a vocabulary in words with the blank before them; the end has the id after the last.

    Tokens of at most 8 bytes are taken, so that a token is a number; all words of a batch are cut side by side, by
    binary search in the sorted tokens of each length. A table of the tokens' hashes spares it for most of what is none.
    """

    MIX, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - 17)

    def __init__(self, tokens: list[bytes]):
        self.end = len(tokens)
        self.of_length = []
        for size in range(1, LONGEST + 1):
            found = [(int.from_bytes(t, "little"), i) for i, t in enumerate(tokens) if len(t) == size]
            keys, ids = (np.array([f[k] for f in sorted(found)], kind) for k, kind in ((0, np.uint64), (1, np.int32)))
            hashed = np.zeros(1 << 17, bool)
            hashed[keys * self.MIX >> self.SHIFT] = True
            self.of_length.append((keys, ids, np.uint64((1 << 8 * size) - 1), hashed))

    def cut(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of subwords of each word, and all subwords."""
        text = np.frombuffer(b" ".join([b"", *words, bytes(LONGEST)]), np.uint8)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        at = stops - np.fromiter(map(len, words), np.int64, len(words)) - 1
        sizes = np.zeros(len(words), np.int64)
        ended = stops - at == 1
        active, rounds = np.flatnonzero(~ended), []
        at = at[active]
        while len(active):
            chunk = np.ascontiguousarray(text[at[:, None] + np.arange(LONGEST)]).view("<u8").ravel()
            room = stops[active] - at
            ids, taken = np.full(len(active), -1, np.int32), np.zeros(len(active), np.int64)
            open_ = np.arange(len(active))
            for size in range(LONGEST, 0, -1):
                keys, names, mask, hashed = self.of_length[size - 1]
                fits = open_[room[open_] >= size]
                if not len(fits) or not len(keys):
                    continue
                wanted = chunk[fits] & mask
                likely = np.flatnonzero(hashed[wanted * self.MIX >> self.SHIFT])
                fits, wanted = fits[likely], wanted[likely]
                place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = keys[place] == wanted
                ids[fits[hit]], taken[fits[hit]] = names[place[hit]], size
                open_ = open_[ids[open_] < 0]
                if not len(open_):
                    break
            rounds.append((active, ids))
            sizes[active] += 1
            at = at + taken
            going = at < stops[active]
            active, at = active[going], at[going]
        sizes[ended] = 1
        first = np.cumsum(sizes) - sizes
        flat = np.full(int(sizes.sum()), self.end, np.int32)
        for k, (which, ids) in enumerate(rounds):
            flat[first[which] + k] = ids
        return sizes, flat


def stream(texts: list[str], subwords: Subwords) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch: codes of all words, the distinct words, words of each text, subwords of each word, all subwords."""
    return stream_words([words_of(t) for t in texts], subwords)


def stream_words(per_text: list[list[bytes]], subwords: Subwords) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """As `stream`, of texts that are cut in words."""
    words = [w for ws in per_text for w in ws]
    distinct = list(dict.fromkeys(words))
    code = dict(zip(distinct, range(len(distinct))))
    codes = np.fromiter(map(code.__getitem__, words), np.int64, len(words))
    sizes, pool = subwords.cut(distinct)
    first = np.cumsum(sizes) - sizes
    counts = sizes[codes]
    starts = np.cumsum(counts) - counts
    flat = pool[np.arange(counts.sum()) + np.repeat(first[codes] - starts, counts)]
    return codes, distinct, np.fromiter(map(len, per_text), np.int64, len(per_text)), counts, flat


# ---- the attention model


def windows(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (-1: none), targets and their places in `ids`, for texts of the given numbers of subwords.

    The input of a place is the subword before it, the end for a text's first. A window has CONTEXT places that an
    earlier window scores and WINDOW - CONTEXT of its own; the place is -1 beyond the text.
    """
    step = WINDOW - CONTEXT
    many = -(-sizes // step)
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), many)
    number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = (begin[text] + number * step)[:, None] + np.arange(-CONTEXT, step)[None, :]
    low, high = begin[text][:, None], (begin + sizes)[text][:, None]
    real = (at >= low) & (at < high)
    inputs = np.where(at == low, end, ids[np.clip(at - 1, 0, max(0, len(ids) - 1))])
    return np.where(real, inputs, -1), np.where(real, ids[np.clip(at, 0, len(ids) - 1)], -1), np.where(real, at, -1)[:, CONTEXT:]


def add_rows(total: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to the row of `total` that its key names."""
    by = np.argsort(keys.astype(np.uint16) if len(total) <= 1 << 16 else keys, kind="stable")
    keys = keys[by]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    total[keys[first]] += np.add.reduceat(rows[by], first)


class Attention:
    """One layer of causal self-attention with a residual, whose output weighs the experts.

    `own` is the embedding row of each id, `experts` the probability of each id (row) under each expert (column).
    """

    NAMES = ("embed", "place", "wq", "wk", "wv", "wo", "out", "bias")

    def __init__(self, own: np.ndarray, experts: np.ndarray, parameters: dict[str, np.ndarray]):
        self.own, self.experts, self.p = own, experts, parameters
        self.causal = np.tril(np.ones((WINDOW, WINDOW), np.float32))

    @classmethod
    def fresh(cls, own: np.ndarray, experts: np.ndarray, share: np.ndarray) -> Attention:
        """Random weights; the bias is the log share of each expert."""
        rng = np.random.default_rng(11)
        shapes = {"embed": (OWN, WIDTH), "place": (WINDOW, WIDTH), "wq": (WIDTH, WIDTH), "wk": (WIDTH, WIDTH), "wv": (WIDTH, WIDTH),
                  "wo": (WIDTH, WIDTH), "out": (WIDTH, EXPERTS)}
        p = {n: (rng.standard_normal(s) * (0.3 if n in ("embed", "place") else 1 / math.sqrt(WIDTH))).astype(np.float32)
             for n, s in shapes.items()}
        return cls(own, experts, p | {"bias": np.log(share.clip(1e-9)).astype(np.float32)})

    def folded(self) -> tuple[np.ndarray, np.ndarray]:
        """Queries with keys, and values with what is made of them, as no step is between them."""
        p = self.p
        return p["wq"] @ p["wk"].T * np.float32(1 / math.sqrt(WIDTH)), p["wv"] @ p["wo"]

    def tables(self) -> None:
        """Embedding rows and places with a column that counts; row -1 counts nothing."""
        embed, place = self.p["embed"], self.p["place"]
        self.rows = np.concatenate([np.concatenate([embed, np.ones((len(embed), 1), np.float32)], axis=1), np.zeros((1, WIDTH + 1), np.float32)])
        self.places = np.concatenate([place, np.zeros((WINDOW, 1), np.float32)], axis=1)
        self.see, self.tell = self.folded()

    def log_probabilities(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Of the targets beyond the context, with batched masked attention; whatever for places without one."""
        x = self.rows[np.where(inputs < 0, -1, self.own[inputs])]
        x += self.places
        x[inputs < 0] = 0
        mine = x[:, CONTEXT:, :WIDTH].reshape(-1, WIDTH)
        attention = np.matmul((mine @ self.see).reshape(len(x), -1, WIDTH), x[:, :, :WIDTH].transpose(0, 2, 1))
        np.exp(np.clip(attention, -30, 30, out=attention), out=attention)
        attention *= self.causal[CONTEXT:]
        mixed = np.matmul(attention, x).reshape(-1, WIDTH + 1)
        h = mine + (mixed[:, :WIDTH] / np.maximum(mixed[:, WIDTH:], 1e-20)) @ self.tell
        weights = h @ self.p["out"]
        weights += self.p["bias"]
        np.exp(np.clip(weights, -60, 60, out=weights), out=weights)
        told = np.einsum("ij,ij->i", weights, self.experts[targets[:, CONTEXT:].ravel()])
        return np.log(np.maximum(told / np.einsum("ij->i", weights), 1e-30)).reshape(len(targets), -1)

    def gradients(self, inputs: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Mean loss of the targets beyond the context, its gradients, and each expert's responsibility for each target."""
        p, scale = self.p, np.float32(1 / math.sqrt(WIDTH))
        see, tell = self.folded()
        there = (inputs >= 0).astype(np.float32)
        rows = self.own[np.maximum(inputs, 0)]
        x = p["embed"][rows]
        x += p["place"]
        x *= there[:, :, None]
        deep = lambda y: y.reshape(len(x), -1, WIDTH)
        mine, turned = x[:, CONTEXT:].reshape(-1, WIDTH), x.transpose(0, 2, 1)
        asked = mine @ see
        a = deep(asked) @ turned
        np.exp(np.clip(a, -30, 30, out=a), out=a)
        a *= self.causal[CONTEXT:]
        a *= there[:, None, :]
        a /= np.maximum(np.einsum("bij->bi", a), 1e-20)[:, :, None]
        o = (a @ x).reshape(-1, WIDTH)
        h = mine + o @ tell
        weight = h @ p["out"]
        weight += p["bias"]
        np.exp(np.clip(weight, -60, 60, out=weight), out=weight)
        weight /= np.einsum("ij->i", weight)[:, None]
        goal = targets[:, CONTEXT:].ravel()
        counted = (goal >= 0).astype(np.float32)
        held = weight * self.experts[np.maximum(goal, 0)]
        told = np.maximum(np.einsum("ij->i", held), 1e-30)
        held *= (counted / told)[:, None]
        n = max(1.0, float(counted.sum()))
        loss = float(-(np.log(told) * counted).sum() / n)
        weight *= counted[:, None]
        weight -= held
        weight /= np.float32(n)
        d = weight
        g = {"out": h.T @ d, "bias": np.ones(len(d), np.float32) @ d}
        dh = d @ p["out"].T
        dtell = o.T @ dh
        g |= {"wv": dtell @ p["wo"].T, "wo": p["wv"].T @ dtell}
        do = dh @ tell.T
        ds = deep(do) @ turned
        ds -= np.einsum("bij,bij->bi", ds, a)[:, :, None]
        ds *= a
        dasked = (ds @ x).reshape(-1, WIDTH)
        dsee = mine.T @ dasked * scale
        g |= {"wq": dsee @ p["wk"], "wk": dsee.T @ p["wq"]}
        dx = a.transpose(0, 2, 1) @ deep(do)
        dx += ds.transpose(0, 2, 1) @ deep(asked)
        dx[:, CONTEXT:] += deep(dh + dasked @ see.T)
        dx *= there[:, :, None]
        g["place"] = dx.sum(axis=0)
        g["embed"] = np.zeros_like(p["embed"])
        add_rows(g["embed"], rows.ravel(), dx.reshape(-1, WIDTH))
        return loss, g, held.reshape(len(targets), -1, EXPERTS)

    def descend(self, inputs: np.ndarray, targets: np.ndarray, rate: float) -> tuple[float, np.ndarray]:
        """One pass of Adam over windows in their order; the mean loss, and by id the experts' responsibilities for it."""
        m, v = ({n: np.zeros_like(x) for n, x in self.p.items()} for _ in range(2))
        held, losses = np.zeros(self.experts.shape, np.float32), []
        for step, at in enumerate(range(0, len(inputs), BATCH), 1):
            goal = targets[at:at + BATCH]
            loss, g, share = self.gradients(inputs[at:at + BATCH], goal)
            losses.append(loss)
            # Places without a target have no responsibilities.
            add_rows(held, np.maximum(goal[:, CONTEXT:].ravel(), 0), share.reshape(-1, EXPERTS))
            for n in self.NAMES:
                m[n] = 0.9 * m[n] + 0.1 * g[n]
                v[n] = 0.99 * v[n] + 0.01 * g[n] ** 2
                self.p[n] = self.p[n] - (rate * min(1, step / 10) * (m[n] / (1 - 0.9 ** step)) / (np.sqrt(v[n] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return float(np.mean(losses)) if losses else 0.0, held

    def score(self, ids: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
        """Log probability of every subword of texts of the given sizes."""
        out = np.zeros(len(ids), np.float32)
        inputs, targets, places = windows(ids, sizes, end)
        for at in range(0, len(inputs), 256):
            got = self.log_probabilities(inputs[at:at + 256], targets[at:at + 256])
            place = places[at:at + 256]
            out[place[place >= 0]] = got[place >= 0]
        return out


def embedding_rows(counts: np.ndarray) -> np.ndarray:
    """The most frequent ids have rows of their own, the others share rows by their number."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    own = SINGLE + np.arange(len(counts)) % SHARED
    own[order[:SINGLE]] = np.arange(min(SINGLE, len(counts)))
    return own


def first_experts(counts: np.ndarray, tokens: list[bytes], inputs: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First form of the experts, each mostly of ids that follow and are followed by like ones, by k-means; their shares."""
    size, own = len(counts), embedding_rows(counts)
    order = np.lexsort((np.arange(size), -counts))[:SINGLE]
    opening = np.array([t[:1] == b" " for t in tokens] + [True] * (size - len(tokens)))
    near = np.zeros((OWN, 512), np.float32)
    seen = (inputs >= 0) & (targets >= 0)
    a, b = own[inputs[seen]], own[targets[seen]]
    np.add.at(near, (a, np.minimum(b, 255)), 1)
    np.add.at(near, (b, 256 + np.minimum(a, 255)), 1)
    shape = np.sqrt(near[:len(order)] / np.maximum(near[:len(order)].sum(axis=1, keepdims=True), 1))
    shape = np.concatenate([shape, 0.5 * opening[order, None]], axis=1)
    centres = shape[:: max(1, len(shape) // EXPERTS)][:EXPERTS].copy()
    for _ in range(12):
        nearest = ((centres ** 2).sum(axis=1)[None, :] - 2 * shape @ centres.T).argmin(axis=1)
        for k in range(len(centres)):
            if (nearest == k).any():
                centres[k] = shape[nearest == k].mean(axis=0)
    held = np.full((size, EXPERTS), 0.1 / EXPERTS)
    held[order, nearest] += 0.9
    return taken(held * counts[:, None], counts)


def taken(held: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Experts from their responsibilities for each id, smoothed with the corpus' counts, and the experts' shares."""
    total = held.sum(axis=0)
    prior = (counts + 0.5) / (counts + 0.5).sum()
    weight = PRIOR
    experts = (held + weight * prior[:, None]) / (total + weight)
    return experts.astype(np.float32), (total + weight) / (total + weight).sum()


# ---- jobs


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the column `text`, the end included; batches are counted before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoded = pa.array([w for t in batch.column("text").to_pylist() for w in words_of(t)], pa.binary()).dictionary_encode()
            n = np.bincount(encoded.indices.to_numpy(zero_copy_only=False), minlength=len(encoded.dictionary))
            yield pa.RecordBatch.from_arrays([encoded.dictionary, pa.array(n)], ["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame) -> dict[bytes, int]:
    """At most FREQUENT words, those with the largest counts, and the end; all with one count or none."""
    level = F.floor(F.log2("n") * 16)
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    least, many = float("inf"), 0
    for row in levels:
        many += row["n"]
        if many > FREQUENT:
            break
        least = row["level"]
    chosen = counts.where((level >= least) | (F.length("word") == 0)) if least < float("inf") else counts.where(F.length("word") == 0)
    return {bytes(r["word"]): r["n"] for r in chosen.collect()}


def _subwords(tokens: list[bytes]) -> Subwords:
    state = worker_state("subwords")
    if state.get("tokens") != tokens:
        state.clear()
        state |= {"tokens": tokens, "cutter": Subwords(tokens)}
    return state["cutter"]


def subword_counts(counts: DataFrame, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By id of subwords and the end: how often it stands in words, how often it begins one, and how many different ones."""
    shared = counts.sparkSession.sparkContext.broadcast(tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(shared.value) + 1), np.int64)
        for batch in batches:
            sizes, flat = _subwords(shared.value).cut(batch.column("word").to_pylist())
            n, size = batch.column("n").to_numpy(), total.shape[1]
            first = flat[np.cumsum(sizes) - sizes]
            total[0] += np.bincount(flat, np.repeat(n, sizes), size).astype(np.int64)
            total[1] += np.bincount(first, n, size).astype(np.int64)
            total[2] += np.bincount(first, minlength=size)
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seen, *total[:, seen])], ["id", "n", "begun", "words"])

    rows = counts.mapInArrow(count, "id long, n long, begun long, words long").groupBy("id").agg(*[F.sum(c) for c in ("n", "begun", "words")])
    out = np.zeros((3, len(tokens) + 1), np.int64)
    for i, *sums in rows.collect():
        out[:, i] = sums
    return tuple(out)


def training_windows(docs: DataFrame, tokens: list[bytes]) -> DataFrame:
    """(doc_id, stretch): the subwords of each text, cut in stretches of STRETCH windows.

    Before its own subwords, a stretch has the input of its first target and the context of its first window.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokens)
    whole, lead = STRETCH * (WINDOW - CONTEXT), CONTEXT + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cutter = _subwords(shared.value)
            _, _, per_text, per_word, flat = stream(batch.column("text").to_pylist(), cutter)
            if not len(per_text):
                continue
            sizes = np.add.reduceat(per_word, np.cumsum(per_text) - per_text)
            stops = np.cumsum(sizes)
            kind = _stretch_type(cutter.end)
            before = np.array([cutter.end + 1] * CONTEXT + [cutter.end], kind)
            flat, which, out = flat.astype(kind), [], []
            for k, (low, high) in enumerate(zip((stops - sizes).tolist(), stops.tolist())):
                text = np.concatenate([before, flat[low:high]])
                for at in range(0, high - low, whole):
                    out.append(text[at:at + whole + lead].tobytes())
                    which.append(k)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(which)), pa.array(out, pa.binary())], ["doc_id", "stretch"])

    return docs.mapInArrow(cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, stretch binary")


def _stretch_type(end: int) -> str:
    """The end and the number after it, which stands for no subword, must fit."""
    return "<u2" if end + 1 < 1 << 16 else "<u4"


def unpack(stretches: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets of all windows of the stretches, as of `windows`."""
    step = WINDOW - CONTEXT
    flat = np.frombuffer(b"".join(stretches), _stretch_type(end)).astype(np.int32)
    flat[flat > end] = -1
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches)) // np.dtype(_stretch_type(end)).itemsize
    many = -(-(sizes - CONTEXT - 1) // step)
    stops = np.cumsum(sizes)
    number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = (np.repeat(stops - sizes, many) + number * step)[:, None] + np.arange(WINDOW + 1)[None, :]
    ids = np.where(at < np.repeat(stops, many)[:, None], flat[np.minimum(at, max(0, len(flat) - 1))], np.int32(-1))
    inputs, targets = ids[:, :-1], ids[:, 1:]
    real = (inputs >= 0) & (targets >= 0)
    return np.where(real, inputs, -1), np.where(real, targets, -1)


def summed(parts: DataFrame) -> tuple[list[int], np.ndarray]:
    """Sums of packed 64-bit integers by key, added up by tasks in rounds; what reaches the driver has a row for each key."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, packed in zip(batch.column("key").to_pylist(), batch.column("sums").to_pylist()):
                values = np.frombuffer(packed, "<i8")
                total[key] = total[key] + values if key in total else values
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["key", "sums"])

    whole = parts.repartition(parts.sparkSession.sparkContext.defaultParallelism, "key").mapInArrow(add, "key long, sums binary").toArrow()
    keys = whole.column("key").to_pylist()
    order = sorted(range(len(keys)), key=keys.__getitem__)
    packed = whole.column("sums").to_pylist()
    return [keys[k] for k in order], [np.frombuffer(packed[k], "<i8") for k in order]


def fit(docs: DataFrame, ids: np.ndarray, tokens: list[bytes]) -> Attention:
    """The model for training texts and the counts of their subwords."""
    spark, end = docs.sparkSession, len(tokens)
    # About as many windows; the last of a text may be shorter.
    n = -(-int(ids.sum()) // (WINDOW - CONTEXT))
    shards = max(1, n // SHARD)
    draw = F.xxhash64("stretch", F.col("doc_id").cast("string"))
    # Only texts below a bound, so that no task has more to tell than its part of the first stretches.
    share = min(1.0, 8 * FIRST_STRETCHES * STRETCH / max(1, n))
    few = docs.where(F.xxhash64("text", F.col("doc_id").cast("string")) <= int(-(1 << 63) + share * ((1 << 64) - 1))) if share < 1 else docs
    first = training_windows(few, tokens).withColumn("draw", draw).orderBy("draw", "stretch").limit(FIRST_STRETCHES)
    experts, share = first_experts(ids, tokens, *unpack([bytes(r["stretch"]) for r in first.collect()], end))
    model = Attention.fresh(embedding_rows(ids), experts, share)
    if not n:
        return model
    passes = max(PASSES, -(-LEAST_STEPS * BATCH * shards // n))
    dealt = training_windows(docs, tokens).withColumn("draw", draw).withColumn("shard", F.pmod("draw", F.lit(shards))) \
        .repartition(min(shards, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard") \
        .sortWithinPartitions("shard", "draw", "stretch").select("shard", "stretch")
    if passes > 1:
        dealt = durable(dealt)
    names = Attention.NAMES
    for turn in range(passes):
        shared = spark.sparkContext.broadcast((model.own, model.experts, model.p))
        rate = 0.02 * (1 - 0.85 * turn / max(1, passes - 1))

        def step(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate) -> Iterator[pa.RecordBatch]:
            own, experts, parameters = shared.value
            whole = lambda x: np.rint(x.astype(np.float64) / GRAIN).astype("<i8")
            total, sums, many = np.zeros(experts.shape, "<i8"), [np.zeros(parameters[k].size, "<i8") for k in names], 0

            def add(rows: list[bytes]) -> int:
                mine = Attention(own, experts, {k: x.copy() for k, x in parameters.items()})
                inputs, targets = unpack(rows, end)
                # Windows of a text are set apart.
                order = np.random.default_rng(13).permutation(len(inputs))
                np.add(total, whole(mine.descend(inputs[order], targets[order], rate)[1]), out=total)
                for k, x in zip(names, sums):
                    x += whole(mine.p[k].ravel()) * len(inputs)
                return len(inputs)

            held, size, shard = [], 0, None
            for batch in batches:
                for key, stretch in zip(batch.column("shard").to_pylist(), batch.column("stretch").to_pylist()):
                    # Equal rows share a shard, however many: it is taken in parts that memory holds.
                    if held and (key != shard or size > 4 * SHARD * (WINDOW - CONTEXT) * 2):
                        many += add(held)
                        held, size = [], 0
                    shard = key
                    held.append(stretch)
                    size += len(stretch)
            if held:
                many += add(held)
            if many:
                met = np.flatnonzero(total.any(axis=1))
                keys = [*met.tolist(), *(-1 - k for k in range(len(names) + 1))]
                rows = [*total[met], *sums, np.array([many], "<i8")]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([x.tobytes() for x in rows], pa.binary())], ["key", "sums"])

        keys, sums = summed(dealt.mapInArrow(step, "key long, sums binary"))
        shared.unpersist()
        found = dict(zip(keys, sums))
        held = np.zeros((len(ids), EXPERTS))
        met = [k for k in keys if k >= 0]
        held[met] = np.array([found[k] for k in met]) * GRAIN
        model.experts, _ = taken(held, ids)
        many = int(found[-1 - len(names)][0])
        model.p = {name: (found[-1 - k] * GRAIN / many).reshape(model.p[name].shape).astype(np.float32) for k, name in enumerate(names)}
    return model


def score(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32 of doc_id (as text; null is never held out) leaves another remainder than 1 by 5,
    scores all. A null or empty text is the end alone. Repeated rows count and are scored each; an empty table gives none.
    """
    spark = docs.sparkSession
    tokens = read_ranks(vocabulary)
    rows = docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    training = rows.where("not held_out").select("doc_id", "text")
    counts = durable(word_counts(training.select("text")))
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = totals["n"] or 0, totals["v"]
    frequent = frequent_words(counts)
    in_words, begun, words = subword_counts(counts, tokens)
    model = fit(training, in_words, tokens)
    # Of the words that begin with a subword: the log of their count, and of the share that their discounts leave.
    log_begun = np.log(np.maximum(begun, 1))
    log_left = np.where(begun > 0, np.log(np.maximum(DISCOUNT * words, 1e-300)) - log_begun, 0.0)
    # Plain values only, so that the package need not be where the tasks run.
    shared = spark.sparkContext.broadcast((tokens, frequent, log_begun, log_left, model.own, model.experts, model.p))
    below = n + 0.5 * (v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, frequent, log_begun, log_left, *parts = shared.value
            cutter, model = _subwords(tokens), Attention(*parts)
            model.tables()
            codes, distinct, per_text, per_word, flat = stream(batch.column("text").to_pylist(), cutter)
            if not len(per_text):
                continue
            starts = np.cumsum(per_text) - per_text
            log_p = model.score(flat, np.add.reduceat(per_word, starts), cutter.end)
            first = np.cumsum(per_word) - per_word
            # Log of what a word gets for each count beyond the discount, and of what it gets by its spelling.
            counted = log_p[first].astype(np.float64) - log_begun[flat[first]]
            spelled = np.add.reduceat(log_p.astype(np.float64), first) + log_left[flat[first]]
            seen = np.fromiter((frequent.get(w, -1) for w in distinct), np.float64, len(distinct))[codes]
            common = seen >= 0
            share = (np.maximum(seen, 0) + 0.5) / below
            base = np.where(common, np.log10(share), 0)
            told = np.exp(counted) * np.maximum(seen - DISCOUNT, 0) + np.exp(spelled)
            mixed = np.where(common, np.log10(COUNT_SHARE * share + (1 - COUNT_SHARE) * told), 0)
            rare = np.flatnonzero(~common)
            cuts = np.searchsorted(rare, np.append(starts, len(codes)))
            offsets = pa.array(cuts, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in
                     (pa.array([distinct[c] for c in codes[rare].tolist()], pa.binary()), pa.array(counted[rare]), pa.array(spelled[rare]))]
            sums = [pa.array(np.add.reduceat(x, starts)) for x in (common.astype(np.int64), base, mixed)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(per_text), *sums, *lists],
                                             ["doc_id", "held_out", "n_tokens", "known", "base", "mixed", "rare", "counted", "spelled"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = durable(rows.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, mixed double, rare array<binary>, counted array<double>, spelled array<double>"))
    # Rows of a written table keep their order, so the number stands for the row.
    scored = scored.withColumn("row", F.monotonically_increasing_id())
    c = F.coalesce("n", F.lit(0))
    share = (c + 0.5) / F.lit(float(below))
    told = F.exp("counted") * F.greatest(c - DISCOUNT, F.lit(0.0)) + F.exp("spelled")
    tail = scored.select("row", F.explode(F.arrays_zip("rare", "counted", "spelled")).alias("e")) \
        .select("row", F.col("e.rare").alias("word"), "e.counted", "e.spelled") \
        .join(counts, "word", "left").groupBy("row").agg(
            F.sum((c > 0).cast("long")).alias("known_rare"), F.sum(F.log10(share)).alias("base_rare"),
            F.sum(F.log10(COUNT_SHARE * share + (1 - COUNT_SHARE) * told)).alias("mixed_rare"))
    whole = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return scored.drop("rare", "counted", "spelled").join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens", whole("known", "known_rare").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        whole("base", "base_rare").alias("base_score"), whole("mixed", "mixed_rare").alias("score"))
