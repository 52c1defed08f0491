"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy, over all overlapping windows.

Every word enters as a hashed word vector beside the mean of its hashed character-gram vectors. Windows of ``WINDOW``
words start every ``STRIDE`` words, so neighbours overlap and every word of a whole text is read. Windows learn the label of
their document; a logistic model over a document's window scores then gives the document's score.

Fitting reads a bounded sample: at most ``max_toxic`` + ``max_clean`` labelled documents, the first by a hash of doc_id, and
every window of their whole texts. Scoring reads every row and every window.

Edge cases: a null or empty text, or one without letters, is one window of padding and gets that window's score. A null
label is no label; documents with both labels are left out. Without two labelled classes every score is 0.0. Repeated
rows are scored alike; a null doc_id is scored and counts as not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops
from .shared import helper, table

WINDOW, STRIDE = 32, 24
HIDDEN, WORD_DIM, CHAR_DIM, ATTEND = 8, 8, 8, 8
WORD_SLOTS, CHAR_SLOTS = 1 << 12, 1 << 14
GRAMS = (3, 5)  # bytes, with a mark at either end of the word
BATCH, STEPS, RATE, DRAWS = 128, 800, 0.03, 4
THRESHOLD = 0.3

IS_LETTER = np.zeros(256, bool)
IS_LETTER[97:123] = True
IS_LETTER[128:] = True

Params = dict[str, Any]


def _types(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of a piece as numbers of distinct words: (word's type, word's row, type's slot, for each size of gram (slots, first gram of each type))."""
    data = textops.LOWER[data]
    start, end, row = textops.spans(IS_LETTER[data], offsets)
    hashes = textops.Rolling(data).of(start, end)
    kinds, where, ids = np.unique(hashes, return_index=True, return_inverse=True)
    length = end[where] - start[where]
    at = np.zeros(len(kinds) + 1, np.int64)
    np.cumsum(length + 2, out=at[1:])
    owner = np.repeat(np.arange(len(kinds)), length + 2)
    inner = np.arange(at[-1]) - at[owner]
    marked = np.full(at[-1], ord("<"), np.uint8)
    body = (inner > 0) & (inner <= length[owner])
    marked[body] = data[(start[where][owner] + inner - 1)[body]]
    marked[at[1:] - 1] = ord(">")
    grams = []
    rolling = textops.Rolling(marked)
    for g in GRAMS:
        h = rolling.grams(g)
        inside = owner[: len(h)] == owner[g - 1 : g - 1 + len(h)]
        first = np.zeros(len(kinds) + 1, np.int64)
        np.cumsum(np.maximum(0, length + 3 - g), out=first[1:])
        grams.append((((h[inside] >> np.uint64(7)) % np.uint64(CHAR_SLOTS)).astype(np.int64), first))
    return ids.astype(np.int64), row, ((kinds >> np.uint64(5)) % np.uint64(WORD_SLOTS)).astype(np.int64), grams


def _picked(grams: list[tuple[np.ndarray, np.ndarray]], own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The grams of some of the types."""
    out = []
    for slots, first in grams:
        many = first[own + 1] - first[own]
        at = np.zeros(len(own) + 1, np.int64)
        np.cumsum(many, out=at[1:])
        out.append((slots[np.arange(at[-1]) + np.repeat(first[own] - at[:-1], many)], at))
    return out


def _inputs(p: Params, word: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A vector for each type, and one of zeros for padding at the end."""
    x = np.zeros((len(word) + 1, WORD_DIM + CHAR_DIM), np.float32)
    x[:-1, :WORD_DIM] = p["words"][word]
    for slots, first in grams:
        some = np.flatnonzero(np.diff(first))
        if len(some):
            x[some, WORD_DIM:] += np.add.reduceat(p["chars"][slots], first[some], axis=0) / np.diff(first)[some, None]
    return x


def _scattered(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows that go to each of n places."""
    d = rows.shape[1]
    return np.bincount((at[:, None] * d + np.arange(d)).reshape(-1), rows.reshape(-1), n * d).reshape(n, d).astype(np.float32)


def _windows(row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, row) of every window; a row without words has one empty window."""
    first = np.searchsorted(row, np.arange(rows + 1))
    words = np.diff(first)
    many = np.maximum(1, -(-(words - (WINDOW - STRIDE)) // STRIDE))
    of = np.repeat(np.arange(rows), many)
    k = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    start = first[of] + k * STRIDE
    return start, np.minimum(WINDOW, first[of + 1] - start), of


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def _forward(p: Params, x: np.ndarray, ids: np.ndarray, real: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Logits of windows. ids: (time, window) types; real: where there is a word."""
    t, b = ids.shape
    h2 = np.empty((t, b, 2 * HIDDEN), np.float32)
    for d, times in ((0, range(t)), (1, range(t - 1, -1, -1))):
        given = x @ p[f"in{d}"] + p[f"bias{d}"]
        # each gate on its own: contiguous arrays, so that numpy's loops run over whole windows
        part = [slice(k * HIDDEN, (k + 1) * HIDDEN) for k in range(3)]
        of_z, of_r, of_n = (np.ascontiguousarray(given[:, k]) for k in part)
        rec_z, rec_r, rec_n = (np.ascontiguousarray(p[f"rec{d}"][:, k]) for k in part)
        h = np.zeros((b, HIDDEN), np.float32)
        for i in times:
            z = _sigmoid(np.take(of_z, ids[i], axis=0) + h @ rec_z)
            r = _sigmoid(np.take(of_r, ids[i], axis=0) + h @ rec_r)
            u = h @ rec_n
            n = 2 * _sigmoid(2 * (np.take(of_n, ids[i], axis=0) + r * u)) - 1
            new = n + z * (h - n)
            if keep is not None:
                keep.append((d, i, h, z, r, n, u))
            h2[i, :, d * HIDDEN : (d + 1) * HIDDEN] = h = new
    a = 2 * _sigmoid(2 * (h2 @ p["attend"])) - 1
    e = np.where(real, a @ p["ask"], np.float32(-1e4))
    e = np.exp(e - e.max(0))
    e /= e.sum(0)
    pooled = (e[:, :, None] * h2).sum(0)
    if keep is not None:
        keep.append((h2, a, e, pooled))
    return pooled @ p["out"] + p["base"][0]


def _gradients(p: Params, x: np.ndarray, ids: np.ndarray, real: np.ndarray, y: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients of the mean log loss for all but the two tables, and for the inputs x."""
    keep: list = []
    logits = _forward(p, x, ids, real, keep)
    h2, a, e, pooled = keep.pop()
    t, b = ids.shape
    dl = ((_sigmoid(logits) - y) / b).astype(np.float32)
    g: Params = {"out": pooled.T @ dl, "base": np.array([dl.sum()], np.float32)}
    dp = dl[:, None] * p["out"]
    dh2 = e[:, :, None] * dp
    de = (h2 * dp).sum(2)
    de = e * (de - (e * de).sum(0))
    g["ask"] = np.tensordot(de, a, ((0, 1), (0, 1)))
    da = de[:, :, None] * p["ask"] * (1 - a * a)
    g["attend"] = np.tensordot(h2, da, ((0, 1), (0, 1)))
    dh2 += da @ p["attend"].T
    dx = np.zeros_like(x)
    for d in (0, 1):
        dg = np.empty((t, b, 3 * HIDDEN), np.float32)
        drec = np.zeros_like(p[f"rec{d}"])
        dh = np.zeros((b, HIDDEN), np.float32)
        for _, i, h, z, r, n, u in reversed([k for k in keep if k[0] == d]):
            dh = dh + dh2[i, :, d * HIDDEN : (d + 1) * HIDDEN]
            dn = dh * (1 - z) * (1 - n * n)
            du = np.concatenate([dh * (h - n) * z * (1 - z), dn * u * r * (1 - r), dn * r], 1)
            dg[i] = du
            dg[i, :, 2 * HIDDEN :] = dn
            drec += h.T @ du
            dh = dh * z + du @ p[f"rec{d}"].T
        given = _scattered(ids.reshape(-1), dg.reshape(-1, 3 * HIDDEN), len(x))
        g[f"rec{d}"], g[f"bias{d}"], g[f"in{d}"] = drec, given.sum(0), x.T @ given
        dx += given @ p[f"in{d}"].T
    return g, dx


def _types_of_all(texts: list[str]):
    """``_types`` of many texts, a piece at a time; a word may be one type in each piece."""
    kinds, rows, words, grams = [], [], [], [([], [np.zeros(1, np.int64)]) for _ in GRAMS]
    known, held = 0, [0] * len(GRAMS)
    for at, _, data, offsets in textops.pieces(pa.array(texts, pa.string())):
        kind, row, word, some = _types(data, offsets)
        kinds.append((kind + known).astype(np.int32))
        rows.append((row + at).astype(np.int32))
        words.append(word)
        known += len(word)
        for k, (slots, first) in enumerate(some):
            grams[k][0].append(slots.astype(np.int32))
            grams[k][1].append(first[1:] + held[k])
            held[k] += len(slots)
    return np.concatenate(kinds), np.concatenate(rows), np.concatenate(words), [(np.concatenate(s), np.concatenate(f)) for s, f in grams]


def train(texts: list[str], labels: np.ndarray, of: np.ndarray, seed: int = 7) -> Params:
    """The network from windows given as text; Adam for the weights, Adagrad for the rows of the tables in use.

    of: each window's document, in order. Every epoch draws ``DRAWS`` windows of each document anew, so long texts weigh no
    more than others and all their windows take turns.
    """
    rng = np.random.default_rng(seed)
    w = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    size = WORD_DIM + CHAR_DIM
    p: Params = {"words": w(WORD_SLOTS, WORD_DIM) * 8, "chars": w(CHAR_SLOTS, CHAR_DIM) * 40, "attend": w(2 * HIDDEN, ATTEND), "ask": w(ATTEND), "out": w(2 * HIDDEN), "base": np.zeros(1, np.float32)}
    for d in (0, 1):
        p |= {f"in{d}": w(size, 3 * HIDDEN), f"rec{d}": w(HIDDEN, 3 * HIDDEN), f"bias{d}": np.zeros(3 * HIDDEN, np.float32)}
    kind, row, word, grams = _types_of_all(texts)
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items() if k not in ("words", "chars")}
    used = {k: np.full(len(p[k]), 1e-3, np.float32) for k in ("words", "chars")}
    begin = np.searchsorted(of, of)
    step, epochs = 0, min(30, -(-STEPS * BATCH // int((np.arange(len(of)) - begin < DRAWS).sum())))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs) + 0.001
        drawn = np.lexsort((rng.random(len(of)), of))
        deal = rng.permutation(drawn[np.arange(len(of)) - begin < DRAWS])
        for k in range(0, len(deal), BATCH):
            mine = deal[k : k + BATCH]
            idx = first[mine] + np.arange(WINDOW)[:, None]
            real = idx < first[mine + 1]
            full = np.where(real, kind[np.minimum(idx, len(kind) - 1)], len(word))
            local, ids = np.unique(full, return_inverse=True)
            ids = ids.reshape(full.shape)
            own = local[local < len(word)]
            near = _picked(grams, own)
            x = _inputs(p, word[own], near)
            g, dx = _gradients(p, x, ids, real, labels[mine])
            step += 1
            for name, grad in g.items():
                m, v = moment[name]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p[name] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            dx = dx[: len(own)]
            dc = [np.repeat(dx[:, WORD_DIM:] / np.maximum(1, np.diff(f))[:, None], np.diff(f), axis=0) for _, f in near]
            for name, rows, grad in (("words", word[own], dx[:, :WORD_DIM]), ("chars", np.concatenate([c for c, _ in near]), np.concatenate(dc))):
                r, inv = np.unique(rows, return_inverse=True)
                total = _scattered(inv, grad, len(r))
                used[name][r] += (total * total).mean(1)
                p[name][r] -= 6 * RATE * total / np.sqrt(used[name][r])[:, None]
    return p


FEATURES = 4
BLOCK = 2048  # windows scored at a time


def _document_features(p: Params, data: np.ndarray, offsets: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row: features of its window scores, its windows, and the first word of the worst one."""
    kind, row, word, grams = _types(data, offsets)
    x = _inputs(p, word, grams)
    start, words, of = _windows(row, rows)
    logits = np.empty(len(of), np.float32)
    steps = np.arange(WINDOW)[:, None]
    kind = np.append(kind, len(word))
    for k in range(0, len(of), BLOCK):
        s, n = start[k : k + BLOCK], words[k : k + BLOCK]
        real = steps < n
        ids = np.where(real, kind[np.minimum(s + steps, len(kind) - 1)], len(word))
        logits[k : k + BLOCK] = _forward(p, x, ids, real)
    firsts = np.searchsorted(of, np.arange(rows + 1))
    many = np.diff(firsts)
    order = np.lexsort((-logits, of))
    ranked = logits[order]
    top = [ranked[firsts[:-1] + np.minimum(j, many - 1)] for j in range(2)]
    f = np.stack([top[0], top[1], np.add.reduceat(_sigmoid(logits), firsts[:-1]) / many, np.add.reduceat(logits, firsts[:-1]) / many], 1)
    begun = np.searchsorted(row, np.arange(rows))
    return f.astype(np.float64), many, start[order][firsts[:-1]] - begun


def _logistic(f: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, spread = f.mean(0), f.std(0) + 1e-6
    a = np.c_[(f - mean) / spread, np.ones(len(f))]
    w = np.zeros(a.shape[1])
    for _ in range(30):
        q = _sigmoid(a @ w)
        hess = (a * (q * (1 - q))[:, None]).T @ a + ridge * np.diag([1.0] * f.shape[1] + [1e-3])
        w -= np.linalg.solve(hess, a.T @ (q - y) + ridge * w * np.r_[np.ones(f.shape[1]), 1e-3])
    return mean, spread, w


def _features(docs: DataFrame, p: Params, head: tuple | None, drop: tuple[str, ...] = ("text",)) -> DataFrame:
    """One row for each row of docs, in its partition: the window features, or the score once there is a head."""
    what = "score double, n_windows int, worst_word long" if head else ", ".join(f"f{j} double" for j in range(FEATURES))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textops.pieces(batch.column("text"), 2 * textops.PIECE):
                f, many, worst = _document_features(p, data, offsets, b - a)
                other = [c for c in batch.schema.names if c not in drop]
                cols = [batch.column(c).slice(a, b - a) for c in other]
                if head:
                    mean, spread, w = head
                    score = _sigmoid(np.c_[(f - mean) / spread, np.ones(len(f))] @ w)
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(score), pa.array(many, pa.int32()), pa.array(worst, pa.int64())], [*other, "score", "n_windows", "worst_word"])
                else:
                    yield pa.RecordBatch.from_arrays([*cols, *(pa.array(f[:, j]) for j in range(FEATURES))], [*other, *(f"f{j}" for j in range(FEATURES))])

    kept = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c not in drop)
    return docs.mapInArrow(work, f"{kept}, {what}")


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = 1200, max_clean: int = 1800) -> tuple[Params, tuple] | None:
    """The network and the document model, from the labelled rows that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("toxic").alias("y"), F.max("toxic").alias("y2")).where("y = y2").drop("y2")
    order = F.xxhash64("doc_id")
    some = known.where("y = 1").orderBy(order, "doc_id").limit(max_toxic).union(known.where("y = 0").orderBy(order, "doc_id").limit(max_clean))
    chosen = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textops.pieces(batch.column("text")):
                low = textops.LOWER[data]
                start, end, row = textops.spans(IS_LETTER[low], offsets)
                first, words, of = _windows(row, b - a)
                ids, ys = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("y").to_numpy(zero_copy_only=False)
                out = []
                for r in range(b - a):
                    mine = np.flatnonzero(of == r) if b - a < 64 else np.arange(np.searchsorted(of, r), np.searchsorted(of, r, "right"))
                    for k in mine:
                        text = low[start[first[k]] : end[first[k] + words[k] - 1]].tobytes() if words[k] > 0 else b""
                        out.append((ids[a + r], int(k), ys[a + r], text.decode(errors="ignore")))
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.string()))], ["doc_id", "k", "y", "text"])

    windows = chosen.select("doc_id", F.col("y").cast("int").alias("y"), "text").mapInArrow(cut, "doc_id long, k long, y int, text string").toPandas().sort_values(["doc_id", "k", "text"])
    if windows["y"].nunique() < 2:
        return None
    p = train(windows["text"].tolist(), windows["y"].to_numpy(np.float32), np.unique(windows["doc_id"], return_inverse=True)[1])
    seen = _features(chosen.select("doc_id", F.col("y").cast("int").alias("y"), "text"), p, None).toPandas().sort_values(["doc_id", "f0"])
    head = _logistic(seen[[f"f{j}" for j in range(FEATURES)]].to_numpy(), seen["y"].to_numpy(np.float64))
    return p, head


def score(docs: DataFrame, model: tuple[Params, tuple] | None, keep_text: bool = False) -> DataFrame:
    """docs (any columns with text) without text, with score, n_windows, worst_word (the first word of the worst window), which replace older ones."""
    docs = docs.drop("score", "n_windows", "worst_word")
    drop = () if keep_text else ("text",)
    if model is None:
        return docs.drop(*drop).withColumns({"score": F.lit(0.0), "n_windows": F.lit(0), "worst_word": F.lit(0).cast("long")})
    return _features(docs, *model, drop)


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that the model, fitted on the labelled rows among docs, predicts to be toxic; all columns stay."""
    held = {c: helper(docs, f"held_{c}") for c in ("score", "n_windows", "worst_word") if c in docs.columns}
    scored = score(docs.withColumnsRenamed(held), fit(docs.select("doc_id", "text"), labels), keep_text=True)
    return scored.where(F.col("score") < THRESHOLD).select(*(F.col(f"`{held.get(c, c)}`").alias(c) for c in docs.columns))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "n_windows", "worst_word")
