"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the 2, 3 and 4 bytes from every place of a word (ASCII lower-cased,
white space, digits and punctuation being one boundary mark), hashed to BUCKETS
embeddings. A document is their mean over its whole text; a linear layer and a
softmax give the languages and one class more: no language that is known. That class
is trained on the same texts with their letters in a random order, so it stands for
texts whose words are none of the known languages'. Embeddings and layer are trained
together by stochastic gradient descent in numpy on the logarithmic loss, one text a
step; the embeddings' rate is ``spread`` times the layer's, as a mean hands each
subword only its small share of the gradient.

A tenth of the training rows is set aside and calibrates: the temperature of the
softmax, the confidence below which a document is rejected (at most ``lost`` of the
right answers go), and the share of the unknown class beyond which it is (likewise).
Rejected documents have ``accepted`` false; their language and score are given all the same.

The model is linear in the mean, so at use each bucket holds its scores, and a
document costs one lookup a subword.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and is not accepted. Without training rows everything is ``und``. Training takes
at most ``max_docs`` rows and ``max_bytes`` bytes, about as many of each language
(smallest hashes of doc_id first, then doc_id; whole texts of any size while they fit; sizes are
fetched first). Repeated rows are trained on and judged each for itself. Of equal scores the
first language in byte order is given. An empty table gives no rows. ``keep`` passes other columns
through whatever their names, ``predict`` ignores them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.llm.bpe import release
from vellumry.llm.bytehash import U64, chunks, mix64
from vellumry.llm.storage import small_table

BUCKETS, DIM, SIZES = 1 << 16, 16, (2, 3, 4)
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] += 32
_CLASS[[c for c in range(128) if not chr(c).isalpha()]] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_HASH = [mix64(np.arange(256, dtype=U64) * U64(2654435761) + U64(k * 1000003)).astype(np.uint32) for k in range(max(SIZES))]
_HASH = [(h | 1).astype(np.uint32) for h in _HASH]


def subwords(buf: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, places) for each subword size, places ascending; none crosses texts."""
    x = _CLASS[buf]
    mark = x == 32
    doubled = np.zeros(len(x), bool)
    doubled[1:] = mark[1:] & mark[:-1]
    keep = np.flatnonzero(~doubled)
    x = x[keep]
    text = np.searchsorted(off, keep, "right")
    out = []
    h = np.zeros(len(x), np.uint32)
    for k in range(max(SIZES)):
        n = len(x) - k
        if n <= 0:
            break
        h = h[:n] * np.uint32(0x01000193) ^ _HASH[k][x[k:]]
        if k + 1 in SIZES:
            ok = text[:n] == text[k:]
            out.append(((h ^ (h >> 15))[ok] % np.uint32(BUCKETS), keep[:n][ok]))
    return out


class LanguageModel:
    def __init__(self, names: list[str]):
        self.names = names
        self.table = np.zeros((BUCKETS, len(names) + 1), np.float32)
        self.temperature, self.least, self.most_unknown = 1.0, 0.0, 1.0

    def logits(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        sums, count = np.zeros((n, self.table.shape[1])), np.zeros(n)
        for bucket, place in subwords(buf, off):
            cut = np.searchsorted(place, off)
            values = np.take(self.table, bucket, axis=0)
            full = np.flatnonzero(np.diff(cut))
            if len(full):
                sums[full] += np.add.reduceat(values, cut[:-1][full], axis=0)
            count += np.diff(cut)
        return sums / np.maximum(count, 1)[:, None]

    def probabilities(self, logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(of the languages, among themselves; of no known language)."""
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        known = e[:, :-1].sum(axis=1)
        return e[:, :-1] / np.maximum(known, 1e-30)[:, None], e[:, -1] / e.sum(axis=1)

    def fit(self, texts: list[bytes], y: np.ndarray, least_steps: int = 6000, rate: float = 0.5, spread: float = 100.0, lost: float = 0.001, seed: int = 5) -> "LanguageModel":
        """y: the place of each text's language in names."""
        r = np.random.default_rng(seed)

        def bag(t: bytes) -> tuple[np.ndarray, np.ndarray]:
            b = np.concatenate([b for b, _ in subwords(np.frombuffer(t, np.uint8), np.array([0, len(t)]))] or [np.zeros(0, np.uint32)])
            ids, n = np.unique(b, return_counts=True)
            return ids.astype(np.int64), (n / max(1, len(b))).astype(np.float32)

        def mixed(t: bytes) -> bytes:
            """The text with its letters dealt anew; white space, digits and punctuation stay where they are."""
            x = np.frombuffer(t, np.uint8).copy()
            at = np.flatnonzero(_CLASS[x] != 32)
            x[at] = x[r.permutation(at)]
            return x.tobytes()

        k = len(self.names)
        own = r.permutation(len(texts))
        aside, own = own[: len(own) // 10], own[len(own) // 10 :]
        bags = [bag(t) for t in texts]
        noise = {int(i): bag(mixed(texts[i])) for i in (*own[: max(1, len(own) // 3)], *aside)}
        train_noise = [i for i in own.tolist() if i in noise]
        emb = (r.normal(size=(BUCKETS, DIM)) / DIM).astype(np.float32)
        layer = (r.normal(size=(DIM, k + 1)) / DIM).astype(np.float32)
        steps = max(2 * len(own), least_steps)
        for step in range(steps):
            if step % 4 == 3 and train_noise:
                i = train_noise[r.integers(len(train_noise))]
                (ids, share), target = noise[i], k
            else:
                i = own[r.integers(len(own))]
                (ids, share), target = bags[i], y[i]
            if not len(ids):
                continue
            lr = rate * (1 - step / steps)
            mean = share @ emb[ids]
            z = mean @ layer
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target] -= 1
            back = layer @ p
            layer -= lr * np.outer(mean, p).astype(np.float32)
            emb[ids] -= (lr * spread) * share[:, None] * back
        self.table = emb @ layer
        if len(aside):
            score = lambda b: b[1] @ self.table[b[0]] if len(b[0]) else np.zeros(k + 1)
            z, at = np.array([score(bags[i]) for i in aside]), np.arange(len(aside))

            def loss(t: float) -> float:
                self.temperature = t
                return float(-np.log(self.probabilities(z)[0][at, y[aside]] + 1e-12).mean())

            self.temperature = float(min(np.geomspace(0.02, 20, 60), key=loss))
            p, unknown = self.probabilities(z)
            right = p.argmax(axis=1) == y[aside]
            if right.any():
                self.least = float(min(np.quantile(p.max(axis=1)[right], lost), 0.9))
                of_noise = self.probabilities(np.array([score(noise[int(i)]) for i in aside]))[1]
                # between what right answers have at most and what noise has at least, as far as they part
                top, low = float(np.quantile(unknown[right], 1 - lost)), float(np.quantile(of_noise, 0.01))
                self.most_unknown = max(top, (top + low) / 2)
        return self


def train(docs: DataFrame, max_docs: int = 3000, max_bytes: int = 8_000_000) -> LanguageModel:
    """Fit on docs (doc_id, text, lang) with a text and a language."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return LanguageModel([])
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 1.5 * max_docs / len(counts) / n))])
    few = rows.where(u < F.element_at(share, F.col("lang"))).withColumn("k", F.xxhash64("doc_id"))
    names = sorted(counts)
    # whole groups of rows of one (doc_id, lang), smallest hashes first, while they fit
    sizes = few.groupBy("k", "doc_id", "lang").agg(F.sum(F.octet_length("text")).cast("long").alias("n"), F.count(F.lit(1)).alias("rows")).limit(3 * max_docs).collect()
    chosen, held, n = [], 0, 0
    for r in sorted(sizes, key=lambda r: (r.k, str(r.doc_id), r.lang)):
        if held + r.n <= max_bytes and n + r.rows <= max_docs:
            chosen.append((r.k, r.lang))
            held, n = held + r.n, n + r.rows
    wanted = small_table(docs.sparkSession, chosen, {"k": pa.int64(), "lang": pa.string()})
    picked = few.join(F.broadcast(wanted.distinct()), ["k", "lang"]).collect()
    texts, y = [], []
    for r in sorted(picked, key=lambda r: (r.k, str(r.doc_id), r.text)):
        texts.append(r.text.encode()), y.append(names.index(r.lang))
    return LanguageModel(names).fit(texts, np.array(y, np.int64)) if texts else LanguageModel([])


def _has_letter(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    at = np.concatenate(([0], np.cumsum(_ASCII_LETTER[buf])))
    has = at[off[1:]] > at[off[:-1]]
    for k in np.flatnonzero(~has):
        has[k] = any(c.isalpha() for c in buf[off[k] : off[k + 1]].tobytes().decode())
    return has


def _judge(model: LanguageModel, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in names or their number for und, score, accepted) of each text."""
    n = len(off) - 1
    if not model.names:
        return np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
    p, unknown = model.probabilities(model.logits(buf, off))
    at, score = p.argmax(axis=1), p.max(axis=1)
    none = ~_has_letter(buf, off)
    at[none], score[none] = len(model.names), 0.0
    return at, score, ~none & (score >= model.least) & (unknown <= model.most_unknown)


def keep(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The accepted rows of docs, all columns; nothing is shuffled."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            ok = [_judge(model, buf, off)[2] for _, _, buf, off in chunks(b.column(place))]
            yield b.filter(pa.array(np.concatenate(ok))) if ok else b

    return docs.mapInArrow(run, docs.schema)


def _predict(model: LanguageModel):
    names = np.array([*model.names, "und"], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in chunks(b.column(1)):
                at, score, accepted = _judge(model, buf, off)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(names[at].tolist(), pa.string()), pa.array(score), pa.array(accepted)],
                    names=["doc_id", "lang_pred", "score", "accepted"],
                )

    return run


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, lang_pred, score, accepted), one row per row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _predict(model), "doc_id long, lang_pred string, score double, accepted boolean"
    )
