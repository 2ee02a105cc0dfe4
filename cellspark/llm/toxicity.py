"""Toxic spans and document scores from a linear-chain conditional random field.

Labels are given for documents only, so token tags are weak: a word is tagged toxic in a toxic document if it, or a
beginning of it, stands in contexts (word before, word after) of its own in far more documents than of clean ones.  Counting only documents with
a new context keeps copies of one text from voting more than once.  The field has weights for words and their beginnings, transitions
and a start; it is trained by gradient ascent on the tag likelihood, with forward-backward marginals.  A document's score is a
logistic function of its largest marginal and of its expected number of toxic words, fitted on the same training rows; the
number is taken over words tagged toxic, as the small marginals of the others would add up with a text's length.
Tokens whose marginal is above one half, joined where adjacent, are the offending spans, as code-point offsets.

Training takes at most MAX_TRAIN documents of each label (in order of a hash of the id), whole; of equal texts the one of
the smallest id, so reruns agree.  The field has weights for all features that it tags by and for the VOCABULARY most frequent
others of the training documents, a bound on what is broadcast.  The field learns from as
many of them as hold MAX_WORDS words for each label (a document that would exceed it is left out, none is cut); the document
model learns from all of them, those that the field left out scored on executors.  Scoring takes all words of all texts.

Cases: a null or empty text has no words and the score of the empty text; rows without label, id or text never train;
conflicting labels of one id count as toxic; without labels of both kinds every score is the share of toxic labels (0
without labels); repeated rows get equal scores; very long texts are tagged whole; an empty table gives an empty table;
other columns are not touched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod3, filled, lean, stored, table

MAX_TRAIN = 800
MAX_WORDS = 819_200
VOCABULARY = 60_000
PREFIXES = (3, 4, 5, 6, 7)
EPOCHS = 40
THRESHOLD = 0.7
TOKEN = re.compile(r"\w+")


def tokens_of(text: str) -> list[str]:
    """Lower-cased tokens, as many as the text itself has."""
    low = text.lower()
    if len(low) == len(text):
        return TOKEN.findall(low)
    return [t.lower() for t in TOKEN.findall(text)]  # a capital I with a dot grows when lowered, by a mark that is no word character


# --- the field ------------------------------------------------------------------------------------------------------


def _compose(a, b):
    """Products of 2x2 matrices given as four arrays, scaled to a largest entry of one."""
    c = (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3])
    top = np.maximum(np.maximum(c[0], c[1]), np.maximum(c[2], c[3]))
    return tuple(x / top for x in c)


def _chain(m: np.ndarray, width: int) -> np.ndarray:
    """Row vectors v_t ~ v_{t-1} m_t from (1, 1), for all t; m is (4, n).  Lanes of `width` steps run side by side.

    A first sweep multiplies each lane's matrices, a short loop over lanes carries the vector across them, and a second
    sweep fills in the vectors: a prefix scan of matrix products.
    """
    n = m.shape[1]
    lanes = -(-n // width)
    pad = lanes * width - n
    if pad:
        m = np.concatenate([m, np.repeat([[1.0], [0.0], [0.0], [1.0]], pad, 1)], 1)
    m = np.ascontiguousarray(m.reshape(4, lanes, width).transpose(2, 0, 1))  # step, entry, lane
    x0, x1 = np.ones(lanes), np.ones(lanes)
    if lanes > 1:
        whole = tuple(m[0])
        for t in range(1, width):
            whole = _compose(whole, tuple(m[t]))
        a, b = 1.0, 1.0
        for i, (p, q, r, s) in enumerate(zip(*[x.tolist() for x in whole])):
            x0[i], x1[i] = a, b
            a, b = a * p + b * r, a * q + b * s
            top = a if a > b else b
            a, b = a / top, b / top
    out = np.empty((width, 2, lanes))
    for t in range(width):
        p, q, r, s = m[t]
        x0, x1 = x0 * p + x1 * r, x0 * q + x1 * s
        top = x0 + x1
        x0, x1 = x0 / top, x1 / top
        out[t, 0], out[t, 1] = x0, x1
    return out.transpose(1, 2, 0).reshape(2, -1)[:, :n]


def marginals(gain: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float):
    """Forward and backward vectors of sequences laid end to end.

    gain: log potential of tag 1 against tag 0; first: where a sequence begins; trans: 2x2 potentials; start: log
    potential of tag 1 at a beginning.  A beginning's matrix has equal rows, so nothing crosses it.
    """
    n = len(gain)
    width = max(16, int(np.sqrt(n)))
    e = np.exp(np.clip(gain, -30, 30))
    f = np.where(first, np.exp(start), 0)
    # the matrices are handed over, so each sweep's go before the next ones are made
    alpha = _chain(np.stack([np.where(first, 1.0, trans[0, 0]), np.where(first, f, trans[0, 1]) * e, np.where(first, 1.0, trans[1, 0]), np.where(first, f, trans[1, 1]) * e]), width)
    # backward: b_t = T diag(psi_{t+1}) b_{t+1}, as row vectors over the transposed matrices in reverse order
    last = np.concatenate([first[1:], [True]])
    e1 = np.concatenate([e[1:], [1.0]])
    beta = _chain(np.stack([np.where(last, 1.0, trans[0, 0]), np.where(last, 1.0, trans[1, 0]), np.where(last, 1.0, trans[0, 1] * e1), np.where(last, 1.0, trans[1, 1] * e1)])[:, ::-1], width)[:, ::-1]
    return alpha, beta, e, last


def probability(alpha: np.ndarray, beta: np.ndarray) -> np.ndarray:
    p = alpha * beta
    return p[1] / (p[0] + p[1])


class Gains(dict):
    """Log potentials of words, made from their features when first met; as many as `most` are remembered."""

    def __init__(self, weights: dict[str, float], bias: float, most: int = 200_000):
        super().__init__()
        self.weights, self.bias, self.most = weights, bias, most

    def __missing__(self, word: str) -> float:
        get = self.weights.get
        gain = self.bias + sum([get(f, 0.0) for f in word_features(word)])
        if len(self) < self.most:
            self[word] = gain
        return gain


def word_features(word: str) -> list[str]:
    return ["=" + word, *[f"{k}{word[:k]}" for k in PREFIXES if len(word) >= k]]


@dataclass
class Field:
    """A trained field and the document model on top of it."""

    weights: dict[str, float]  # of features
    bias: float
    trans: np.ndarray
    start: float
    doc: np.ndarray  # intercept, largest marginal, log of one plus the expected count
    prior: float | None = None  # where there was nothing to learn from

    def plain(self) -> tuple:
        """Values that any worker can unpickle."""
        return self.weights, self.bias, self.trans, self.start, self.doc, self.prior

    def tag(self, tokens: list[list[str]], gains: Gains | None = None) -> list[np.ndarray]:
        """The marginal of tag 1 of each token of each text."""
        size = np.array([len(t) for t in tokens])
        if not size.sum():
            return [np.zeros(0)] * len(tokens)
        at = (Gains(self.weights, self.bias) if gains is None else gains).__getitem__
        gain = np.fromiter((x for t in tokens for x in map(at, t)), float, int(size.sum()))
        ends = np.cumsum(size)
        first = np.zeros(len(gain), bool)
        first[(ends - size)[size > 0]] = True
        alpha, beta, _, _ = marginals(gain, first, self.trans, self.start)
        return np.split(probability(alpha, beta), ends[:-1])

    def score(self, tags: list[np.ndarray]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(tags), self.prior)
        x = np.array([features(p) for p in tags]).reshape(-1, 3)
        return 1 / (1 + np.exp(-x @ self.doc))


def features(p: np.ndarray) -> tuple[float, float, float]:
    return (1.0, float(p.max()), float(np.log1p(p[p > 0.5].sum()))) if len(p) else (1.0, 0.0, 0.0)


def _shares(feature: np.ndarray, codes: np.ndarray, size: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """For each feature, the documents that show it in a context (words before and after) that no earlier one has."""
    if not len(codes):
        return np.zeros(n)
    ends = np.cumsum(size)
    before, after = np.concatenate([[-1], codes[:-1]]), np.concatenate([codes[1:], [-1]])
    before[(ends - size)[size > 0]] = -1
    after[ends[size > 0] - 1] = -1
    side = (before + 1) * (codes.max() + 2) + after + 1
    order = np.lexsort((side, feature))  # stable: of equal contexts the first document's comes first
    w, side = feature[order], side[order]
    new = np.concatenate([[True], (w[1:] != w[:-1]) | (side[1:] != side[:-1])])
    pairs = np.unique(w[new] * (doc.max() + 1) + np.repeat(doc, size)[order][new])
    return np.bincount(pairs // (doc.max() + 1), minlength=n).astype(float)


def toxic_features(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> np.ndarray:
    """Which features have far larger shares of toxic (a of na) than of clean texts (b of nb).

    The ratio must exceed 5, and chance must be ruled out for all features together: the Chernoff bound on the binomial
    tail, times the number of features, below 1 %.
    """
    n = a + b
    p0 = min(max(a.sum() / max(1, n.sum()), 1e-9), 1 - 1e-9)
    share = np.divide(a, n, out=np.zeros(len(n)), where=n > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = n * (np.where(a > 0, share * np.log(share / p0), 0) + np.where(b > 0, (1 - share) * np.log((1 - share) / (1 - p0)), 0))
    ratio = np.log((a + 0.5) / max(1, na)) - np.log((b + 0.5) / max(1, nb))
    return (share > p0) & (ratio > np.log(5)) & (surprise > np.log(max(1, int((n >= 3).sum())) / 0.01))


def fit(labels: np.ndarray, texts: pa.Array, owner: np.ndarray, share: float, others=None) -> Field:
    """labels: of the training documents; texts: tokens joined by blanks; owner: each text's document (ascending); share:
    of toxic ones among all labelled rows; others: gives labels and features of documents that only the document model
    learns from, when called with the field."""
    labels = np.asarray(labels).astype(bool)
    if labels.all() or not labels.any() or not len(texts):
        return Field({}, 0.0, np.ones((2, 2)), 0.0, np.zeros(3), float(share))
    split = pc.split_pattern(texts, " ")
    size = np.diff(split.offsets.to_numpy()).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary
    # features of each distinct word: the word, and its beginnings; 0 where it has none
    parts, columns, n = [], [], 1
    for k in (0, *PREFIXES):
        own = (pc.utf8_slice_codeunits(words, 0, k) if k else words).dictionary_encode()
        col = own.indices.to_numpy(zero_copy_only=False).astype(np.int64) + n
        columns.append(np.where(pc.utf8_length(words).to_numpy(zero_copy_only=False) >= k, col, 0))
        parts.append((n, f"{k}" if k else "=", own.dictionary))
        n += len(own.dictionary)
    toxic, of_text = np.repeat(labels[owner], size), labels[owner]
    marked, count = np.zeros(n, bool), np.zeros(n)
    for col in columns:
        feature = col[codes]
        a, b = (_shares(feature[toxic == t], codes[toxic == t], size[of_text == t], owner[of_text == t], n) for t in (True, False))
        m = toxic_features(a, b, int(labels.sum()), int((~labels).sum()))
        m[0] = False
        marked |= m
        count += np.bincount(feature, minlength=n)
    count[0] = 0
    keep = marked.copy()
    keep[np.argsort(-count, kind="stable")[:VOCABULARY]] = True
    keep &= count > 1
    place = np.where(keep, np.cumsum(keep), 0)
    n = int(keep.sum()) + 1
    hit = np.any([marked[col] for col in columns], axis=0)
    tags = (toxic & hit[codes]).astype(float)
    columns = [place[col] for col in columns]
    table_of = [mark + w for start_, mark, own in parts for w in own.filter(pa.array(keep[start_ : start_ + len(own)])).to_pylist()]
    first = np.zeros(len(codes), bool)
    first[np.cumsum(size) - size] = True
    bias = np.log(max(tags.mean(), 1e-6))
    theta = np.zeros(n + 5)  # features (0: none), transitions 00 01 10 11, start
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.flatnonzero(~first)
    y0, y1 = tags[inner - 1], tags[inner]
    by_feature = lambda x: sum(np.bincount(col, np.bincount(codes, x, len(words)), n) for col in columns)
    seen = np.concatenate([by_feature(tags), [((1 - y0) * (1 - y1)).sum(), ((1 - y0) * y1).sum(), (y0 * (1 - y1)).sum(), (y0 * y1).sum()], [tags[first].sum()]])

    def gains() -> np.ndarray:
        return (bias + sum(theta[col] for col in columns))[codes]

    for step in range(1, EPOCHS + 1):
        trans = np.exp(theta[n : n + 4]).reshape(2, 2)
        alpha, beta, e, _ = marginals(gains(), first, trans, theta[-1])
        p = probability(alpha, beta)
        fwd, bwd = alpha[:, inner - 1], beta[:, inner]
        bwd[1] *= e[inner]
        pair = [fwd[i] * trans[i, j] * bwd[j] for i in (0, 1) for j in (0, 1)]
        total = sum(pair)
        g = seen - np.concatenate([by_feature(p), [(x / total).sum() for x in pair], [p[first].sum()]]) - 0.05 * theta
        g[0] = 0
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        del alpha, beta, e, p, fwd, bwd, pair, total  # or they would stay beside the next step's
    trans, start = np.exp(theta[n : n + 4]).reshape(2, 2), float(theta[-1])
    # the document model: logistic regression by Newton steps, then the intercept moved from the sample's share to the corpus's
    alpha, beta, _, _ = marginals(gains(), first, trans, start)
    p = probability(alpha, beta)
    doc = np.repeat(owner, size)
    top, mass = np.zeros(len(labels)), np.bincount(doc, np.where(p > 0.5, p, 0), len(labels))
    np.maximum.at(top, doc, p)
    x, y = np.stack([np.ones(len(labels)), top, np.log1p(mass)], 1), labels.astype(float)
    field = Field({f: float(x) for f, x in zip(table_of, theta[1:n]) if abs(x) > 1e-3}, float(bias), trans, start, np.zeros(3))
    if others is not None:
        more_y, more_x = others(field)
        x, y = np.concatenate([x, more_x]), np.concatenate([y, more_y])
    w, ridge = np.zeros(3), np.array([1e-3, 0.1, 0.1])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x.T * (q * (1 - q))) @ x + np.diag(ridge), x.T @ (y - q) - ridge * w)
    w[1:] = np.maximum(w[1:], 0)  # more toxic words never lower a score
    if 0 < share < 1:
        w[0] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    field.doc = w
    return field


# --- over tables ----------------------------------------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", most: int = MAX_TRAIN, words: int = MAX_WORDS) -> Field:
    """Fit on rows whose crc32(id) mod 3 is not 1.  The texts that reach the driver are bounded by most and words a label."""
    known = labels.where(labels[label_col].isNotNull() & labels[id_col].isNotNull() & (crc_mod3(labels[id_col]) != 1)).groupBy(labels[id_col].alias("__id")).agg(F.max(labels[label_col].cast("int")).alias("__y"))
    n = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}  # two rows
    pick = lambda y: known.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(most)
    chosen = pick(1).unionByName(pick(0))  # at most 2 * most rows
    narrow = docs.select(docs[id_col].alias("__id"), docs[text_col].alias("__text")).where(F.col("__text").isNotNull())

    def tokenised(batches):
        for batch in batches:
            tokens = [tokens_of(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), pa.array([" ".join(t) for t in tokens], pa.string()), pa.array([len(t) for t in tokens], pa.int64())], names=["id", "y", "tokens", "n"])

    kind = narrow.schema["__id"].dataType.simpleString()
    rows = narrow.join(F.broadcast(chosen), "__id").select("__id", "__y", "__text").mapInArrow(tokenised, f"id {kind}, y int, tokens string, n long")
    rows = stored(rows.groupBy("y", "tokens", "n").agg(F.min("id").alias("id")).withColumn("at", F.xxhash64("tokens")), "toxicity-train")
    room, left_out = {0: words, 1: words}, []
    for r in rows.select("y", "at", "n").orderBy("at", "y").collect():  # numbers only
        if r["n"] <= room[r["y"]]:
            room[r["y"]] -= r["n"]
        else:
            left_out.append((r["y"], r["at"]))
    beyond = F.lit(False)
    for y in (0, 1):
        beyond |= (F.col("y") == y) & F.col("at").isin([a for z, a in left_out if z == y])
    got = (rows.where(~beyond) if left_out else rows).toArrow()
    got = got.sort_by([("id", "ascending")])
    owner = np.flatnonzero(got.column("n").to_numpy() > 0)
    texts = got.column("tokens").take(pa.array(owner)).combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    total = sum(n.values())

    def others(field: Field) -> tuple[np.ndarray, np.ndarray]:
        shipped = docs.sparkSession.sparkContext.broadcast(field.plain())

        def run(batches):
            model = Field(*shipped.value)
            gains = Gains(model.weights, model.bias)
            for batch in batches:
                x = [features(model.tag([t.as_py().split()], gains)[0]) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i[1] for i in x], pa.float64()), pa.array([i[2] for i in x], pa.float64())], names=["y", "top", "mass"])

        more = rows.where(beyond).orderBy("at", "y").select("y", "tokens").mapInArrow(lean(run), "y int, top double, mass double").toArrow()
        return more.column("y").to_numpy().astype(float), np.stack([np.ones(more.num_rows), more.column("top").to_numpy(), more.column("mass").to_numpy()], 1)

    return fit(got.column("y").to_numpy(), texts, owner, n.get(1, 0) / total if total else 0.0, others if left_out else None)


def spans(text: str, p: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, stop, largest marginal) of runs of tokens whose marginal is above one half."""
    out: list[tuple[int, int, float]] = []
    near = False
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    if len(tokens) != len(p):  # of another text
        return out
    for (a, b), q in zip(tokens, p.tolist()):
        if q > 0.5:
            if near:
                a, _, r = out.pop()
                q = max(q, r)
            out.append((a, b, q))
        near = q > 0.5
    return out


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = True) -> DataFrame:
    """doc_id, score, n_toxic_words and, if asked for, spans array<struct<start, stop, p>> of every whole text."""
    spark = docs.sparkSession
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    shipped = spark.sparkContext.broadcast(field.plain())  # plain values;  at most VOCABULARY features and the toxic ones of the training words
    shape = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())]))

    def run(batches):
        model = Field(*shipped.value)
        gains = Gains(model.weights, model.bias)
        for batch in batches:
            col = filled(batch, "text")
            lo = 0
            while lo < batch.num_rows:
                texts, tokens, n = [], [], 0
                while lo + len(texts) < batch.num_rows and n < 200_000:
                    text = col[lo + len(texts)].as_py()
                    texts.append(text)
                    tokens.append(tokens_of(text))
                    n += len(tokens[-1])
                tags = model.tag(tokens, gains)
                cols = [batch.column(0).slice(lo, len(texts)), pa.array(model.score(tags)), pa.array([int((p > 0.5).sum()) for p in tags], pa.int64())]
                if with_spans:
                    found = [spans(t, p) if (p > 0.5).any() else [] for t, p in zip(texts, tags)]
                    cols.append(pa.array([[{"start": a, "stop": b, "p": q} for a, b, q in f] for f in found], shape))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "n_toxic_words", "spans"][: len(cols)])
                lo += len(texts)

    return narrow.mapInArrow(lean(run), f"doc_id {kind}, score double, n_toxic_words long" + ", spans array<struct<start:int,stop:int,p:double>>" * with_spans)


def keep_clean(docs: DataFrame, field: Field, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """docs without those that score `threshold` or more; rows are filtered where they are read."""
    shipped = docs.sparkSession.sparkContext.broadcast(field.plain())
    at = docs.columns.index(text_col)

    def run(batches):
        model = Field(*shipped.value)
        gains = Gains(model.weights, model.bias)
        for batch in batches:
            col = batch.column(at)
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                tags = model.tag([tokens_of(t.as_py() or "") for t in col.slice(lo, 256)], gains)
                yield part.filter(pa.array(model.score(tags) < threshold))

    return docs.mapInArrow(lean(run), docs.schema)


def op1_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = train(docs, table(spark, sf_dir, "labels"))
    out = score(docs, field)
    return out.select("doc_id", F.coalesce(crc_mod3(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_toxic_words", "spans")
