"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features: densities of a seed lexicon and of words and word beginnings learned from the labels, second-person
proximity of their hits, capitals, punctuation and obfuscation rates.  The model is fitted on a bounded sample
of labelled rows (``max_toxic`` and ``max_clean``, taken in the order of a hash of doc_id): half for the lexicon,
a third for the trees, the rest for the calibration, each class dealt evenly to the three.  Every document's whole text is scored.

Null and empty texts score 0.  Repeated rows, and rows that share a doc_id, are scored each by its own text; repeated labels of a doc_id count
once, as toxic if one says so; labels without a doc_id or a verdict don't count.  A score that ties with the threshold is toxic.  Where there aren't
six labelled texts of either class no trees can be fitted: then the seed lexicon alone decides (``unlabelled="seed"``: a text is
toxic if a twenty-fifth of its words or more are hits), or ``unlabelled="raise"`` raises.  An empty table has no scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing as H
from .common import bounded, durable, fresh

SEED = "idiot idiots moron morons loser losers scum trash stupid pathetic worthless disgusting clown clowns dumb imbecile jerk bastard bitch asshole fuck fucking shit crap damn hate kill ugly vermin filth garbage retard freak pig dämlich dumm idioten arschloch trottel abschaum wertlos dreck connard salaud imbécile débile ordure minable abruti idiota estúpido imbécil basura escoria inútil patético asqueroso".split()
YOU = "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos usted ustedes tú ti tus vosotros vuestro".split()
NEAR, BEGINNINGS, PARTS = 5, (4, 5, 6, 7), 6
_LEET = np.arange(256, dtype=np.uint8)
for _a, _b in zip(b"013457@$!", b"oieastasi", strict=True):
    _LEET[_a] = _b
_LEET_WORDS = H.WORDS.copy()
_LEET_WORDS[list(b"@$!")] = 1


@dataclass
class Lexicon:
    seed: np.ndarray
    words: np.ndarray
    begins: dict[int, np.ndarray]
    you: np.ndarray


FEATURES = ["seed", "learned", "begins", "leet", "hits", "near_you", "you", "capitals", "exclaims", "marks", "mixed", "repeats", "length"]


def _begin_hashes(t: H.Tokens, k: int) -> np.ndarray:
    return H.part_hash(t.prefix, t.start, np.minimum(t.start + k, t.end))


def features(texts: pa.Array, lex: Lexicon) -> np.ndarray:
    out = np.zeros((len(texts), len(FEATURES)))
    low = H.slices(texts)
    raw = H.slices(texts, lower=False)
    for col, s in ((0, low), (1, raw)):
        for part in s:
            n = len(part)
            block = out[part.first : part.first + n]
            if not col:
                t = H.tokenise(part)
                total = np.maximum(1, H.per_doc(t.doc, n))
                seed, word = H.is_in(t.hash, lex.seed), H.is_in(t.hash, lex.words)
                begin = np.zeros(len(t.hash), bool)
                for k, table in lex.begins.items():
                    begin |= H.is_in(_begin_hashes(t, k), table) & (t.end - t.start >= k)
                leet = H.tokenise(part, _LEET_WORDS, translate=_LEET)
                raw_digits = np.add.reduceat(np.r_[(part.data >= 48) & (part.data <= 57) | np.isin(part.data, [64, 36, 33]), False].astype(np.int64), leet.start) if len(leet.start) else np.zeros(0)
                # reduceat runs to the next token's start: digits between tokens are tokens themselves
                disguised = (H.is_in(leet.hash, lex.seed) | H.is_in(leet.hash, lex.words)) & (raw_digits > 0) & (leet.end - leet.start > 2)
                hit = seed | word | begin
                you = np.flatnonzero(H.is_in(t.hash, lex.you))
                close = np.zeros(len(hit), bool)
                at = np.flatnonzero(hit)
                if len(you) and len(at):
                    i = np.searchsorted(you, at)
                    for j in (np.clip(i - 1, 0, len(you) - 1), np.clip(i, 0, len(you) - 1)):
                        close[at] |= (np.abs(you[j] - at) <= NEAR) & (t.doc[you[j]] == t.doc[at])
                for j, flags in enumerate((seed, word, begin)):
                    block[:, j] = H.per_doc(t.doc[flags], n) / total
                block[:, 3] = H.per_doc(leet.doc[disguised], n) / total
                block[:, 4] = np.log1p(H.per_doc(t.doc[hit], n) + H.per_doc(leet.doc[disguised], n))
                block[:, 5] = H.per_doc(t.doc[close], n) / total
                block[:, 6] = H.per_doc(t.doc[you], n) / total
                letters = (part.data >= 97) & (part.data <= 122)
                digit = np.r_[0, np.cumsum((part.data >= 48) & (part.data <= 57))]
                alpha = np.r_[0, np.cumsum(letters)]
                both = (digit[t.end] > digit[t.start]) & (alpha[t.end] > alpha[t.start])
                block[:, 10] = H.per_doc(t.doc[both], n) / total
                block[:, 12] = np.log1p(H.per_doc(t.doc, n))
            else:
                d, o = part.data, part.offsets
                size = np.maximum(1, np.diff(o))
                rate = lambda flags: np.diff(np.r_[0, np.cumsum(flags)][o]) / size  # noqa: E731, B023
                block[:, 7] = rate((d >= 65) & (d <= 90))
                block[:, 8] = rate((d == 33) | (d == 63))
                block[:, 9] = rate(H.WORDS_AND_MARKS[d] == 2)
                same = np.zeros(len(d), bool)
                same[2:] = (d[2:] == d[1:-1]) & (d[2:] == d[:-2]) & (d[2:] < 128) & (H.WORDS[d[2:]] > 0)
                block[:, 11] = rate(same)
    return out


# ---------------------------------------------------------------- model


class Trees:
    """Boosted regression trees on the logistic loss, over quantile bins."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, least: int = 5, l2: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.l2 = rounds, depth, rate, bins, least, l2
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        cuts = [np.unique(np.r_[c, 0.0, np.quantile(v[v > 0], [0.1, 0.25, 0.5])]) if (v > 0).any() else c for c, v in zip(cuts, x.T, strict=True)]
        b = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-f))
            g, h = y - q, q * (1 - q)
            node = np.zeros(len(y), int)
            tree = []
            for level in range(self.depth):
                for k in range(2**level - 1, 2 ** (level + 1) - 1):
                    rows = node == k
                    best = (1e-9, 0, np.inf, 0)
                    if rows.sum() >= 2 * self.least:
                        gt, ht = g[rows].sum(), h[rows].sum()
                        for j, c in enumerate(cuts):
                            m = len(c) + 1
                            gl = np.cumsum(np.bincount(b[rows, j], g[rows], m))[:-1]
                            hl = np.cumsum(np.bincount(b[rows, j], h[rows], m))[:-1]
                            nl = np.cumsum(np.bincount(b[rows, j], minlength=m))[:-1]
                            if not len(gl):
                                continue
                            gain = gl**2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt**2 / (ht + self.l2)
                            gain[(nl < self.least) | (rows.sum() - nl < self.least)] = 0
                            i = int(gain.argmax())
                            if gain[i] > best[0]:
                                best = (gain[i], j, c[i], i)
                    tree.append((best[1], best[2]))
                    go = rows & (x[:, best[1]] > best[2])
                    node[rows] = 2 * k + 1
                    node[go] = 2 * k + 2
            leaf = node - (2**self.depth - 1)
            m = 2**self.depth
            value = self.rate * np.bincount(leaf, g, m) / (np.bincount(leaf, h, m) + self.l2)
            self.trees.append((tree, value))
            f += value[leaf]
        return self

    def decide(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        for tree, value in self.trees:
            node = np.zeros(len(x), int)
            feature, cut = np.array([t[0] for t in tree]), np.array([t[1] for t in tree])
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            f += value[node - len(tree)]
        return f


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; knots for interpolation."""
    order = np.argsort(score, kind="stable")
    s, pools = score[order], []
    for a, v in zip(s, y[order].astype(float), strict=True):
        pools.append([v, 1.0, a, a])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            v2, n2, _, hi = pools.pop()
            v1, n1, lo, _ = pools.pop()
            pools.append([(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2, lo, hi])
    xs = np.array([x for p in pools for x in (p[2], p[3])])
    return xs, np.repeat([p[0] for p in pools], 2)


@dataclass
class SeedModel:
    """What decides without labels: the density of seed words, plain or disguised."""

    lexicon: Lexicon
    certain: float = 0.08

    def probability(self, texts: pa.Array) -> np.ndarray:
        x = features(texts, self.lexicon)
        return np.minimum(1.0, (x[:, FEATURES.index("seed")] + x[:, FEATURES.index("leet")]) / self.certain)


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    xs: np.ndarray
    ys: np.ndarray

    def probability(self, texts: pa.Array) -> np.ndarray:
        x = features(texts, self.lexicon)
        p = np.interp(self.trees.decide(x), self.xs, self.ys)
        p[x[:, -1] == 0] = 0.0
        return p


def _count_beginnings(batches):
    """Document frequencies among toxic and clean documents, of words (size 0) and word beginnings."""
    schema = pa.schema([("size", pa.int32()), ("hash", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])
    for batch in batches:
        y = batch.column("toxic").to_numpy(zero_copy_only=False)
        parts = []
        for s in H.slices(batch.column("text")):
            t = H.tokenise(s)
            for k in (0, *BEGINNINGS):
                h, doc = t.hash, t.doc
                if k:
                    long = t.end - t.start >= k
                    h, doc = _begin_hashes(t, k)[long], doc[long]
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, bool)
                parts.append((np.full(first.sum(), k), h[first], y[s.first + doc[first]]))
        if parts:
            size, h, tox = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((h, size))
            size, h, tox = size[order], h[order], tox[order]
            at = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (size[1:] != size[:-1])]) if len(h) else np.zeros(0, int)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(size[at], pa.int32()), pa.array(h[at].view(np.int64)), pa.array(np.add.reduceat(tox, at).astype(np.int64)), pa.array(np.add.reduceat(1 - tox, at).astype(np.int64))], schema=schema)


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = 3000, max_clean: int = 9000, unlabelled: str = "seed") -> Model | SeedModel:
    if unlabelled not in ("seed", "raise"):
        raise ValueError("unlabelled is seed or raise")
    y = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    y = y.withColumn("h", F.xxhash64("doc_id", F.lit("toxicity")))
    pick = y.where("toxic = 1").orderBy("h", "doc_id").limit(max_toxic).union(y.where("toxic = 0").orderBy("h", "doc_id").limit(max_clean))
    sample = bounded(docs).select("doc_id", "text").join(F.broadcast(pick), "doc_id").where("text is not null")
    turn = F.row_number().over(Window.partitionBy("toxic").orderBy("h", "doc_id", F.xxhash64("text"))) - 1  # of the bounded sample
    sample = durable(sample.select("text", "toxic", F.pmod(turn, F.lit(PARTS)).cast("int").alias("part")))
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(n.get(0, 0), n.get(1, 0)) < PARTS:
        if unlabelled == "raise":
            raise ValueError(f"{PARTS} labelled texts of each class are needed; there are {n}")
        return SeedModel(Lexicon(H.hashes_of(SEED), H.hashes_of([]), {}, H.hashes_of(YOU)))
    first = sample.where("part < 3")
    m = {r["toxic"]: r["n"] for r in first.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    nt, nc = m.get(1, 0) + 1, m.get(0, 0) + 1
    counts = first.select("text", "toxic").mapInArrow(_count_beginnings, "size int, hash long, toxic long, clean long").groupBy("size", "hash").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    rate_t, rate_c = (F.col("t") + 0.5) / nt, (F.col("c") + 0.5) / nc
    base = np.log((nt + nc) / nt)
    # at least four toxic documents at the usual base rate; hardly any clean one
    words = counts.where((F.col("t") * base > 8.5) & (F.col("t") >= 3) & (rate_t > 12 * rate_c)).select("size", "hash").collect()
    by = {k: np.unique(np.array([r["hash"] for r in words if r["size"] == k], dtype=np.int64).view(np.uint64)) for k in (0, *BEGINNINGS)}
    lex = Lexicon(H.hashes_of(SEED), by[0], {k: by[k] for k in BEGINNINGS}, H.hashes_of(YOU))
    schema = "toxic int, part int, x array<double>"

    def rows(batches):
        for b in batches:
            x = features(b.column("text"), lex)
            yield pa.RecordBatch.from_arrays([b.column("toxic"), b.column("part"), pa.array(list(x), pa.list_(pa.float64()))], names=["toxic", "part", "x"])

    table = sample.where("part >= 3").select("text", "toxic", "part").mapInArrow(rows, schema).toArrow()  # bounded by max_toxic + max_clean
    x, t, part = np.array(table.column("x").to_pylist()), table.column("toxic").to_numpy(), table.column("part").to_numpy()
    order = np.lexsort((*x.T, t, part))
    x, t, part = x[order], t[order], part[order]
    fit = part < 5
    trees = Trees().fit(x[fit], t[fit])
    return Model(lex, trees, *isotonic(trees.decide(x[~fit]), t[~fit]))


def _probability(docs: DataFrame, model: Model | SeedModel):
    shared = bounded(docs).sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.probability(texts))

    return probability("text")


def scored(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """(doc_id, probability) of every row."""
    return docs.select("doc_id", _probability(docs, train(docs, labels, **params)).alias("probability"))


def toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **params) -> DataFrame:
    """(doc_id, probability) of the rows at or over the threshold."""
    return scored(docs, labels, **params).where(F.col("probability") >= threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **params) -> DataFrame:
    """The rows of ``docs`` under the threshold, all columns as they are."""
    model = train(docs, labels, **params)
    p = fresh(docs, "probability")
    return docs.withColumn(p, _probability(docs, model)).where(F.col(p) < threshold).drop(p)
