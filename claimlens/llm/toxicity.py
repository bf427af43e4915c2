"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities and counts of a lexicon (general insults, given as a parameter, and words
mined from the labelled sample), hits (counted among them) that show only after undoing digits, symbols and stretched letters, the
nearness of second-person words to hits, rates of capitals, capitalised words, punctuation, exclamation
marks, obfuscated and stretched words. Words are told apart once per distinct word; a text sums
its words' rows. Trees of ``depth`` levels are boosted with log loss on histograms of the features in numpy; an
isotonic regression through the predictions of ``folds`` left-out fits gives the probability.

The sample: about ``per_class`` labelled rows of each class, drawn by a hash of the id, a documented
bound; rows count with the share of their class that was drawn. Its texts stay in the tasks, which send at most
``2 x per_class`` rows of features and ``lexicon_size`` words a lexicon. A word enters the lexicon by the number of
*different words before it* in toxic and clean texts, so that copies of one text count once. The features that
trees and calibration learn from come from lexicons mined without the text's own fold: words that are toxic by chance
then hit clean texts in training too, as they will later.

Defined results: null and empty texts have no words and are scored from features of zero; labels that
are null are not learned from, any other number than 0 is toxic; a document of several labels is learned
from once for each; repeated rows are scored alike; with labels of one class, or none, every text gets that
class's share (0 without labels); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Insults of general use, second-person words, symbols used for letters.
INSULTS = ("idiot idiots moron morons stupid loser losers pathetic worthless disgusting scum trash clown clowns dumb fool jerk ugly garbage "
           "bastard coward creep imbecile filth vermin liar freak dumbass asshole bitch "
           "dummkopf trottel arschloch abschaum depp idiote imbécile connard ordure idiota imbécil estúpido basura").split()
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton tes vous votre tú ti usted ustedes vosotros".split())
SYMBOLS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"})

#: Distinct words a task remembers, their longest length, words that count as near, bytes of text at a time.
REMEMBERED, LONGEST, NEAR, SLICE = 200_000, 64, 5, 2 << 20
_STRETCH = re.compile(r"(.)\1{2,}")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")

#: Columns of a word's row.
HIT, WEIGHT, INSULT, HIDDEN, SECOND, LETTERS, CAPITALS, SHOUTED, MARKS, EXCLAIMED, MIXED, STRETCHED, CHARS = range(13)
#: Columns of a text's row.
FEATURES = ("words", "hits", "hit_rate", "weight_rate", "weight_most", "insults", "insult_rate", "hidden", "hidden_rate", "second_rate", "near_hits",
            "near_rate", "closest", "capital_rate", "shouted_rate", "mark_rate", "exclaimed_rate", "mixed_rate", "stretched_rate")


def core(word: str) -> str:
    """The word in lower case without marks at its ends."""
    return word if word.isalpha() and word.islower() else _EDGE.sub("", word).lower()


def is_training(doc_id: Column) -> Column:
    """Rows whose label may be learned from: crc32 of the id as text, mod 5, is not 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 0


class Words(dict):
    """Rows of distinct words by number; a word's row is made when it first comes."""

    def __init__(self, lexicon: dict[str, float], insults=INSULTS):
        super().__init__()
        self.lexicon, self.insults, self.rows, self.table = lexicon, frozenset(insults), [], np.zeros((0, CHARS + 1), np.float32)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self.table) + len(self.rows)
        self.rows.append(self.row(word))
        return n

    def row(self, word: str) -> list[float]:
        out = [0.0] * (CHARS + 1)
        out[CHARS] = len(word)
        told = core(word)
        weight = self.lexicon.get(told)
        if weight is not None:
            out[HIT], out[WEIGHT] = 1.0, weight
        known = told in self.insults
        out[INSULT], out[SECOND] = float(known), float(told in SECOND_PERSON)
        if told is word:  # small letters only
            out[LETTERS] = len(word)
            if _STRETCH.search(word):
                out[STRETCHED] = 1.0
                self._unhide(out, word, known)
            return out
        letters = sum(map(str.isalpha, word))
        capitals = sum(map(str.isupper, word))
        out[LETTERS], out[CAPITALS], out[SHOUTED] = letters, capitals, float(letters >= 3 and capitals == letters)
        out[MARKS] = sum(not (x.isalnum() or x.isspace()) for x in word)
        out[EXCLAIMED] = word.count("!") + word.count("?")
        inner = [x.isalpha() for x in told]
        out[MIXED] = float(any(inner) and not all(inner))
        out[STRETCHED] = float(bool(_STRETCH.search(told)))
        if out[MIXED] or out[STRETCHED] or any(x in "@$|!013457" for x in word):
            self._unhide(out, word, known)
        return out

    def _unhide(self, out, word, known):
        """Whether the word is a hit once symbols stand for letters, marks are gone and letters are not stretched."""
        if known or out[HIT]:
            return
        for text in (word.lower().translate(SYMBOLS), _EDGE.sub("", word).lower().translate(SYMBOLS), word.lower()):
            plain = "".join(filter(str.isalpha, text))
            for form in (plain, _STRETCH.sub(r"\1", plain), _STRETCH.sub(r"\1\1", plain)):
                if form in self.insults or form in self.lexicon:
                    out[HIDDEN] = 1.0
                    out[HIT], out[WEIGHT] = float(form in self.lexicon), self.lexicon.get(form, 0.0)
                    out[INSULT] = float(form in self.insults)
                    return

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of the texts one after another, and how many each has."""
        if len(self.table) > REMEMBERED:
            self.clear()
            self.table = self.table[:0]
        parts, sizes = [], []
        for text in texts:
            words = text.split()
            parts.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
            sizes.append(len(words))
        if self.rows:
            self.table = np.concatenate([self.table, np.array(self.rows, np.float32)])
            self.rows = []
        for word in [w for w in self if len(w) > LONGEST]:
            del self[word]
        return np.concatenate(parts) if parts else np.empty(0, np.int64), np.array(sizes, np.int64)


def features(texts: list[str | None], words: Words) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    ids, sizes = words.numbers([t or "" for t in texts])
    n = len(sizes)
    doc = np.repeat(np.arange(n), sizes)
    rows = words.table[ids]
    total = lambda c: np.bincount(doc, rows[:, c], minlength=n)
    count = np.maximum(sizes, 1)
    chars, letters = np.maximum(total(CHARS), 1), np.maximum(total(LETTERS), 1)
    found = np.flatnonzero((rows[:, HIT] + rows[:, INSULT] + rows[:, HIDDEN]) > 0)
    spoken = np.flatnonzero(rows[:, SECOND] > 0)
    most = np.zeros(n)
    np.maximum.at(most, doc[found], rows[found, WEIGHT])
    # Distance of every hit to the next second-person word of its text.
    gap = np.full(len(found), 50.0)
    if len(spoken):
        at = np.searchsorted(spoken, found)
        for side in (np.minimum(at, len(spoken) - 1), np.maximum(at - 1, 0)):
            same = doc[spoken[side]] == doc[found]
            gap = np.where(same, np.minimum(gap, np.abs(spoken[side] - found)), gap)
    closest = np.full(n, 50.0)
    np.minimum.at(closest, doc[found], gap)
    near = np.bincount(doc[found], (gap <= NEAR).astype(float), minlength=n)
    hits, insults, hidden = total(HIT), total(INSULT), total(HIDDEN)
    return np.stack([np.log1p(sizes), hits, hits / count, total(WEIGHT) / count, most, insults, insults / count, hidden, hidden / count,
                     total(SECOND) / count, near, near / count, closest, total(CAPITALS) / letters, total(SHOUTED) / count, total(MARKS) / chars,
                     total(EXCLAIMED) / chars, total(MIXED) / count, total(STRETCHED) / count], axis=1)


class Trees:
    """Boosted trees: complete binary trees of one depth, as arrays."""

    def __init__(self, depth: int, base: float):
        self.depth, self.base, self.feature, self.limit, self.value = depth, base, [], [], []

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            out += value[node - (2 ** self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32,
          penalty: float = 1.0, least: float = 3.0) -> Trees:
    """Fit trees to log loss: each split is the best one on histograms of gradients."""
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6))
    trees = Trees(depth, np.log(share / (1 - share)))
    n, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    cell = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)  # value <= edge goes left
    logit = np.full(n, trees.base)
    scale = n / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logit))
        g, h = weight * scale * (p - y), weight * scale * p * (1 - p)
        feature, limit = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            wide = 2 ** level
            local = node - (wide - 1)
            flat = ((local[:, None] * f + np.arange(f)) * bins + cell).ravel()
            size = wide * f * bins
            hist = [np.bincount(flat, np.repeat(v, f), minlength=size).reshape(wide, f, bins) for v in (g, h, np.ones(n))]
            left = [v.cumsum(axis=2) for v in hist]
            all_ = [v[:, :, -1:] for v in left]
            gain = (left[0] ** 2 / (left[1] + penalty) + (all_[0] - left[0]) ** 2 / (all_[1] - left[1] + penalty) - all_[0] ** 2 / (all_[1] + penalty))
            gain[(left[2] < least) | (all_[2] - left[2] < least)] = 0
            for j, e in enumerate(edges):
                gain[:, j, len(e):] = 0
            best = gain.reshape(wide, -1).argmax(axis=1)
            worth = gain.reshape(wide, -1)[np.arange(wide), best] > 1e-9
            for k in np.flatnonzero(worth):
                j, b = divmod(int(best[k]), bins)
                feature[wide - 1 + k], limit[wide - 1 + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > limit[node])
        leaf = node - (2 ** depth - 1)
        sum_g, sum_h = (np.bincount(leaf, v, minlength=2 ** depth) for v in (g, h))
        value = -rate * sum_g / (sum_h + penalty)
        trees.feature.append(feature)
        trees.limit.append(limit)
        trees.value.append(value)
        logit += value[leaf]
    return trees


def isotonic(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising means of ``y`` by pooling neighbours: places on the logit axis and probabilities."""
    order = np.argsort(logit, kind="stable")
    blocks: list[list[float]] = []  # sum of weights, of weighted y, of weighted logits
    for w, t, z in zip(weight[order], y[order], logit[order]):
        blocks.append([w, w * t, w * z])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


class Model:
    """Lexicon, trees and calibration; without trees a constant."""

    def __init__(self, lexicon: dict[str, float], insults, trees: Trees | None, places=None, chances=None, constant: float = 0.0):
        self.lexicon, self.insults, self.trees, self.places, self.chances, self.constant = lexicon, insults, trees, places, chances, constant

    def score(self, texts: list[str | None], words: Words) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.constant)
        return np.clip(np.interp(self.trees.logit(features(texts, words)), self.places, self.chances), 0.0, 1.0)


def mine_lexicons(sample: DataFrame, folds: int, lexicon_size: int, least_share: float) -> list[dict[str, float]]:
    """Words of toxic texts by log odds of their different predecessors (``sample``: toxic, fold, text), without each
    fold in turn, and in the end of all rows. A context (word and predecessor) counts for a lexicon if a fold that it
    may see has it."""
    def contexts(batches):
        for batch in batches:
            for toxic, fold, text in zip(*(batch.column(c).to_pylist() for c in ("toxic", "fold", "text"))):
                told = [core(w) for w in (text or "").split()]
                pairs = {(w, b) for b, w in zip(["", *told], told) if 2 <= len(w) <= LONGEST}
                if pairs:
                    words, before = zip(*pairs)
                    yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([x[:LONGEST] for x in before], pa.string()),
                                                      pa.array([toxic] * len(words), pa.int32()), pa.array([fold] * len(words), pa.int32())],
                                                     names=["word", "before", "toxic", "fold"])

    seen = sample.select("toxic", "fold", "text").mapInArrow(contexts, "word string, before string, toxic int, fold int").groupBy("word", "before", "toxic").agg(
        F.min("fold").alias("lo"), F.max("fold").alias("hi"))
    class_rows = {(r["toxic"], r["fold"]): r["n"] for r in sample.groupBy("toxic", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, only = F.col("toxic") == 1, [(F.col("lo") == k) & (F.col("hi") == k) for k in range(folds)]
    counts = seen.groupBy("word").agg(F.count_if(toxic).alias("bad"), F.count_if(~toxic).alias("good"),
                                      *[F.count_if(toxic & o).alias(f"bad{k}") for k, o in enumerate(only)],
                                      *[F.count_if(~toxic & o).alias(f"good{k}") for k, o in enumerate(only)])
    parts = []
    for k in [*range(folds), None]:
        bad, good = (float(sum(n for (t, f), n in class_rows.items() if t == label and f != k)) for label in (1, 0))
        x, y = (F.col(c) if k is None else F.col(c) - F.col(f"{c}{k}") for c in ("bad", "good"))
        odds = F.log((x + 0.5) / (bad + 1)) - F.log((y + 0.5) / (good + 1))
        parts.append(F.struct(F.lit(folds if k is None else k).alias("k"), odds.alias("odds"), x.alias("bad"), (x >= max(3.0, least_share * bad)).alias("ok")))
    rows = counts.select("word", F.explode(F.array(*parts)).alias("p")).select("word", "p.*").where("ok AND odds >= 2")
    best = Window.partitionBy("k").orderBy(F.col("odds").desc(), F.col("bad").desc(), "word")
    out = [{} for _ in range(folds + 1)]
    for r in rows.withColumn("at", F.row_number().over(best)).where(F.col("at") <= lexicon_size).collect():
        out[r["k"]][r["word"]] = float(r["odds"])
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 3000,
          lexicon_size: int = 200, least_share: float = 0.005, folds: int = 5, rounds: int = 80, depth: int = 3, insults=INSULTS, seed: int = 5) -> Model:
    """Fit on at most about ``per_class`` rows of each class of ``labels``."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) != 0).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model({}, tuple(insults), None, constant=float(next(iter(sizes), 0)))
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = F.broadcast(known.where(draw < share))  # about twice per_class rows
    text = F.col(text_col).cast("string")
    # Equal texts share a fold, so that copies do not vouch for each other.
    sample = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.pmod(F.xxhash64(F.lit(seed + 1), text), F.lit(folds)).cast("int").alias("fold")).join(drawn, "id")
    lexicons = mine_lexicons(sample, folds, lexicon_size, least_share)
    lexicon = lexicons[folds]

    def rows(batches):
        words = [Words(x, insults) for x in lexicons]  # a text's features come from a lexicon that has not seen it
        for batch in batches:
            for i, toxic, k, text in zip(*(batch.column(c).to_pylist() for c in ("id", "toxic", "fold", "text"))):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([toxic], pa.int32()), pa.array([k], pa.int32()),
                                                  pa.array([features([text], words[k])[0].tobytes()], pa.binary())], names=["id", "toxic", "fold", "x"])

    got = sample.select(F.col("id").cast("long"), "toxic", "fold", "text").mapInArrow(rows, "id long, toxic int, fold int, x binary").collect()
    got.sort(key=lambda r: (r["id"], r["toxic"], bytes(r["x"])))
    y = np.array([r["toxic"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return Model(lexicon, tuple(insults), None, constant=float(y[0]) if len(y) else 0.0)
    x = np.array([np.frombuffer(r["x"], np.float64) for r in got])
    weight = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (1 - y).sum())
    fold = np.array([r["fold"] for r in got])
    left_out = np.zeros(len(y))
    for k in range(folds):
        out = fold == k
        fit = ~out
        if out.any():
            left_out[out] = boost(x[fit], y[fit], weight[fit], rounds, depth).logit(x[out]) if 0 < y[fit].sum() < fit.sum() else 0.0
    places, chances = isotonic(left_out, y, weight)
    return Model(lexicon, tuple(insults), boost(x, y, weight, rounds, depth), places, chances)


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs[keep]`` plus ``score`` (0 to 1, rising with toxicity) and ``predicted`` (1 from 0.5 on)."""
    keep = docs.columns if keep is None else keep
    # Columns go by position, so that names may clash.
    width, types = len(keep), [docs.schema[c].dataType for c in keep]
    base = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col(text_col).cast("string").alias("_text"))
    schema = StructType([StructField(f"_{i}", t) for i, t in enumerate(types)]).add("_score", "double").add("_predicted", "integer")
    names = schema.names
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        words = Words(model.lexicon, model.insults)
        for batch in batches:
            sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + SLICE, side="right")))
                part = batch.slice(lo, hi - lo)
                score = model.score(part.column("_text").to_pylist(), words)
                yield pa.RecordBatch.from_arrays([*part.columns[:width], pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=names)
                lo = hi

    return base.mapInArrow(run, schema).toDF(*keep, "score", "predicted")
