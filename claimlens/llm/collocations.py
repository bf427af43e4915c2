"""Phrase collocations by the stripes pattern.

A stripe is the counter of a prefix's next words, with the prefix's own total. Tasks count the stripes
of a chunk of documents, pack them into one message for each bucket, and a bucket merges the stripes of one
prefix element by element. Prefixes have one word, then two:

* words are counted first (the counter of the empty prefix, a plain aggregate);
* one-word prefixes give the phrases of two words, with the total of their first word;
* two-word prefixes give the phrases of three words, with the total of their first two; the largest
  count of an extension to the right is the maximum of a stripe, to the left that of the words after it.

A phrase of ``min_count`` occurrences consists of parts that have as many, so stripes leave out words
after which nothing of that count can come: tasks ask a bit table of hashes of the words (then phrases)
that reach it. Its size follows their number up to ``MOST_BITS``; a hash that collides costs work, never a
phrase. Totals count all occurrences. A prefix with more than its share of all words is dealt to
several buckets by the hash of the next word, each with the total; their number is derived from counted
words at every size. Arithmetic is exact: counts are longs, products decimals of 38 digits.

Defined results: a null language counts as ``und`` and is one with that label; null and empty texts have no
words; repeated rows and ids count each time; ties of score and count are ordered by phrase; an
empty table gives an empty result; other columns are not read. The word numbers of one document (4
bytes a word) are held in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import mix, staged

#: Words of a chunk, bytes of text split at once, words a bucket may expect, bits of the table at most.
CHUNK, SLICE, PER_BUCKET, MOST_BITS = 2_000_000, 1 << 20, 2_000_000, 1 << 30
_PIECES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz .........")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
NO_NEXT = -1


class _Numbers(dict):
    """A number for every word, given out as words come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _split(text: bytes):
    """Words of a text, some megabytes at a time; a full stop stands for every end of a piece."""
    text = text.translate(_PIECES).replace(b".", b" . ")
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _chunks(batches):
    """(language, words, numbers of the words in order) of some ``CHUNK`` words; number 0 ends a piece."""
    held, size = {}, 0

    def flush():
        for lang, (numbers, parts) in held.items():
            yield lang, list(numbers), np.concatenate(parts)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            if lang not in held:
                held[lang] = (_Numbers({b".": 0}), [])
            numbers, parts = held[lang]
            for words in _split(text):
                parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                size += len(words)
            parts.append(np.zeros(1, np.int32))
            if size >= CHUNK:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """What ``xxhash64(concat(lang, tab, word))`` gives in Spark."""
    head = lang.encode() + b"\t"
    return np.fromiter((xxhash.xxh64_intdigest(head + w, 42) for w in words), np.uint64, len(words))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _A + second * _B)


class Known:
    """What tasks know of the shorter phrases: a bit table of those that reach the count, and the hashes of
    those with more than a bucket's share of all words, with the number of buckets for each."""

    def __init__(self, bits: np.ndarray, hot: np.ndarray, slices: np.ndarray, buckets: int):
        self.bits, self.hot, self.slices, self.buckets = bits, hot, slices, buckets

    def frequent(self, h: np.ndarray) -> np.ndarray:
        slot = h & np.uint64(len(self.bits) * 64 - 1)
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0

    def parts(self, h: np.ndarray) -> np.ndarray:
        """Buckets that each prefix is dealt to."""
        out = np.ones(len(h), np.int64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
            hit = self.hot[at] == h
            out[hit] = self.slices[at[hit]]
        return out

    def bucket(self, h: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Parts of a prefix go to buckets side by side, so that no two of them share one."""
        return ((mix(h) % np.uint64(self.buckets)).astype(np.int64) + part) % self.buckets


def known(spark, phrases: DataFrame, buckets: int, words: int, most_bits: int = MOST_BITS) -> Known:
    """From the hashes ``h`` and counts ``f`` of phrases that reach the count (at most ``most_bits / 64``
    numbers and one row a bucket come to the driver)."""
    n, size = phrases.count(), 1 << 16
    while size < min(16 * n, most_bits):
        size *= 2
    slot = F.col("h").bitwiseAND(F.lit(size - 1))
    got = phrases.select(F.shiftright(slot, 6).alias("at"), F.expr("shiftleft(1L, cast(h & 63 AS INT))").alias("bit")).groupBy("at").agg(
        F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    share = F.ceil(F.col("f") * F.lit(float(buckets) / max(words, 1)))
    hot = phrases.select("h", F.least(share.cast("long"), F.lit(buckets)).alias("s")).where("s > 1").toArrow()
    h, s = hot.column("h").to_numpy().view(np.uint64), hot.column("s").to_numpy()
    order = np.argsort(h)
    return Known(bits, h[order], s[order], buckets)


def _counted(code: np.ndarray):
    return np.unique(code, return_counts=True) if len(code) else (code, np.empty(0, np.int64))


def _entries(level: int, ids: np.ndarray, h: np.ndarray, know: Known):
    """Stripes of a chunk: prefix columns, prefix hashes and totals; for each entry its prefix, next word, count."""
    v = np.int64(len(h))
    a = ids.astype(np.int64)
    if level == 1:
        ok = know.frequent(h)
        ok[0] = False
        count = np.bincount(ids, minlength=len(h))
        prefix = np.flatnonzero(ok & (count > 0))
        rank = np.cumsum(ok & (count > 0)) - 1
        both = np.flatnonzero(ok[a[:-1]] & ok[a[1:]])
        code, n = _counted(rank[a[both]] * v + a[both + 1])
        return [prefix], h[prefix], count[prefix], code // v, code % v, n
    with np.errstate(over="ignore"):
        pair = pair_hashes(h[a[:-1]], h[a[1:]])
    ok = (a[:-1] > 0) & (a[1:] > 0) & know.frequent(pair)
    at = np.flatnonzero(ok)
    code = a[at] * v + a[at + 1]
    prefix, first, total = np.unique(code, return_index=True, return_counts=True) if len(code) else (code, code, code)
    tri = np.flatnonzero(ok[:-1] & ok[1:])
    rank = np.searchsorted(prefix, a[tri] * v + a[tri + 1])
    found, n = _counted(rank * v + a[tri + 2])
    return [prefix // v, prefix % v], pair[at[first]] if len(at) else pair[:0], total, found // v, found % v, n


def _messages(level: int, shared):
    """Chunks to packed stripes, one row for each bucket."""
    def run(batches):
        know = shared.value
        for lang, words, ids in _chunks(batches):
            h = word_hashes(lang, words)
            prefix, ph, total, of, follow, n = _entries(level, ids, h, know)
            parts = know.parts(ph)
            whole = np.repeat(np.arange(len(ph)), parts)  # the total goes to each part of a prefix
            part = np.arange(len(whole)) - np.repeat(np.cumsum(parts) - parts, parts)
            part = np.concatenate([part, (h[follow] % parts[of].astype(np.uint64)).astype(np.int64)])
            of = np.concatenate([whole, of])
            rows = np.stack([*(p[of] for p in prefix), np.concatenate([np.full(len(whole), NO_NEXT), follow]), np.concatenate([total[whole], n])])
            bucket = know.bucket(ph[of], part)
            order = np.argsort(bucket, kind="stable")
            bucket, rows = bucket[order], rows[:, order]
            edge = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
            out = [[], [], []]
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                part_rows = rows[:, lo:hi].copy()
                used, at = np.unique(part_rows[:-1], return_inverse=True)
                none = int(used[0] == NO_NEXT)
                part_rows[:-1] = at.reshape(part_rows[:-1].shape) - none  # numbers of this message; -1 stays
                for x, value in zip(out, (int(bucket[lo]), b" ".join([words[i] for i in used[none:].tolist()]), part_rows.astype("<i4").tobytes())):
                    x.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array([lang] * len(out[0]), pa.string()), pa.array(out[1], pa.binary()),
                                                  pa.array(out[2], pa.binary())], names=["bucket", "lang", "words", "rows"])
    return run


def _merged(level: int, messages, min_count: int):
    """Stripes of one bucket and language, added up: words, columns of phrases, counts, totals of the prefix."""
    numbers, parts = _Numbers(), []
    for words, rows in messages:
        to = np.fromiter(map(numbers.__getitem__, words.split(b" ")), np.int64) if words else np.empty(0, np.int64)
        rows = np.frombuffer(rows, "<i4").reshape(level + 2, -1)
        got = rows.astype(np.int64)
        got[:-1] = np.where(rows[:-1] >= 0, to[rows[:-1]] if len(to) else -1, NO_NEXT)
        parts.append(got)
    rows = np.concatenate(parts, axis=1)
    v = len(numbers) + 1
    prefix = rows[0] if level == 1 else np.unique(rows[0] * v + rows[1], return_inverse=True)[1]
    code = prefix * v + rows[level] + 1  # a prefix's total comes first in its stripe
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    count = np.add.reduceat(rows[-1][order], first)
    code, rows = code[first], rows[:, order[first]]
    stripe = np.maximum.accumulate(np.where(code % v == 0, np.arange(len(code)), 0))
    keep = np.flatnonzero((code % v > 0) & (count >= min_count))
    return list(numbers), rows[:-1, keep], count[keep], count[stripe[keep]]


def _merge(level: int, min_count: int):
    """Sorted messages to the phrases that reach the count."""
    names = ["lang", *[f"w{i + 1}" for i in range(level + 1)], "a", "l", "h"]

    def emit(lang, messages):
        words, cols, a, l = _merged(level, messages, min_count)
        h = np.zeros(len(a), np.uint64)
        if level == 1 and len(a):
            hashes = word_hashes(lang, words)
            with np.errstate(over="ignore"):
                h = pair_hashes(hashes[cols[0]], hashes[cols[1]])
        text = pa.array(words, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), *[text.take(pa.array(c)) for c in cols], pa.array(a, pa.int64()),
                                          pa.array(l, pa.int64()), pa.array(h.view(np.int64))], names=names)

    def run(batches):
        key, held = None, []
        for batch in batches:
            for bucket, lang, words, rows in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lang", "words", "rows"))):
                if (bucket, lang) != key:
                    if held:
                        yield from emit(key[1], held)
                    key, held = (bucket, lang), []
                held.append((words, rows))
        if held:
            yield from emit(key[1], held)
    return run


def _word_rows(batches):
    for lang, words, ids in _chunks(batches):
        n = np.bincount(ids, minlength=len(words))[1:]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(words[1:], pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                                         names=["lang", "word", "f"])


def score(a: str, l: str, r: str):  # noqa: E741
    """floor(1000000 a a / (l r)) in decimals of 38 digits."""
    d = lambda x: f"CAST({x} AS DECIMAL(38,0))"
    return F.expr(f"({d(a)} * {d(a)} * {d('1000000')}) div ({d(l)} * {d(r)})")


def _first_rows(df: DataFrame, group: str, order: list, top: int, spread: int, salt: str) -> DataFrame:
    """The first ``top`` rows of each group with their ``rank``; rows are first ranked within hash parts of a
    group, of which at most ``top`` rows each go on, 16 parts into one."""
    parts = max(spread, 1)
    while True:
        by = Window.partitionBy(group, F.pmod(F.xxhash64(salt), F.lit(parts))).orderBy(*order)
        df = df.withColumn("rank", F.row_number().over(by).cast("long")).where(F.col("rank") <= top)
        if parts == 1:
            return df
        parts //= 16
        parts = max(parts, 1)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, subsumed_percent: int = 50,
                 top: int = 2000, per_bucket: int = PER_BUCKET) -> DataFrame:
    """The ``top`` phrases of two and three words of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    spark = docs.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))
    words = staged(texts.mapInArrow(_word_rows, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    all_words = words.agg(F.sum("f")).first()[0] or 0
    buckets = max(spread, -(-all_words // per_bucket))
    often = words.where(F.col("f") >= min_count)

    def phrases(level, shorter):
        shared = spark.sparkContext.broadcast(known(spark, shorter, buckets, all_words))
        sent = texts.mapInArrow(_messages(level, shared), "bucket int, lang string, words binary, rows binary")
        fields = ", ".join(f"w{i + 1} string" for i in range(level + 1))
        return staged(sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang").mapInArrow(
            _merge(level, min_count), f"lang string, {fields}, a long, l long, h long"), f"phrases{level + 1}")

    two = phrases(1, often.select(F.xxhash64(F.concat("lang", F.lit("\t"), "word")).alias("h"), "f"))
    three = phrases(2, two.select("h", F.col("a").alias("f")))
    of = lambda word, name: often.select("lang", F.col("word").alias(word), F.col("f").alias(name))
    # The largest count of a longer phrase that holds the two words.
    longer = three.select("lang", "w1", "w2", "a").unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")).groupBy(
        "lang", "w1", "w2").agg(F.max("a").alias("longer"))
    pairs = two.join(of("w2", "r"), ["lang", "w2"]).join(longer, ["lang", "w1", "w2"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < subsumed_percent * F.col("a")))
    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", score("a", "l", "r").alias("score"))
    rest = two.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"))
    triples = three.join(of("w3", "r"), ["lang", "w3"]).join(of("w1", "l1"), ["lang", "w1"]).join(rest, ["lang", "w2", "w3"])
    triples = triples.withColumn("s1", score("a", "l1", "r1")).withColumn("s2", score("a", "l", "r"))
    cut = F.col("s1") <= F.col("s2")
    triples = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(cut, F.col("l1")).otherwise(F.col("l")).alias("l"),
                             F.when(cut, F.col("r1")).otherwise(F.col("r")).alias("r"), F.least("s1", "s2").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    best = _first_rows(pairs.unionByName(triples), "lang", order, top, spread, "phrase")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(min_count: int = 10, subsumed_percent: int = 50, top: int = 2000) -> str:
    """The same phrases in DuckDB's SQL, from lists of words."""
    return f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
i AS (SELECT lang, unnest(list_transform(range(1, len(ws) + 1), lambda x: ws[x:x + 2])) AS three FROM w),
g AS (SELECT lang, three[1:k] AS gram, k, count(*) AS f FROM i, (VALUES (1), (2), (3)) AS s(k) WHERE len(three) >= k GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM g WHERE k > 1 AND f >= {min_count}),
cuts AS (SELECT c.lang, c.gram, c.f AS a, l.k AS cut, l.f AS l, r.f AS r, (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS score
  FROM c, (VALUES (1), (2)) AS s(after) JOIN g AS l ON l.lang = c.lang AND l.gram = c.gram[1:after] JOIN g AS r ON r.lang = c.lang AND r.gram = c.gram[after + 1:]
  WHERE after < c.k),
b AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1),
longer AS (SELECT lang, gram, max(f) AS f FROM (SELECT lang, gram[1:2] AS gram, f FROM c WHERE k = 3 UNION ALL SELECT lang, gram[2:3], f FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.lang, array_to_string(b.gram, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM b LEFT JOIN longer ON longer.lang = b.lang AND longer.gram = b.gram
  WHERE longer.f IS NULL OR 100 * longer.f < {subsumed_percent} * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {top}"""
