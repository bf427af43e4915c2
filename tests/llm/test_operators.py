"""Every dealt operator against plain Python on tables with nulls, empty and very long texts, ties,
repeated rows, hot groups of copies, clashing extra columns, and on empty tables."""

import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from claimlens.llm import (decontam, exact_dedup, langid, mixing, ngram_join, sharding, suffix_dedup,  # noqa: E402
                           superkmer_dedup, tokens_bin, warc)
from claimlens.llm.common import scratch_uri  # noqa: E402
from claimlens.llm.components import connected_components  # noqa: E402

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that operators use themselves
          "size long, g string, kept string, component string, _group string, shard string, contaminated string, score string, target string, payload string")
EXTRA = (None, "x", "y", "z", "u", "v", "w", "s", "t", "p")


def _vocabulary(rng):
    syllables = ["ba", "ti", "on", "ré", "ß", "Lo", "mu", "x", "qu", "é"]
    return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(300)]


def make_rows(seed=1):
    rng = random.Random(seed)
    vocab = _vocabulary(rng)
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    passage, line = text(70), text(12)
    rows = [(None, text(30)), (None, None), (0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "One"), (5, "one two three")]
    rows += [(10 + i, text(rng.randint(1, 120))) for i in range(60)]
    base = text(120)
    rows += [(100 + i, base if i % 3 else base.upper()) for i in range(40)]  # a hot group of copies
    for i in range(40):  # near copies, some of them far apart from each other
        w = base.split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, f"{text(20)}\n{passage}  {text(20)}") for i in range(8)]
    rows += [(320 + i, f"{line} {line} {text(5)}") for i in range(8)]
    rows += [(340, text(6000)), (341, "a" * 5000), (342, "a" * 5000 + "b"), (343, "ab" * 400), (344, "tok  en \n \n x   "), (345, " <|endoftext|> 　 y")]
    rows += [(50, rows[48][1]), (5, "one two three"), (346, "日本 語 テキスト"), (347, "123 !!"), (348, passage), (349, "\0\0 nul")]
    rng.shuffle(rows)
    return rows


ROWS = make_rows()
LANGS = ["en", "fr", None]


def frame(spark, rows):
    full = [(i, t, LANGS[k % 3], [None, "s1", "S2", "é", "s1", "s1"][k % 6], 1, *EXTRA) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def docs(spark):
    from claimlens.llm.common import staged
    return staged(frame(spark, ROWS), "test-docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))


def test_exact_dedup(docs, empty):
    got = exact_dedup.exact_dedup(docs, first_block=4, growth=4).collect()
    same([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got],
         [(i, k, n, kept or (i is None and k is None), h) for i, k, n, kept, h in brute.exact(ROWS)])
    assert exact_dedup.exact_dedup(empty).collect() == []


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_ngram_join(docs, empty, width, percent):
    got = ngram_join.jaccard_components(docs, width=width, percent=percent, chunk_bytes=3000).collect()
    same([(r.doc_id, r.n_shingles, r.component_id) for r in got], brute.components(ROWS, width, percent))
    per = defaultdict(list)
    for r in got:
        if r.component_id is not None:
            per[r.component_id].append(r.kept)
    # repeated rows without words are components of their own
    assert all(sum(v) == 1 for c, v in per.items() if c not in (0, 1, 2))
    assert ngram_join.jaccard_components(empty).collect() == []


def test_ngram_join_random(spark):
    rng = random.Random(5)
    for _ in range(1):
        base = [" ".join(rng.choices("abcdefgh", k=30)) for _ in range(4)]
        rows = []
        for i in range(120):
            w = rng.choice(base).split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice("abcdefghij")
            rows.append((i, " ".join(w)))
        got = ngram_join.jaccard_components(frame(spark, rows), width=2, percent=80, chunk_bytes=1000).collect()
        same([(r.doc_id, r.n_shingles, r.component_id) for r in got], brute.components(rows, 2, 80))


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(61)} | {100: 100, 150: 100, 200: 100}


def test_masks_cover():
    masks = decontam.covering_masks(12, 2, 6)
    for a in range(12):
        for b in range(a):
            assert any(not {s + o for o in m} & {a, b} for m in masks for s in range(12 - m[-1]))


def test_decontamination(spark, empty):
    rng = random.Random(3)
    vocab = _vocabulary(rng)
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, text(rng.randint(12, 40))) for i in range(12)] + [(20, None), (21, "a b"), (22, text(7)), (None, text(15)), (0, text(14))]
    rows = [*ROWS]
    for i in range(80):
        w = rng.choice([t for _, t in items if t]).split()
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        a = rng.randint(0, 6)
        rows.append((500 + i, f"{text(rng.randint(0, 9))} {' '.join(w[a:])}\n{text(rng.randint(0, 9))}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(rows, items, 12, 2)
    assert 20 < sum(b for _, b in want) < 70
    for block_words in (2_000_000, 100):  # one block and several
        got = decontam.find_leaks(frame(spark, rows), bench, block_words=block_words).collect()
        same([(r.doc_id, r.contaminated) for r in got], want)
    assert decontam.find_leaks(empty, bench).collect() == []
    assert not any(r.contaminated for r in decontam.find_leaks(frame(spark, rows), bench.limit(0)).collect())


def test_mixing(docs, empty):
    got = mixing.mix_sources(docs).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    rows = {}
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        rows[r.source] = max(rows.get(r.source, 0), r["size"])
        assert r.taken in {r["size"] * k for k in range(4)}
    want = brute.targets(sizes, (5.0, 2.0, 1.0), 3.0)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s in sizes:  # rows of one id share a hash
        assert abs(taken[s] - want[s]) <= 2 * rows[s]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ROWS)
    assert [tuple(r) for r in sorted(got, key=repr)] == [tuple(r) for r in sorted(mixing.mix_sources(docs).collect(), key=repr)]
    assert mixing.mix_sources(empty).collect() == []
    mixed = mixing.take_mix(docs)
    assert mixed.columns == docs.columns


def test_mixing_caps(spark):
    rows = [(i, "w " * n, None, s, 1, *EXTRA) for i, (s, n) in enumerate([("a", 1), ("b", 100), ("b", 100), ("c", 3), (None, 0)])]
    got = {r.source: r.target for r in mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute.targets({"a": 1, "b": 200, "c": 3, None: 0}, (5.0, 2.0, 1.0), 3.0)
    assert got == pytest.approx(want)


def test_tokens_round_trip(spark, docs, empty):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    file = public_tokenizers.path("byte_bpe_50k.json")
    path = scratch_uri(spark, "tokens")
    got = tokens_bin.read_tokens(tokens_bin.write_tokens(docs, path, file), path).collect()
    t = Tokenizer.from_file(file)
    encoded = [(i, np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, x in ROWS]
    same([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], [(i, len(b) // 4, zlib.crc32(b)) for i, b in encoded])
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    path = scratch_uri(spark, "tokens")
    assert tokens_bin.read_tokens(tokens_bin.write_tokens(empty, path, file), path).collect() == []


def test_warc_round_trip(spark):
    rng = random.Random(2)
    pages = [(i, f"http://h/{i}?q=é\r\nx", "<p>" + "ab\r\n\r\n" * rng.randint(0, 5) + "</p>") for i in range(60)]
    pages += [(3, "u", "dup"), (3, "u", "dup"), (70, None, "dup"), (71, None, None), (72, "", ""), (None, "n", "dup"), (None, "n", "only"), (73, "big", "x" * 300_000)]
    df = spark.createDataFrame([(*p, "a", "b") for p in pages], "page_id long, url string, html string, payload string, sha1 string").repartition(3)
    for start in (0, 10):
        path = scratch_uri(spark, "warc")
        manifest = warc.write_warc(df, path, revisit_from=start, roll_bytes=2000)
        assert manifest.count() > 3  # rolled
        got = warc.read_warc(manifest, path).collect()
        same([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], brute.warc([(i, h) for i, _, h in pages], start))
        same([(r.page_id, bytes(r.payload)) for r in got if r.record_type == "response"],
             [(i, (h or "").encode()) for (i, _, h), w in zip(pages, brute.warc([(i, h) for i, _, h in pages], start)) if w[3] == "response"])
    path = scratch_uri(spark, "warc")
    assert warc.read_warc(warc.write_warc(df.limit(0), path), path).collect() == []


@pytest.mark.parametrize("length, k", [(50, 20), (9, 4)])
def test_suffix_dedup(docs, empty, length, k):
    got = suffix_dedup.suffix_dedup(docs, length=length, k=k, chunk_bytes=3000).collect()
    same(got, brute.suffix(ROWS, length))
    assert suffix_dedup.suffix_dedup(empty).collect() == []


@pytest.mark.parametrize("length, k", [(50, 10), (5, 2)])
def test_substring_dedup(docs, empty, length, k):
    got = superkmer_dedup.substring_dedup(docs, length=length, k=k, chunk_bytes=3000).collect()
    same(got, brute.substring(ROWS, length))
    assert superkmer_dedup.substring_dedup(empty).collect() == []


@pytest.mark.parametrize("words", [False, True])
def test_hot_minimisers_split(spark, words):
    """A passage in many documents: none of its minimisers may bring one string per document to one
    bucket, and the windows at its edges still come out right."""
    from claimlens.llm import windows
    rng = random.Random(6)
    vocab = _vocabulary(rng)
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    passage, flank = text(40), [text(6) for _ in range(30)]
    rows = [(i, f"{rng.choice(flank)} {text(2)} {passage} {text(3)} {rng.choice(flank)}") for i in range(300)]
    rows += [(300, "a " * 3000), (301, "a " * 2000), (4, rows[9][1]), (None, rows[8][1])]
    length, k, most = (12, 4, 4000) if words else (50, 20, 4000)
    inner = superkmer_dedup._word_classes(length) if words else suffix_dedup._byte_classes(length)

    def classes(strings):
        assert sum(map(len, strings)) <= 2 * most
        return inner(strings)

    result, schema, want = ((superkmer_dedup._result(length), superkmer_dedup.RESULT, brute.substring) if words else
                            (suffix_dedup._result(length), suffix_dedup.RESULT, brute.suffix))
    got = windows.smallest_ids(frame(spark, rows), "doc_id", "text", words, length, k, classes, result, schema,
                               chunk_bytes=9000, hot_bytes=most).collect()
    same(got, want(rows, length))


def test_hot_minimisers_of_odd_rows(docs):
    same(suffix_dedup.suffix_dedup(docs, length=9, k=4, chunk_bytes=3000, hot_bytes=200).collect(), brute.suffix(ROWS, 9))
    same(superkmer_dedup.substring_dedup(docs, length=5, k=2, chunk_bytes=3000, hot_bytes=200).collect(), brute.substring(ROWS, 5))


def test_interval_classes_are_equal_contexts():
    import numpy as np
    rng = np.random.default_rng(0)
    for alphabet, length in ((2, 6), (3, 11), (1, 5), (200, 50)):
        text = rng.integers(0, alphabet, 400).astype(np.uint8)
        ring = np.concatenate([text, np.resize(text, length)])
        cls = suffix_dedup.interval_classes(text, length)
        pairs = {(ring[i:i + length].tobytes(), int(cls[i])) for i in range(len(text))}
        assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


def test_language_id(spark, docs, empty):
    rng = random.Random(9)
    make = {"en": ["the", "and", "thing", "shore", "ation"], "fr": ["le", "eaux", "était", "çon", "ment"]}
    rows = [(i, " ".join(rng.choices(make[lang], k=rng.randint(3, 40))), lang) for i in range(400) for lang in [("en", "fr")[i % 2]]]
    df = spark.createDataFrame([(i, t, lang, "s", 1, *EXTRA) for i, t, lang in rows], SCHEMA)
    model = langid.train(df.where(langid.is_training(df.doc_id)), per_language=100)
    held = langid.identify(df.where(~langid.is_training(df.doc_id)).drop("score"), model).collect()
    assert len(held) > 50 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert not any(r.rejected for r in held)
    got = langid.identify(docs.drop("score"), model, keep=["doc_id", "text"]).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und")
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
    assert langid.identify(empty.drop("score"), model).collect() == []
    assert langid.train(empty) is None
    assert {r.lang_pred for r in langid.identify(docs.drop("score"), None).collect()} == {"und"}


def test_sharding(docs, empty):
    got = sharding.shard_documents(docs, shards=6, cells=4).collect()
    texts = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ROWS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == texts
    slots, size, where, group = defaultdict(list), Counter(), defaultdict(set), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        size[r.shard] += r["size"]
        where[r.text_crc32].add(r.shard)
        group[r.text_crc32] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in where.values())
    big = max(group.values())
    mean = sum(size.values()) / 6
    assert max(size.values()) <= max(big, mean * 1.02)
    assert sharding.shard_documents(empty).collect() == []


def test_sharding_rounds(spark, monkeypatch):
    """Cells grow with the groups and the driver's share does not; copies stay together, shards even."""
    assert sharding.cell_rounds(12_000_000, 64, 4096) == [2930, 64]
    assert sharding.cell_rounds(10**10, 64, 4096)[1:] == [38147, 597, 64]
    assert sharding.cell_rounds(100, 64, 4096) == [64] and sharding.cell_rounds(0, 4, 9) == [4]
    monkeypatch.setattr(sharding, "FAN", 4)
    assert sharding.cell_rounds(300, 2, 8) == [38, 10, 3, 2]
    rng = random.Random(7)
    rows = [(i, "x" * rng.randint(1, 900) + str(i % 300)) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(20)] + [(2000 + i, rows[i][1]) for i in range(50)]
    seen, inner = [], sharding.difference
    monkeypatch.setattr(sharding, "difference", lambda partials: seen.append(len(partials)) or inner(partials))
    got = sharding.shard_documents(frame(spark, rows), shards=4, cells=2, pieces=8, per_cell=8).collect()
    assert seen and max(seen) <= 2 * 8 + 4 * sharding.LARGE  # on the driver
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    where, slots, size = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        where[r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
        size[r.shard] += r["size"]
    assert all(len(v) == 1 for v in where.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len(size) == 4 and max(size.values()) <= 1.02 * sum(size.values()) / 4


def test_differencing_is_tight():
    rng = random.Random(4)
    sums, where = sharding.difference([(rng.randint(1, 10**6), 0, 0, 0) for _ in range(2000)])
    assert max(sums) - min(sums) < 50
    assert sharding.difference([(5, 0)])[0] == (5, 0)


def test_near_duplicates_of_odd_ids(spark):
    """Rows of one id, or of none, with different texts are rows of their own."""
    import corpus_pipeline as P
    rng = random.Random(11)
    text = lambda: " ".join("".join(rng.choices("abcdefg", k=4)) for _ in range(40))
    t = [text() for _ in range(7)]
    rows = [(1, t[0]), (1, t[1]), (2, t[1] + " x"), (2, t[2]), (None, t[3]), (None, t[3]), (None, t[4]), (5, t[4] + " y"), (None, t[5]), (6, t[6]), (6, t[6])]
    got = [(r.doc_id, r.text) for r in P.near_duplicates(spark, frame(spark, rows), "").select("doc_id", "text").collect()]
    same(got, [(1, t[0]), (1, t[1]), (2, t[2]), (None, t[3]), (5, t[4] + " y"), (None, t[5]), (6, t[6])])


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P
    rng = random.Random(8)
    make = {"en": ["the", "and", "thing", "shore", "ation", "of"], "fr": ["le", "eaux", "était", "çon", "ment", "du"]}
    text = lambda lang, n: " ".join(rng.choice(make[lang]) + rng.choice(make[lang]) for _ in range(n))
    rows = [(i, text(("en", "fr")[i % 2], 40), ("en", "fr")[i % 2], f"s{i % 3}", 1) for i in range(200)]
    item = text("en", 20)
    rows += [(1000 + i, rows[3][1], "fr", "s0", 1) for i in range(30)] + [(2000, f"{text('en', 9)} {item} {text('en', 9)}", "en", "s1", 1), (3000, None, None, None, 0), (3, rows[3][1], "fr", "s0", 1)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = P.run(spark, folder).collect()
    ids = Counter(r.doc_id for r in got)
    assert not {2000, 3000} & set(ids) and not [i for i in ids if 1000 <= i < 2000]
    assert set(ids) <= set(range(200)) and max(ids.values()) <= 3 and len(ids) > 100
    assert {r.shard for r in got} <= set(range(24))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        stage(spark, docs.limit(0), folder).collect()
    assert P.STAGES[-1][1](spark, docs.limit(0), folder).collect() == []
    odd = docs.selectExpr("*", "1 AS rejected", "'x' AS contaminated", "2 AS _mix_n", "3 AS size", "4 AS stay", "5 AS nth", "6 AS times")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, odd, folder).columns == odd.columns
