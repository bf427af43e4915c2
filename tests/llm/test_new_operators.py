"""The conversation trie, collocations and toxicity against plain Python."""

import os
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from claimlens.llm import collocations, prefix_trie, toxicity  # noqa: E402

TURNS = "conv_id long, turn long, role string, text string, key string, c long, n string, seg string, ids string"


def same(got, want):
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))


def make_turns(seed=3):
    """Few distinct turns, so that conversations share prefixes; a hot first turn, copies, one long
    conversation, nulls, ties, repeated rows and negative ids."""
    rng = random.Random(seed)
    said = ["hello", "", None, "ä😀", "yes", "no " * 400]
    rows = []
    for c in [*range(-3, 130), 200, 205, 299, 301, 1000]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, "user" if t % 2 == 0 else rng.choice(["assistant", None]), "hello" if t == 0 and c % 3 else rng.choice(said)))
    for c in range(2000, 2040):  # copies
        rows += [(c, t, "user", f"turn {t}") for t in range(7)]
    for c in (3000, 3001, 3002, 3007):  # long ones with a long common prefix
        rows += [(c, t, "user", f"step {t if t < 150 + c % 100 else -t}") for t in range(200 + c % 10)]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (7, None, "user", "first"), (8, 3, "user", "tie"), (8, 3, "user", "tie"), (8, 3, "a", "b")]
    rng.shuffle(rows)
    return rows


def turn_frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "w") for r in rows], TURNS).repartition(parts)


@pytest.mark.parametrize("segment, rebuild", [(512, True), (3, True), (7, False)])
def test_conversation_trie(spark, segment, rebuild):
    rows = make_turns()
    got = prefix_trie.conversation_trie(turn_frame(spark, rows), segment, rebuild).collect()
    same(got, brute.trie(rows, rebuild))


def test_conversation_trie_small_blocks(spark, monkeypatch):
    """Many trees and packs give the nodes of one."""
    rows = make_turns(5)
    pieces = prefix_trie.rebuilt_pieces(prefix_trie.ordered_pieces(turn_frame(spark, rows, 40), 4))
    got = prefix_trie.trie_nodes(pieces.repartition(9), 4).collect()
    same(got, brute.trie(rows))


def test_conversation_trie_empty(spark):
    got = prefix_trie.conversation_trie(spark.createDataFrame([], TURNS))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got.collect() == []


def test_radix_tree_layouts():
    """Random keys, prefixes of each other among them, come back through every node layout."""
    rng = random.Random(1)
    keys = [bytes(rng.choices(range(256), k=rng.choice([2, 3]))) for _ in range(3000)]
    keys += [k[:1] for k in keys[:200]] + [b"\0" * 40, b"\0" * 41, b"\0" * 20 + b"\1"]
    root = prefix_trie.tree(keys)
    found, layouts = {}, set()

    def visit(node, path):
        layouts.add(node.layout)
        for i in node.ends:
            found[i] = path
        for b in range(256):
            kid = node.child(b)
            if kid is not None:
                visit(kid, path + bytes([b]) + kid.path)
    visit(root, root.path)
    assert [found[i] for i in range(len(keys))] == keys
    assert layouts == {4, 16, 48, 256}


DOCS = "doc_id long, text string, lang string, source string, word string, w1 string, a string, score string, predicted string, toxic string, id string, bucket string"


def doc_frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, lang, "s", *"abcdefgh") for i, t, lang in rows], DOCS).repartition(parts)


def make_texts(seed=2):
    rng = random.Random(seed)
    vocab = ["the", "of", "new", "york", "city", "a-b", "é", "日本", "x" * 300, "Hot", "dog"] + [f"w{i}" for i in range(30)]
    weights = [30, 20, 8, 7, 6, 3, 3, 3, 1, 4, 4] + [1] * 30
    rows = []
    for i in range(150):
        words = rng.choices(vocab, weights, k=rng.randint(0, 60))
        for phrase in ("New York City", "new york", "hot dog", "of the"):
            if rng.random() < 0.4:
                words.insert(rng.randint(0, len(words)), phrase)
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! ", "\r", "\x0b"]) for w in words), rng.choice(["en", "en", "fr", None, "und"])))
    rows += [(500 + i, "one very common line of words", "en") for i in range(200)]  # a hot group of copies
    rows += [(None, "the of the of", "en"), (1, None, None), (2, "", ""), (3, " \t ", "fr"), (4, "only.", "de"), (5, "a\u00a0b \0 z", "fr"), (6, "go " * 4000, "es")]
    return rows


@pytest.mark.parametrize("per_bucket, chunk", [(2_000_000, 2_000_000), (40, 300)])
def test_collocations(spark, monkeypatch, per_bucket, chunk):
    monkeypatch.setattr(collocations, "SLICE", 50)
    rows = make_texts()
    got = collocations.collocations(doc_frame(spark, rows), per_bucket=per_bucket).collect()
    same(got, brute.collocations([(lang, t) for _, t, lang in rows]))


def test_collocations_top_and_thresholds(spark):
    rows = make_texts(4)
    got = collocations.collocations(doc_frame(spark, rows, 9), min_count=3, subsumed_percent=80, top=5).collect()
    same(got, brute.collocations([(lang, t) for _, t, lang in rows], 3, 80, 5))
    assert collocations.collocations(doc_frame(spark, rows[:0])).collect() == []


def test_collocation_chunks(monkeypatch):
    """Chunks and hot prefixes: stripes of small chunks, dealt to several buckets, add up to plain counts."""
    rows = [(lang or "und", t) for _, t, lang in make_texts()]
    batch = collocations.pa.RecordBatch.from_pydict({"lang": [x[0] for x in rows], "text": [(x[1] or "").encode() for x in rows]})
    monkeypatch.setattr(collocations, "CHUNK", 100)
    got = {}
    for lang, words, ids in collocations._chunks([batch]):
        assert ids[-1] == 0
        for w, n in zip(words, np.bincount(ids, minlength=len(words))):
            if w != b".":
                got[lang, w.decode()] = got.get((lang, w.decode()), 0) + int(n)
    want = {}
    for lang, t in rows:
        for w in brute.re.findall(r"[^\x20\x09.,;:!?\x0a-\x0d]+", brute.lower(t or "")):
            want[lang, w] = want.get((lang, w), 0) + 1
    assert got == want
    everything = np.full(1 << 10, 2 ** 64 - 1, np.uint64)
    h = np.sort(collocations.word_hashes("en", [b"the", b"of"]))
    know = collocations.Known(everything, h, np.array([5, 3]), 7)
    assert know.frequent(h).all() and know.parts(h).tolist() == [5, 3] and know.parts(h + np.uint64(1)).tolist() == [1, 1]

    class Shared:
        value = know
    messages = [m for m in collocations._messages(1, Shared)([batch])]
    sent = sorted((b, lang, w, r) for m in messages for b, lang, w, r in zip(*(m.column(c).to_pylist() for c in ("bucket", "lang", "words", "rows"))))
    table = {c: [s[i] for s in sent] for i, c in enumerate(("bucket", "lang", "words", "rows"))}
    pairs = {}
    for out in collocations._merge(1, 1)([collocations.pa.RecordBatch.from_pydict(table)]):
        for r in out.to_pylist():
            assert (r["lang"], r["w1"], r["w2"]) not in pairs
            pairs[r["lang"], r["w1"], r["w2"]] = (r["a"], r["l"])
    wanted = {(r[0], *r[2].split(" ")): r[3] for r in brute.collocations([(lang, t) for lang, t in rows], 1, 10 ** 9, 10 ** 9) if len(r[2].split(" ")) == 2}
    assert {k: v[0] for k, v in pairs.items()} == wanted
    assert all(v[1] == want[k[0], k[1]] for k, v in pairs.items())


def test_collocation_score(spark):
    """Products far beyond 64 bits, and the floor just below a whole number."""
    rows = [(10 ** 13, 10 ** 13, 10 ** 13), (10 ** 15 - 1, 10 ** 15, 10 ** 15), (999_999_999_999, 3 * 10 ** 14, 7 * 10 ** 14), (10, 10, 10), (10, 10 ** 9, 10 ** 9)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select(collocations.score("a", "l", "r")).collect()
    assert [r[0] for r in got] == [10 ** 6 * a * a // (l * r) for a, l, r in rows]


def test_word_hashes_are_sparks(spark):
    words = ["", "a", "abcdefg", "日本語 ", "x" * 100]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64(F.concat(F.lit("en\t"), "w"))).collect()
    assert [r[0] for r in got] == collocations.word_hashes("en", [w.encode() for w in words]).view(np.int64).tolist()


def make_toxic(seed=6, n=600):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeimnorst", k=rng.randint(2, 8))) for _ in range(400)]
    rude = ["zorg", "blarf", "idiot", "quux"]
    rows = []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randint(5, 80))
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(rude))
        rows.append((i, " ".join(words), "en", toxic))
    return rows


def test_toxicity(spark):
    """Held-out accuracy, equal scores of equal texts, hidden words, edge rows, and clean texts left alone."""
    rows = make_toxic()
    labels = spark.createDataFrame([(i, toxic, "x", 1.0) for i, _, _, toxic in rows] + [(None, 1, "x", 1.0), (3, None, "x", 1.0)], "doc_id long, toxic int, text string, score double")
    clean = " ".join(rows[1][1].split())
    extra = [(None, None, None), (9000, "", None), (9001, "123 !!", "en"), (9002, clean + " id1ot", "en"), (9003, clean + " you ZORG!!!", "fr"), (9004, clean + " idddiot", "en"),
             (9005, "a" * 100_000, "en"), (9006, clean, "en"), (9006, clean, "de"), (9007, clean * 200, "en")]
    docs = doc_frame(spark, [r[:3] for r in rows] + extra)
    model = toxicity.train(docs, labels.where(toxicity.is_training(F.col("doc_id"))))
    assert {"zorg", "blarf", "quux", "idiot"} <= set(model.lexicon)
    out = toxicity.score_texts(docs, model)
    assert out.columns[-2:] == ["score", "predicted"] and out.columns[:len(docs.columns)] == docs.columns
    assert {r[0]: r[7] for r in out.collect() if r[0] == 3} == {3: "d"}
    got = toxicity.score_texts(docs.select("doc_id", "text"), model, keep=["doc_id"]).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    held = [(by[i].predicted, toxic) for i, _, _, toxic in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 80 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert by[9002].predicted == by[9003].predicted == by[9004].predicted == 1
    assert by[9006].predicted == by[9007].predicted == by[9000].predicted == by[None].predicted == by[9005].predicted == 0
    again = toxicity.train(docs, labels.where(toxicity.is_training(F.col("doc_id"))))
    assert (again.chances == model.chances).all() and again.lexicon == model.lexicon
    assert toxicity.score_texts(docs.limit(0), model).collect() == []


def test_toxicity_without_classes(spark):
    docs = doc_frame(spark, [(1, "some text", "en"), (2, None, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for labels, want in ((none, 0.0), (one, 1.0)):
        assert [r[-2] for r in toxicity.score_texts(docs, toxicity.train(docs, labels)).collect()] == [want, want]


def test_isotonic_and_trees():
    rng = np.random.default_rng(1)
    z, y, w = rng.normal(size=300), rng.integers(0, 2, 300).astype(float), rng.random(300) + 0.5
    places, chances = toxicity.isotonic(z, y, w)
    assert (np.diff(chances) > 0).all() and (np.diff(places) > 0).all()
    # pooled means are the best rising fit: by the min-max formula
    order = np.argsort(z)
    y, w = y[order], w[order]
    mean = lambda a, b: (y[a:b] * w[a:b]).sum() / w[a:b].sum()
    best = [max(min(mean(a, b) for b in range(i + 1, 61)) for a in range(i + 1)) for i in range(60)]
    places, chances = toxicity.isotonic(np.arange(60.0), y[:60], w[:60])
    sizes = np.searchsorted(chances, np.array(best) - 1e-12)
    assert np.allclose(chances[sizes], best)
    # an exclusive-or needs two levels
    x = rng.random((800, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = toxicity.boost(x, y, np.ones(800), 60, 3)
    x = rng.random((400, 3))
    assert (((trees.logit(x) > 0) == ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5))).mean()) > 0.93


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1/labels.parquet"), reason="no test tables")
def test_toxicity_on_tables(spark):
    from claimlens.llm import queries
    got = {r.doc_id: r for r in queries.op13_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = [(got[r.doc_id].score, r.toxic) for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if got[r.doc_id].held_out]
    bad, good = [s for s, t in labels if t], [s for s, t in labels if not t]
    auc = sum((a > b) + 0.5 * (a == b) for a in bad for b in good) / (len(bad) * len(good))
    assert auc > 0.97 and sum(s < 0.5 for s in good) >= 0.98 * len(good)


def test_suffix_order_and_expansion():
    """The order is that of whole rotations, whatever the length; the expansion alone makes the classes."""
    from claimlens.llm.suffix_dedup import interval_classes, suffix_order
    rng = np.random.default_rng(3)
    for n, letters in [(1, 1), (2, 1), (7, 2), (9, 1), (40, 2), (120, 3), (300, 26)]:
        for periodic in (False, True):
            text = np.resize(rng.integers(97, 97 + letters, 3 if periodic else n).astype(np.uint8), n)
            whole = text.tobytes()
            assert suffix_order(text).tolist() == sorted(range(n), key=lambda i: (whole[i:] + whole[:i], i))
            ring = np.resize(text, n + 60).tobytes()
            counts = set()
            for length in (1, 2, 3, 8, 9, 50):
                cls = interval_classes(text, length).tolist()
                strings = [ring[i:i + length] for i in range(n)]
                assert len(set(zip(strings, cls))) == len(set(strings)) == len(set(cls))
                counts.add(len(set(cls)))
            assert n < 40 or periodic or len(counts) > 2  # one order, other classes for other lengths


def test_language_rejection(spark):
    """Texts in no learned language are rejected however sure the softmax is; clean held-out rows stay."""
    from claimlens.llm import langid
    rng = random.Random(8)
    parts = {"en": "the of and ing tion er re at on ed es or th ha in".split(), "fr": "le de que ou eau ment tion é è elle re ai en ch".split(),
             "de": "der die und sch ein ung ver heit lich keit ch en er ä".split()}
    text = lambda lang, n: " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(n))
    rows = [(i, text(lang, rng.randint(8, 80)), lang) for i, lang in enumerate(rng.choices(list(parts), k=600))]
    train, rest = rows[:400], rows[400:]
    model = langid.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    strange = ["Suomen kesä on lyhyt mutta kaunis, ja ihmiset viettävät paljon aikaa järven rannalla mökillä perheen ja ystävien kanssa saunoen.",
               "Wczoraj wieczorem poszliśmy do kina na nowy film, który opowiada historię młodego człowieka szukającego swojego miejsca.",
               "今天天气很好我们一起去公园散步看到很多孩子在草地上玩耍老人们在树下下棋聊天 今天天气很好我们一起去公园散步",
               "brtk xzvq plmn wrtg sdfk jklq zxcv bnmq wrty plkj brtk xzvq plmn wrtg sdfk jklq zxcv bnmq wrty plkj",
               "def main(argv): for i in range(len(argv)): if argv[i].startswith('--'): opts[argv[i][2:]] = argv[i+1]; return subprocess.call(cmd, shell=True)",
               " ".join(f"{rng.getrandbits(128):032x}" for _ in range(12))]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rest] + [(10_000 + i, t) for i, t in enumerate(strange)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert sum(got[i].lang_pred == lang and not got[i].rejected for i, _, lang in rest) >= 0.99 * len(rest)
    assert all(got[10_000 + i].rejected for i in range(len(strange)))


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1/documents.parquet"), reason="no test tables")
def test_language_rejection_on_tables(spark):
    """Nearly all held-out rows of the tables stay and are right."""
    from claimlens.llm import langid
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.train(docs.where(langid.is_training(F.col("doc_id"))))
    held = langid.identify(docs.where(~langid.is_training(F.col("doc_id"))).select("doc_id", "text", "lang"), model)
    n, right, kept = held.agg(F.count(F.lit(1)), F.count_if(F.col("lang") == F.col("lang_pred")), F.count_if(~F.col("rejected"))).first()
    assert right >= 0.99 * n and kept >= 0.99 * n


def test_token_cache_is_bounded_by_bytes():
    """Texts without spaces, long pieces and many short ones leave the cache below its bound; ids stay those of the library."""
    import public_tokenizers

    from claimlens.llm.tokens_bin import LONGEST, Encoder
    rng = random.Random(4)
    coder = Encoder(public_tokenizers.path("byte_bpe_50k.json"), cache_bytes=60_000)
    texts = ["".join(chr(0x4e00 + rng.randrange(3000)) for _ in range(500)) for _ in range(20)]
    texts += [" ".join("".join(rng.choices("abcdé.,!\\n\\t", k=rng.randint(0, 9))) for _ in range(300)) for _ in range(40)]
    texts += ["", " ", "  ", "a  b", "a \\n b", " lead", "trail ", "x" * 3000, "\\u0120 a \\u0120b", "it's we'll  don't"]
    for lo in range(0, len(texts), 7):
        part = texts[lo:lo + 7]
        got = coder.encode(part)
        assert [np.frombuffer(b, f"<u{coder.width}").tolist() for b in got] == [e.ids for e in coder.tokenizer.encode_batch(part, add_special_tokens=False)]
        assert coder.held == sum(len(p) + len(b) + 200 for p, b in coder.known.items()) <= 60_000
        assert max(map(len, coder.known), default=0) <= LONGEST


def test_token_shards_roll_and_are_read_in_parallel(spark):
    """Small shards, several of a partition: bases go on over all of them, and each is a task of its own."""
    import public_tokenizers

    from claimlens.llm import tokens_bin
    from claimlens.llm.common import scratch_uri
    rows = [(i, f"text number {i} " * (i % 30)) for i in range(400)]
    path, file = scratch_uri(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json")
    manifest = tokens_bin.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, file, roll_bytes=4000)
    n = manifest.count()
    assert n > 8 and manifest.where("part > 0").count() > 0
    read = tokens_bin.read_tokens(manifest, path)
    assert read.rdd.getNumPartitions() == n
    got = read.orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == list(range(400))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]


def test_warc_files_are_read_in_parallel(spark):
    from claimlens.llm import warc
    from claimlens.llm.common import scratch_uri
    path = scratch_uri(spark, "warc")
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " + "z" * 500 * (i % 3)) for i in range(300)], "page_id long, url string, html string")
    manifest = warc.write_warc(pages, path, roll_bytes=2000)
    n = manifest.count()
    assert n > 8
    read = warc.read_warc(manifest, path)
    assert read.rdd.getNumPartitions() == n and read.count() == 300


def test_hot_text_is_split(spark):
    """A third of all documents are one text: the join that hands a group's result back is split."""
    from claimlens.llm import windows
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        docs = spark.range(0, 30_000, 1, 16).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("chunk"), F.col("id").cast("int").alias("row"),
                                                   F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).cast("binary").alias("print"))
        out = windows.skip_messages(docs, later=True)
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_interval_expansion_counts_only_for_parted_neighbours(monkeypatch):
    """Neighbours that stay neighbours one byte on need no count over all rows for every byte."""
    import numpy as np

    from claimlens.llm import suffix_dedup
    part = np.random.default_rng(5).integers(0, 250, 500).astype(np.uint8)
    text = np.concatenate([part, [250], part, [251]]).astype(np.uint8)
    calls, plain = [], np.cumsum
    monkeypatch.setattr(suffix_dedup.np, "cumsum", lambda *a, **k: calls.append(1) or plain(*a, **k))
    cls = suffix_dedup.interval_classes(text, 50)
    assert len(calls) < 12  # one for every byte before
    assert cls[:451].tolist() == cls[501:952].tolist() and len(set(cls[:501].tolist())) == 501
