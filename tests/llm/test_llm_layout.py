"""Fill-in-middle, sharding and the conversation trie against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import fill_middle, prefix_trie, shard_shuffle
from quern.session import scratch_path

# 11 -----------------------------------------------------------------------------------------

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_middle(doc, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNITS.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def texts():
    random = np.random.default_rng(11)
    words = ["a", "ü", "日本", "<", "<P", ">", "S>", "\x1c", "\xa0", "x" * 300, "\n", "  \t", "word"]
    made = ["".join(random.choice(words, k) + random.choice(["", " ", "\r\n"], k)) for k in random.integers(0, 900, 120)]
    made += [None, "", " ", " \n\t ", "one", " one", "one ", "a <P> b", "a<M>", "<S>", "x" * 400_000, " " * 70_000]
    made += ["long text of words " * 150_000, "a b c", "a b c"]
    return [(i, t) for i, t in enumerate(made)] + [(None, "no id here"), (3, made[3])]


@pytest.fixture(scope="module")
def cut(spark, texts):
    rows = [(i, t, "v", 5, "f", 1) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, N string, output int, form string, c0 int").repartition(4)


def test_every_text_is_cut_as_by_the_plain_version(cut, texts):
    found = fill_middle.fill_middle(cut)
    assert found.columns == ["doc_id", "text", "c0", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found.collect())
    assert got == Counter((i, *plain_middle(i, t)) for i, t in texts)
    assert {f for _, _, f, *_ in got} == {"plain", "psm", "spm"}
    for r in fill_middle.digest(found).collect():
        text = dict(texts)[r.doc_id] or ""
        assert r.restored_sha256 == sha(text) and r.output_sha256 == sha(plain_middle(r.doc_id, text)[4])


def test_no_texts_no_cuts(cut):
    assert fill_middle.fill_middle(cut.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_rank_index_is_exact(seed):
    random = np.random.default_rng(seed)
    steps = [random.integers(0, 9, 20_000), random.geometric(0.001, 5_000), np.ones(3_000, int), np.zeros(50, int)]
    steps += [np.concatenate([random.integers(1, 6, 400), [10**6], random.integers(1, 6, 400)]), np.zeros(0, int)]
    places = np.concatenate([[0], np.cumsum(steps[seed])]).astype(np.int64)
    index = fill_middle.RankIndex(places)
    assert index.residual.dtype == np.int8 and (index.places(np.arange(len(places))) == places).all()
    assert np.abs(index.residual.astype(int)).max() <= 127
    if seed in (0, 2):
        assert len(index.first) < len(places) / 100  # segments, not a copy of the places


# 12 -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def records(spark):
    rows = [(i, f"text {i} " * (i % 40), "a") for i in range(400)] + [(7, "same", "b")] * 300
    rows += [(None, None, None)] * 9 + [(900, "x" * 200_000, "c"), (901, "", "c"), (None, "x", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, Shard string")


def shards(spark, records, **options):
    path = scratch_path(spark, "shards-test")
    manifest = shard_shuffle.shuffle_to_shards(records, path, shards=7, bucket_bytes=9_000, **options)
    return manifest, shard_shuffle.read_shards(spark, path)


def test_shards_hold_every_row_once_and_evenly(spark, records):
    manifest, made = shards(spark, records)
    assert made.columns == ["doc_id", "text", "slot", "shard"]
    rows = made.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in records.collect())
    held = defaultdict(list)
    for r in rows:
        held[r.shard].append(r.slot)
    assert sorted(held) == list(range(7)) and all(sorted(v) == list(range(len(v))) for v in held.values())
    assert max(map(len, held.values())) - min(map(len, held.values())) <= 1
    # The files of a shard follow each other, and a file's rows lie in their order.
    for r in manifest.collect():
        lines = spark.read.parquet(r.file).coalesce(1).collect()
        assert [x.slot for x in lines] == list(range(r.first_slot, r.first_slot + r.rows))
    for r in shard_shuffle.digest(made).collect():
        assert r.law == "rows" and r.grown_shard is None
    by_id = {r.doc_id: r for r in shard_shuffle.digest(made).where("doc_id >= 900").collect()}
    assert (by_id[901].size, by_id[901].text_crc32) == (16, 0)
    assert (by_id[900].size, by_id[900].text_crc32) == (200_016, zlib.crc32(b"x" * 200_000))


def test_order_depends_on_seed_and_rows_alone(spark, records):
    place = lambda made: Counter((r.doc_id, r.text, r.shard, r.slot) for r in made.collect())
    once, other = place(shards(spark, records.repartition(3))[1]), place(shards(spark, records.repartition(8, "doc_id"))[1])
    assert once == other
    assert once != place(shards(spark, records, seed=5)[1])
    # Copies of one row scatter like other rows: 301 of 713, about 43 a shard.
    copies = Counter(shard for (doc, text, shard, _) in once if text == "same")
    assert len(copies) == 7 and min(copies.values()) > 20


def test_an_empty_table_gives_no_shards(spark, records):
    manifest, made = shards(spark, records.limit(0))
    assert manifest.count() == 0 and made.count() == 0


def test_shuffle_is_uniform(spark):
    """Every row is as likely in every quarter of the order."""
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    seen = np.zeros((4, 4))
    for seed in range(3):
        path = scratch_path(spark, "shards-test")
        shard_shuffle.shuffle_to_shards(rows, path, shards=4, seed=seed, bucket_bytes=1_000)
        for r in shard_shuffle.read_shards(spark, path).collect():
            seen[r.doc_id // 100, r.shard] += 1
    assert ((seen - 75) ** 2 / 75).sum() < 27.9  # chi-square, 9 degrees, 0.1 %


# 13 -----------------------------------------------------------------------------------------


def plain_trie(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(x[2], x[3]) for x in sorted(v)] for c, v in given.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * words
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], sha(",".join(map(str, sorted(ends[p])))))
        for p, m in members.items()
    )


def talks():
    random = np.random.default_rng(13)
    rows = []
    for c in range(400):
        for t in range(int(random.integers(1, 9))):
            rows.append((c, t, random.choice(["user", "assistant"]), str(random.choice(["hi", "yes  no", "", " a b c "]))))
    for c in range(1000, 1300):  # copies of one conversation
        rows += [(c, t, "user", f"copy {t}") for t in range(6)]
    rows += [(2000, t, "user", f"t {t}") for t in range(40)] + [(2001, t, "user", f"t {t}") for t in range(43)]
    rows += [(2002, t, "user", f"t {t}") for t in range(30)] + [(2020, t, "user", f"t {t}") for t in range(40)]
    rows += [(5000 + c, 0, "user", "only") for c in range(8)]  # shorter than their own heads; no base
    rows += [(3000, 1, None, None), (3000, 1, "", ""), (3000, None, "x", "first"), (3000, 1, "a", "tie"), (3000, 1, "a", "tie")]
    return rows + [(None, 0, "user", "nobody"), (None, None, None, None)]


@pytest.fixture(scope="module")
def talk_rows():
    return talks()


@pytest.mark.parametrize(("band", "count"), [(512, 1), (512, 8), (3, 1), (3, 8), (1, 5)])
def test_trie_equals_the_plain_version(spark, talk_rows, band, count):
    table = spark.createDataFrame([(*r, 1) for r in talk_rows], "conv_id long, turn long, role string, text string, depth int")
    found = prefix_trie.prefix_trie(table.repartition(5), band=band, shards=count)
    assert Counter(tuple(r) for r in found.collect()) == plain_trie(talk_rows)


def test_copies_of_one_conversation_spread_over_shards(spark, talk_rows):
    """The skeleton takes the hot path: no shard holds most of its members."""
    table = spark.createDataFrame([r for r in talk_rows if (r[0] or 0) >= 1000], "conv_id long, turn long, role string, text string")
    rows, deep = prefix_trie.bands(*prefix_trie.rebuilt(*prefix_trie.numbered_turns(table)), 512)
    cuts = prefix_trie.splitters(rows, 8)
    scanned = prefix_trie.scan(rows.withColumns({c: F.lit(0).cast("long") for c in ("leaves", "saved")}), cuts, 512)
    hot = scanned.where("kind = 1 AND depth = 6").groupBy("key").agg(F.count("*").alias("shards"), F.max("n").alias("most")).orderBy("most").collect()
    assert not deep and len(cuts) == 7 and hot[-1].shards > 3 and hot[-1].most < 150


def test_no_conversations_no_nodes(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(empty).collect() == []
