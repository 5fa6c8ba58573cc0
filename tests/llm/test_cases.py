"""Cases that once went wrong: clashing names, sparse blocks, odd archives, hot keys."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import bloom, common, exact_dedup, mixing, near_dedup

NAMES = ("t1", "t2", "other", "row", "name", "id", "h", "size", "rank", "s", "draw", "place", "shard", "class_id", "kept", "group_size", "bucket", "node", "__id", "words", "source_size")


@pytest.fixture(scope="module")
def clash(spark):
    base = " ".join(f"alpha{i} beta{i}" for i in range(120))
    rows = [(1, base, "a"), (2, base.replace("alpha60", "x"), "a"), (3, base, "b"), (3, base, "b"), (None, "lone words here", None), (5, None, "a"), (6, "", "b"), (None, "lone words here", None), (8, "w " * 500, "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("x") for c in NAMES}).repartition(3)


def test_clashing_names(clash):
    ids = lambda rows: sorted((r.doc_id is None, r.doc_id or 0) for r in rows)
    exact = exact_dedup.exact_dedup(clash)
    assert exact.columns == clash.columns and ids(exact.collect()) == [(False, 2), (False, 3), (False, 6), (False, 8), (True, 0)]
    near = near_dedup.near_dedup(clash)
    assert near.columns == clash.columns and ids(near.collect()) == [(False, 1), (False, 5), (False, 6), (False, 8), (True, 0)]
    mixed = mixing.mix(clash)
    assert mixed.columns == clash.columns and {r.t1 for r in mixed.collect()} == {"x"}


def test_many_names_go_by_filter(spark, monkeypatch):
    monkeypatch.setattr(bloom, "BROADCAST_ROWS", 10)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("name"), F.lit(1).alias("v"))
    gone = common.cut(rows.filter("name % 7 = 0").select("name"))
    left = bloom.without(rows, gone, "name")
    assert sorted(int(r.name) for r in left.collect()) == [i for i in range(1000) if i % 7]


def test_hot_keys_are_spread(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = common.cut(spark.range(500).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"))
    table = common.cut(rows.groupBy("k").agg(F.count("*").alias("size"), F.min("id").alias("least")))
    out = common.spread(rows, table, ["k"], 500).collect()
    assert len(out) == 500 and all(r.least == (0 if r.k == 0 else r.id) for r in out)


def test_sparse_blocks_keep_the_quotas(spark):
    """60 documents of 30,000 words fill some of their source's blocks: shards and quotas must be those of the tree."""
    rows = [(i, ("w%d " % i) * 30_000, "big") for i in range(60)] + [(100 + i, f"a b c{i} " * 100, "small") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    sized = common.cut(docs.select(*mixing._row(docs, "doc_id", "text", "source", mixing.SEED)))
    planned = mixing.plan(sized, lambda i: i % 3 + 1)
    out = mixing._drawn(sized, planned, mixing.SEED).select("s", "rank", F.explode("draws").alias("d")).select("s", "rank", "d.*").collect()
    blocks = collections.defaultdict(set)
    for r in out:
        blocks[r.s].add((r.n, r["rank"], r.shard))
    assert all(0 <= r.shard < planned.shards == 64 for r in out)
    quotas = [len(blocks[k]) for k in range(2)]
    tree = mixing.splitting_tree(quotas, 64)
    for k in range(2):
        shards = collections.Counter(shard for _, _, shard in blocks[k])
        assert [shards[i] for i in range(64)] == tree[k].tolist()
        assert len({(n, rank) for n, rank, _ in blocks[k]}) == quotas[k]  # a block is drawn into one shard a pass
    partitions = mixing.mix(docs).select(F.spark_partition_id().alias("p")).distinct().collect()
    assert len(partitions) == np.count_nonzero(tree.sum(axis=0))


def test_shards_grow_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 50)
    docs = spark.createDataFrame([(i, "w " * 40, f"s{i % 3}") for i in range(200)], "doc_id long, text string, source string")
    sized = common.cut(docs.select(*mixing._row(docs, "doc_id", "text", "source", mixing.SEED)))
    assert mixing.plan(sized, lambda i: i + 1).shards == 160


def test_odd_header_lines():
    from docloom.llm import warc

    head = lambda fields: b"filedesc://f 0.0.0.0 19960923142103 text/plain %d\n" % len(b"1 0 x\n" + fields + b"\n\n") + b"1 0 x\n" + fields + b"\n\n"
    usual = b"URL IP-address Archive-date Content-type Archive-length"
    assert list(warc.parse_arc("f", head(usual) + "http://x/ 1.2.3.4 19970101 text/html ²\nabcd\n".encode()))[0]["error"].endswith("broken record")
    assert list(warc.parse_arc("f", head(usual) + b"http://x/ 1.2.3.4 19970101 text/html " + b"9" * 5000 + b"\nabcd\n"))[0]["error"].endswith("broken record")
    got = list(warc.parse_arc("f", head(b"Place Archive-length") + b"http://x/ 4\nabcd\nhttp://y/ 1\nz\n"))
    assert [r["error"][-5:] for r in got] == ["a URL", "a URL"]
    assert list(warc.parse_arc("f", head(usual) + "http://x/ 1.2.3.4 ٣٣٣٣ text/html 4\nabcd\n".encode()))[0]["date"] == "2024-01-01T00:00:00Z"


def test_text_keys_and_long_payloads_round_trip(spark, tmp_path):
    from docloom.llm import warc

    keys = ["b +%", "-", "", None, "é", "a", "7", "B"]
    rows = [(k, "u", "same payload " * 20, "x", "y") for k in keys] + [("long", "u", "z" * 9_000_000, "x", "y")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string, key string, payload string").repartition(2)
    out = warc.arc_to_warc(warc.pages_to_arc(pages, "page_id", "url", "html"), str(tmp_path / "w"))
    out = out.select(warc.key_of(F.col("key")).alias("k"), "record_type", warc.key_of(F.col("refers_to")).alias("r"), "payload_bytes").collect()
    assert collections.Counter(r.k for r in out) == collections.Counter([*keys, "long"])
    assert {r.k for r in out if r.record_type == "response"} == {"7", "long"} and {r.r for r in out} == {None, "7"}
    assert max(r.payload_bytes for r in out) == 9_000_000


def test_window_count_rises_and_rests_are_carried():
    from docloom.llm import packing

    assert len(set(packing.windows_without_cutting(np.full(40, 2049)).tolist())) == 40
    rng = np.random.default_rng(8)
    for n in (0, 1, 7, 300):
        lengths = rng.integers(1, 9000, n)
        pieces, sequences, left = packing.pack_windows(lengths)
        total = sum(r[2] for r in left)
        assert total < 4096 and sequences * 4096 + total == lengths.sum()
        tail = packing.pack_tail(left, sequences)
        covered = collections.defaultdict(list)
        for d, start, size, _, _ in [*pieces, *tail]:
            covered[d].append((start, start + size))
        for d, parts in covered.items():
            parts.sort()
            assert parts[0][0] == 0 and parts[-1][1] == lengths[d] and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
        assert len({p[3] for p in tail}) == bin(total).count("1")


def test_short_sequences_come_once_a_task(spark, monkeypatch):
    from docloom.llm import packing

    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(packing, "CHUNK_DOCS", 16)
    docs = spark.createDataFrame([(i, "some words of text " * (i % 50)) for i in range(400)], "doc_id long, text string").repartition(2)
    rows = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
    short = collections.Counter((q >> 40, n) for q, n in sizes.items() if n < 4096)
    assert max(short.values(), default=1) == 1 and all(n & (n - 1) == 0 for _, n in short)
