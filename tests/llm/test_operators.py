"""Each operator against a plain Python form, on texts with every kind of trouble."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from docloom.llm import exact_dedup, licenses, mixing, near_dedup, packing, quality_classifier, quality_rules, suffix_dedup, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(6000))
BASE = " ".join(f"alpha{i} beta{i}" for i in range(120))
ROWS = [
    (1, "A b\x0bC  d\tE\r\nA b", "s1"),
    (2, "a B\x0bc  D\tE\r\na b", "s1"),
    (3, None, None),
    (4, "", "s1"),
    (4, "", "s1"),
    (None, "É Straße K İ 你好 the end. The MIT License and GNU  General-Public_License", "s2"),
    (7, LONG, "s2"),
    (8, BASE, "s3"),
    (9, BASE.replace("alpha60", "changed"), "s3"),
    (10, BASE, "s3"),
    (11, " \n\t ", ""),
    (12, "one two three four", "s1"),
    (13, "one  two three\nfour", "s2"),
    (14, "x " * 300 + BASE[:900] + " y" * 40, "s1"),
    (15, "same line\nsame line\n\nother\nsame line", "s1"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(3)


@pytest.fixture(scope="module")
def clash(docs):
    """Columns with the names of outputs."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in ("score", "kept", "n_words", "base_failed", "labels", "predicted", "held_out", "n_lines")})


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_quality_rules(clash):
    got = {(r.doc_id, r.text): r for r in quality_rules.quality_rules(clash).collect()}
    for i, t, _ in ROWS:
        r, text = got[i, t], t or ""
        w = WORD.findall(text)
        times = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if times[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert (r.n_symbols, r.n_dup_lines) == (sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r.base_failed and r.kept)


def test_repeated_windows_when_hashes_clash(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "INDEX_BITS", 60)  # four bits of hash are left: windows clash, and the exact path answers
    from pyspark.sql import functions as F

    text = "a b c d e f a b c d e g h i j k l m n o p q"
    df = spark.createDataFrame([(text,)], "t string").select(quality_rules.repeated_words(F.split("t", " ")).alias("n"))
    assert df.first().n == 10


def test_exact_groups(docs):
    rows = exact_dedup.exact_groups(docs).collect()
    assert len(rows) == len(ROWS)
    groups = collections.defaultdict(list)
    for i, t, _ in ROWS:
        groups[hashlib.sha256(lowered(t).encode()).hexdigest()].append(i)
    for r in rows:
        own = [i for i in groups[r.text_sha256] if i is not None]
        assert (r.keep_id, r.group_size) == (max(own, default=None), len(groups[r.text_sha256]))
        assert not r.kept or r.doc_id == r.keep_id
    assert collections.Counter(r.text_sha256 for r in rows if r.kept) == collections.Counter(groups.keys())
    assert exact_dedup.exact_dedup(docs).count() == len(groups)


def test_suffix_dedup(docs, monkeypatch):
    data = [(t or "").encode() for _, t, _ in ROWS]
    starts = collections.Counter(d[p : p + 200] for d in data for p in range(len(d) - 199))
    want = collections.Counter()
    for (i, _, _), d in zip(ROWS, data, strict=True):
        gone = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - 199):
            if starts[d[p : p + 200]] > 1:
                gone[p : p + 200] = True
        spans = int((gone[1:-1] & ~gone[:-2]).sum()) + int(gone[0]) if len(d) else 0
        want[i, len(d), int(gone[:-1].sum()), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone, strict=False) if not g)).hexdigest()] += 1
    for most in (suffix_dedup.MOST_CONTEXTS, 0):  # 0: every anchor's positions are counted by Spark
        monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", most)
        assert collections.Counter(tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect()) == want


def test_suffix_dedup_of_hot_runs(docs, monkeypatch):
    twice = docs.unionByName(docs)  # every run repeats
    want = collections.Counter(tuple(r) for r in suffix_dedup.suffix_dedup(twice).collect())
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 1)
    monkeypatch.setattr(suffix_dedup, "HOT_KEYS", 1 << 40)  # a part for each run
    assert collections.Counter(tuple(r) for r in suffix_dedup.suffix_dedup(twice).collect()) == want
    assert all(n_removed == n_bytes for _, n_bytes, n_removed, *_ in want if n_bytes >= 200)


def test_near_classes(docs):
    def bag(t):
        w = WORD.findall(t or "")
        return collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None

    bags = [bag(t) for _, t, _ in ROWS]
    parent = list(range(len(ROWS)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for x in range(len(ROWS)):
        for y in range(x):
            if bags[x] and bags[y]:
                both = sum((bags[x] & bags[y]).values())
                if both >= 0.8 * (sum(bags[x].values()) + sum(bags[y].values()) - both):
                    parent[find(x)] = find(y)
    want = collections.Counter()
    for x, (i, _, _) in enumerate(ROWS):
        own = [ROWS[y] for y in range(len(ROWS)) if find(y) == find(x)]
        want[i, min((r[0] for r in own if r[0] is not None), default=None), len(own)] += 1
    rows = near_dedup.near_classes(docs).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in rows) == want
    assert near_dedup.near_dedup(docs).count() == len({find(x) for x in range(len(ROWS))})


def test_tiles_find_all_links():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**62, 120).astype(np.uint64)
    sets = []
    for k in range(80):
        own = base.copy()
        own[rng.choice(120, k % 30, replace=False)] = rng.integers(0, 2**62, k % 30)
        sets.append(np.unique(own))
    parent = list(range(80))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for x in range(80):
        for y in range(x):
            if near_dedup.similarity(sets[x], sets[y]) >= 0.8:
                parent[find(x)] = find(y)
    found = near_dedup.links_of_tile(sets, np.arange(80), None, 0.8)
    other = list(range(80))

    def root(x):
        return x if other[x] == x else root(other[x])

    for x, y in found:
        other[root(int(x))] = root(int(y))
    assert len({find(x) for x in range(80)}) == len({root(x) for x in range(80)}) > 1


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    weight = rng.integers(1, 9, (2, 400))
    weight[1, 200:] = weight[0, 200:]
    element = rng.integers(0, 2**62, 400).astype(np.uint64)
    sig = near_dedup.signatures(np.repeat([0, 1], 400), np.tile(element, 2), weight.ravel(), 2, 4000)
    truth = np.minimum(*weight).sum() / np.maximum(*weight).sum()
    assert abs((sig[0] == sig[1]).mean() - truth) < 0.03


def test_mix(docs):
    rows = mixing.draws(docs).collect()
    size = lambda t: len(WORD.findall(t or ""))
    sources = sorted({s for _, _, s in ROWS}, key=lambda s: (s is None, s or ""))
    sizes = [sum(size(t) for _, t, s in ROWS if s == x) for x in sources]
    goal = mixing.targets(sizes, [i % 3 + 1 for i in range(len(sources))])
    assert abs(sum(goal) - sum(sizes)) < 1e-6 and all(g <= 3 * s + 1e-9 for g, s in zip(goal, sizes, strict=True))
    assert len(rows) == len(ROWS) and sum(r.taken for r in rows) == sum(int(g + 0.5) for g in goal)
    assert all(r.taken <= 3 * r["size"] and r.taken == sum(d.words for d in r.draws) for r in rows)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.draws(docs).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and sum(size(r.text) for r in mixed.collect()) == sum(r.taken for r in rows)


def test_targets_share_the_excess():
    assert mixing.targets([100, 10, 100], [1, 2, 3]) == [45.0, 30.0, 135.0]
    assert mixing.targets([0, 0], [1, 2]) == [0.0, 0.0] and mixing.targets([], []) == []


def test_splitting_tree_keeps_quotas():
    tree = mixing.splitting_tree([1000, 1, 0, 333], 7)
    assert tree.sum(axis=1).tolist() == [1000, 1, 0, 333] and tree.sum(axis=0).max() - tree.sum(axis=0).min() <= 3


def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")


def test_pack(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer())
    rows = packing.pack(docs, tokenizer(), with_ids=True).collect()
    want = collections.Counter((i, tuple(t.encode(x or "", add_special_tokens=False).ids) + (2,)) for i, x, _ in ROWS)
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length > 0
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id, r.doc_tokens].append((r.start, tuple(r.ids)))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0  # no padding
    got = collections.Counter()
    for (i, n), parts in by_doc.items():
        parts.sort()
        copies = sum(s == 0 for s, _ in parts)
        whole = [x for k in range(0, len(parts), copies) for x in parts[k][1]]
        assert len(whole) == n
        got[i, tuple(whole)] += copies
    assert got == want


def test_differencing_balances():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 4096, 500)
    window = packing.differencing(sizes, 100)
    sums = np.bincount(window, sizes, minlength=100)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() < 600
    free = packing.windows_without_cutting(sizes)
    assert np.bincount(free, sizes).max() <= 4096


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a b", "x" * 150), (2, None, "x" * 150), (None, "u", "x" * 150), (3, "u\n\t é", ""), (4, "u", None), (2, "u", "x" * 150), (10, "u", "é\r\n\r\nWARC/1.1\n" * 20), (9, "u", "é\r\n\r\nWARC/1.1\n" * 20), (11, "u", "y" * 99), (12, "u", "y" * 99)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = warc.arc_to_warc(warc.pages_to_arc(pages, "page_id", "url", "html"), str(tmp_path / "w")).collect()
    payload = lambda h: (h or "").encode()
    assert collections.Counter((r.key, r.payload_bytes, r.payload_digest) for r in out) == collections.Counter(("-" if i is None else str(i), len(payload(h)), hashlib.sha256(payload(h)).hexdigest()) for i, _, h in rows)
    assert all(r.error is None for r in out) and len({r.record_id for r in out}) == len(rows)
    kinds = {(r.key, r.record_type, r.refers_to) for r in out}
    assert ("1", "response", None) in kinds and ("2", "revisit", "1") in kinds and ("-", "revisit", "1") in kinds and ("10", "revisit", "9") in kinds and ("12", "response", None) in kinds
    empty = warc.arc_to_warc(warc.pages_to_arc(pages.limit(0), "page_id", "url", "html"), str(tmp_path / "e"))
    assert empty.count() == 0


def test_arc_versions_and_broken_archives():
    for version in (1, 2):
        whole = warc.arc_archive(version, "n", [("1", "u", b"abc"), ("2", "v", b"")])
        assert [r["payload"] for r in warc.parse_arc("n", whole)] == [b"abc", b""]
        assert list(warc.parse_arc("n", whole[:-6]))[-1]["error"]
    old = b"filedesc://f 0.0.0.0 19960923142103 text/plain 75\n1 0 x\nURL IP-address Archive-date Content-type Archive-length\n\n".replace(b" 75\n", b" 63\n")
    got = list(warc.parse_arc("f", old + b"http://x/ 1.2.3.4 19970101 text/html 4\nabcd\n"))
    assert got[0]["date"] == "1997-01-01T00:00:00Z" and got[0]["payload"] == b"abcd"


def test_licenses(clash):
    rows = licenses.scan_licenses(clash.drop("held_out")).collect()
    token = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in rows:
        w = token.findall(lowered(r.text))
        places = [(k, label) for p, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert r.first_word == min((k for k, _ in places), default=None) and r.last_word == max((k for k, _ in places), default=None)
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_licence_templates_are_found(spark):
    texts = [f"some words here {t.upper()}, and more" for _, _, t in licenses.TEMPLATES] + ["redistribution and use of nothing", "GNU General Public"]
    got = licenses.scan_licenses(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    for r, (label, _, _) in zip(got, licenses.TEMPLATES, strict=False):
        assert label in r.labels.split(",") and r.score > 0.99
    assert got[-1].labels == got[-2].labels == ""


def test_licences_are_found_in_long_prose(spark):
    """Ordinary English holds many words of the templates; a notice in it, or all of them in one file, must be found as in a plain scan."""
    prose = """As was said above, people who are free and available can write code for any file except the following form, which may be made by hand or not,
    to charge a fee for use, or to copy and modify what is provided. A person obtaining the documentation is granted permission to publish it under the terms that
    the foundation met with; this notice and its conditions appear in all copies of the work, the source, the version and the binary, by the general public or with
    a creative domain, an international subject, and without compliance you must use the software for this purpose. """
    notices = [t for _, _, t in licenses.TEMPLATES] + ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.", "a cc by sa, an apache license"]
    texts = [prose * 3 + n + ". " + prose for n in notices] + [prose.join(notices), ". ".join(notices), prose + "license " + prose]
    idf, templates, keys = licenses._index()
    token = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for text, r in zip(texts, licenses.scan_licenses(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)).collect(), strict=True):
        w, labels, best = token.findall(lowered(text)), set(), 0.0
        labels |= {label for p, label in licenses.PHRASES if any(w[k : k + len(p.split())] == p.split() for k in range(len(w)))}
        best = 0.5 if labels else 0.0
        for (label, _, _), t, (first, n) in zip(licenses.TEMPLATES, templates, keys, strict=True):
            for d in range(-len(t), len(w)):
                if d + first >= 0 and w[d + first : d + first + n] == t[first : first + n]:
                    coverage = sum(idf[x] for p, x in enumerate(t) if 0 <= d + p < len(w) and w[d + p] == x) / sum(idf[x] for x in t)
                    if coverage >= licenses.LEAST_COVERAGE:
                        labels, best = labels | {label}, max(best, coverage)
        assert r.labels == ",".join(sorted(labels)) and abs(r.score - min(1.0, best)) < 1e-9


def training(spark, n=600):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(n):
        own = list(rng.choice(words, 80))
        bad, junk = i % 5 == 0, i % 7 == 0
        if bad:
            own[10:10] = ["nasty", "vile", f"gruk{i}"]
        text = ("!!! ".join(own[:20] * 4) if junk else " ".join(own)).upper() if junk else " ".join(own)
        rows.append((i, text))
        labels.append((i, int(not junk), int(bad)))
    return spark.createDataFrame([*rows, (n, None), (n + 1, ""), (None, LONG)], "doc_id long, text string"), spark.createDataFrame([*labels, (n, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = training(spark)
    from pyspark.sql import functions as F

    rows = toxicity.toxicity(docs.withColumn("score", F.lit("x")), labels, passages=True).collect()
    assert len(rows) == 603 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(602) if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [r.predicted == (r.doc_id % 5 == 0) for r in held if r.doc_id < 600]
    assert sum(right) >= 0.97 * len(right)
    assert all(r.passages and r.passages[0].first <= 12 for r in held if r.predicted)


def test_segments_match_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = rng.normal(-0.2, 1, 12)
        places = [i for i in range(12) if s[i] > -9]
        got = {(a, b): round(v, 9) for a, b, v in toxicity.maximal_segments(places, s.tolist(), 0.0)}

        def best(lo, hi):  # the best segment, and the same on either side of it
            if lo >= hi:
                return {}
            score, a, b = max((sum(s[a : b + 1]), -(b - a), a, b)[0::2][:1] + (a, b) for a in range(lo, hi) for b in range(a, hi))
            return {} if score <= 0 else {(a, b): round(float(score), 9), **best(lo, a), **best(b + 1, hi)}

        assert got == best(0, 12)


def test_quality_classifier(spark):
    docs, labels = training(spark)
    rows = quality_classifier.quality(docs, labels).collect()
    assert len(rows) == 603 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 600]
    assert {r.doc_id % 3 for r in held} == {0, 1, 2} and all(r.predicted == (r.doc_id % 7 != 0) for r in held)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (quality_rules.quality_rules(none), exact_dedup.exact_groups(none), exact_dedup.exact_dedup(none), suffix_dedup.suffix_dedup(none), near_dedup.near_classes(none), near_dedup.near_dedup(none), mixing.draws(none), mixing.mix(none), packing.pack(none, tokenizer()), licenses.scan_licenses(none), toxicity.toxicity(none, labels), quality_classifier.quality(none, labels)):
        assert out.count() == 0
    assert {round(r.score, 9) for r in toxicity.toxicity(docs, labels).collect()} == {0.5}
    assert quality_classifier.quality(docs, labels).count() == len(ROWS)


def test_components(spark, monkeypatch):
    rng = np.random.default_rng(7)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (330, 2))] + [(k, k + 1) for k in range(1000, 1060)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for a, b in pairs if a != b for x in (a, b)}
    links = spark.createDataFrame(pairs, "a long, b long")
    for most in (500_000, 40):  # one partition, and several with stars after them
        monkeypatch.setattr(near_dedup, "CONTRACT_EDGES", most)
        rows = near_dedup.components(links).collect()
        assert {r.node: r.component for r in rows} == want and len(rows) == len(want)
