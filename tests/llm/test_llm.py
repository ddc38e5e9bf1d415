"""The training-data operators on small fixtures, against brute force, exact round trips or the libraries themselves."""

import collections
import hashlib
import math
import random
import re
import zlib
from functools import reduce

import numpy as np
import pytest
import xxhash

from metaloom.llm import chat_trees, decontaminate, gear_chunks, license_scan, pitman_yor, quality_rules, sentence_pieces, simhash_golay, token_transducer, warc_index
from metaloom.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, w int, h bigint, part int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def prose(pick, n):
    return " ".join(pick.choice(["the", "Of", "and", "tree", "éle", "house", "river,", "stone.", "bird", "sky", "wind", "İn", "K", "field"]) + pick.choice(["", "", str(pick.randrange(40))]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(5)
    base = [prose(pick, pick.randrange(1, 120)) for _ in range(30)]
    passage = prose(pick, 70)
    long = prose(pick, 6000)
    other = [passage, f"{base[3]} {passage}", f"{passage} {base[4]}", long, long + " end", "word " * 80, "a\n\na\n b\nb\n b\n", None, "", "   \n\t", "x" * 5000, base[0], base[0],
             "Licensed under the Apache License, Version 2.0. MIT License; CC BY-NC 4.0.", "GNU General Public License, version 3. gnu general public license", "a<|endoftext|> b '' don't  \n", "#*$%&|<> $$$ ok " * 30]
    return base + other


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), "clash", 1, 2, 3) for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[1], None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def all_texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# 1
def pages(spark):
    big, small = "<p>" + "y" * 1200 + "</p>é", "short"
    rows = [(1, "http://www.A.example.com:80/x?q=1#f", big), (2, None, big), (3, "https://a.example.com/x?q=1", small), (4, "http://b.org/\r\nz", small), (5, "http://b.org", None), (6, "http://a.example.com/x?q=1", f"{big}\r\n\r\nWARC/1.1\r\n"), (7, "http://b.org/", "WARC/1.1\r\n\r\n" + "z" * 1100), (7, "http://b.org/", "other" * 300)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string"), rows


def test_warc(spark):
    df, rows = pages(spark)
    out = warc_index.report(df).collect()
    assert len(out) == len(rows)
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), i)
    want = []
    for i, _, html in rows:
        html = html or ""
        again = len(html.encode()) >= 1000 and largest[html] != i
        want.append((i, len(html.encode()), hashlib.sha1(html.encode()).hexdigest(), "revisit" if again else "response", largest[html] if again else None))
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == sorted(want)
    keys = collections.defaultdict(list)
    for r in out:
        keys[r.urlkey].append((r.history_pos, r.captured, r.page_id))
    assert "com,example,a)/x?q=1" in keys and len(keys["com,example,a)/x?q=1"]) == 3
    for found in keys.values():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1)) and [f[1:] for f in found] == sorted(f[1:] for f in found)
    assert warc_index.report(df.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [1000, 1])
def test_warc_sizes_nulls_and_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(warc_index, "HOT_COPIES", hot)
    monkeypatch.setattr(warc_index, "FILE_BYTES", 40_000)
    monkeypatch.setattr(warc_index, "FILE_RECORDS", 20)
    big, huge = "b" * 1500, "h" * 90_000
    rows = [(i, f" http://x.org/{i % 5}\x1f", big) for i in range(30)] + [(None, "u", huge), (None, "u", huge), (99, "u", huge), (98, "u\x85", huge), (98, "u\x85", huge), (50, None, "c" * 3000), (None, None, None), (None, "n", "d" * 2000), (None, "n", "d" * 2000)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id bigint, url string, html string, payload string, digest int").repartition(3)
    out = warc_index.report(df).collect()
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max((x for x in (largest.get(html or ""), i) if x is not None), default=None)
    want = []
    for i, url, html in rows:
        data, origin = (html or "").encode(), largest[html or ""]
        again = len(data) >= 1000 and origin is not None and i != origin
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", origin if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=repr) == sorted(want, key=repr)
    path = warc_index.scratch(spark, "archives")
    warc_index.write_archives(df, path)
    found = warc_index.read_archives(spark, path).collect()
    assert collections.Counter(r.url for r in found) == collections.Counter(u for _, u, _ in rows)
    sizes = collections.Counter()
    for r in found:
        sizes[r.run] += r.payload_bytes or 0
    assert max(sizes.values()) <= 90_000 and len(sizes) > 4


def test_warc_key_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc_index, "RANGE_ROWS", 10)
    rows = [(f"run{i % 7}", i, "k" if i % 3 else "j", f"{i * 37 % 100:03}", i) for i in range(100)]
    ordered = sorted(rows, key=lambda r: (r[0], r[2], r[3]))
    df = spark.createDataFrame([(r[0], k, *r[2:]) for k, r in enumerate(ordered)], "run string, place bigint, urlkey string, captured string, page_id bigint")
    got = {(r.urlkey, r.history_pos): (r.captured, r.page_id) for r in warc_index.merge_index(df).collect()}
    for key in "jk":
        for n, x in enumerate(sorted((r[3], r[4]) for r in rows if r[2] == key)):
            assert got[key, n + 1] == x


def test_loser_tree():
    pick = random.Random(3)
    for _ in range(200):
        runs = [sorted(pick.randrange(9) for _ in range(pick.randrange(5))) for _ in range(pick.randrange(8))]
        assert [runs[a][b] for a, b in warc_index.LoserTree(runs)] == sorted(sum(runs, []))


# 2
def test_license(docs, empty, all_texts):
    want = []
    for i, text in all_texts:
        w = WORDS.findall(text.translate(UPPER))
        places, labels = [], set()
        for phrase, label in license_scan.BASE:
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        want.append((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    out = license_scan.scan(docs)
    assert listed(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    named = {r.doc_id: r for r in out.collect()}
    apache = next(i for i, t in all_texts if "Apache" in t)
    assert named[apache].labels == "apache,apache-2.0,cc-by,cc-by-nc,mit" and named[apache].score == 1.0
    assert license_scan.scan(empty).count() == 0


# 3
def test_golay_tables():
    near, far = simhash_golay.golay_tables()
    weights = np.bitwise_count(near)
    assert np.bincount(weights).tolist() == [1, 23, 253, 1771]
    assert ((far[:, 0] >= 0) == (weights == 3)).all()


def test_fingerprint():
    for text in ["", " \n", "One", "a B", "the quick brown Fox jumps", "x " * 500 + "é"]:
        w = SPACED.findall(text.translate(UPPER))
        s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        assert simhash_golay.fingerprint(text.encode()) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("hot", [1000, 2])
def test_every_link_is_found_once(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash_golay, "HOT_KEY", hot)
    pick = random.Random(hot)
    prints = {pick.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for x in list(prints)[:50]:
        for _ in range(3):
            prints.add(x ^ sum({1 << pick.randrange(64) for _ in range(pick.randrange(1, 5))}))
    signed = [int(np.uint64(x).astype(np.int64)) for x in prints]
    got = [tuple(r) for r in simhash_golay.links(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert len(got) == len(set(got)) and set(got) == want and want


def test_components(spark):
    pick = random.Random(1)
    edges = [(pick.randrange(200), pick.randrange(200)) for _ in range(130)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges = [e for e in edges if e[0] != e[1]]
    root = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(got) == len(root) and {r.node: r.root for r in got} == root
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_simhash_dedup(docs, empty, all_texts):
    out = {r.doc_id: r.component_id for r in simhash_golay.near_duplicates(docs).collect()}
    ids = collections.defaultdict(list)
    for i, t in all_texts:
        ids[t].append(i)
    for same in ids.values():
        assert len({out[i] for i in same}) == 1
    kept = simhash_golay.keep_one(docs)
    assert kept.columns == docs.columns
    assert len(kept.collect()) == len({r.component_id for r in simhash_golay.near_duplicates(docs).collect()})
    assert simhash_golay.keep_one(empty).count() == 0


def test_keep_one_leaves_no_pair_of_similar_texts(spark):
    pick = random.Random(8)
    base, rows = [[f"w{pick.randrange(3000)}" for _ in range(300)] for _ in range(6)], []
    for words in base:
        rows.append(" ".join(words))
        for edits in range(1, 16):
            own = list(words)
            for at in pick.sample(range(300), edits):
                own[at] = f"edit{pick.randrange(10**6)}"
            rows.append(" ".join(own))
    rows += ["one two", "One  TWO", "one three", "", None, " "]
    sets = []
    for t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))})
    root = list(range(len(rows)))
    alike = [(i, j) for j in range(len(rows)) for i in range(j) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    for _ in rows:
        for i, j in alike:
            root[i] = root[j] = min(root[i], root[j])
    kept = simhash_golay.keep_one(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string"))
    assert 6 < len(set(root)) < len(rows) - 20
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_pipeline_follows_fingerprints_and_shingles(spark):
    import corpus_pipeline

    pick = random.Random(9)
    # few different shingles are shared, but those are the most of the text: one fingerprint
    chorus = ["red green blue " * 100 + " ".join(f"{name}{i}" for i in range(12)) for name in ("a", "b")]
    words = [f"w{pick.randrange(5000)}" for _ in range(120)]
    verse = [" ".join(words), " ".join("other" if i in (50, 51) else w for i, w in enumerate(words))]
    rows = [(7, chorus[0]), (3, chorus[1]), (5, verse[0]), (6, verse[1]), (9, "one of its own kind"), (None, chorus[0])]
    prints = [simhash_golay.fingerprint(t.encode()) for t in chorus + verse]
    assert (prints[0] ^ prints[1]).bit_count() <= 2 < (prints[2] ^ prints[3]).bit_count()
    kept = corpus_pipeline.distinct_documents(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 9]


# 4
def test_quality(spark, docs, empty, all_texts):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(37)] + [(21, 0, None), (None, 1, 1), (0, None, 0)], "doc_id bigint, quality int, toxic int")
    want = []
    for i, t in all_texts:
        w = SPACED.findall(t)
        win = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        n = collections.Counter(win)
        covered = {k + j for k, x in enumerate(win) if n[x] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    out = quality_rules.quality_rules(docs, labels)
    assert listed(out, "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=repr)
    assert out.filter("base_failed AND kept").count() == 0 and out.filter("kept").count() > 0
    assert quality_rules.quality_rules(empty, labels).count() == 0
    assert quality_rules.quality_rules(docs, labels.limit(0)).filter("kept = base_failed").count() == 0


def test_quality_verdicts(spark):
    pick = random.Random(4)
    clean = [" ".join(f"w{int(pick.paretovariate(0.6)) % 5000}" for _ in range(200)) for _ in range(240)]
    junk = [" ".join(w + pick.choice(["$$$", "%%%", "###", ""]) for w in t.split()) for t in clean[:40]]
    rows = list(enumerate(clean[40:] + junk + ["too short", "word " * 80, "", None]))
    labels = [(i, 1, 0) for i in range(150)] + [(i, 0, 0) for i in range(200, 220)]
    long = lambda h, seed=42: xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
    signed = lambda h: h - 2**64 if h >> 63 else h
    grams, passed = {}, {}
    for i, t in rows:
        w = SPACED.findall(t or "")
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
        grams[i] = [signed(x) % quality_rules.N_BUCKETS for x in h + [long(b, long(a)) for a, b in zip(h, h[1:])]]
        n = collections.Counter(win := list(zip(w, w[1:], w[2:])))
        passed[i] = len(w) >= 50 and 100 * len({k + j for k, x in enumerate(win) if n[x] > 1 for j in range(3)}) <= 50 * len(w)
    fitted = {i for i in range(150) if long(i) % 2 == 0}
    raw, target = collections.Counter(g for x in grams.values() for g in x), collections.Counter(g for i in fitted for g in grams[i])
    share = {g: (n + 1) / (raw.total() + quality_rules.N_BUCKETS) for g, n in raw.items()}
    prior = quality_rules.PRIOR
    weight = {g: round(1e6 * math.log((target[g] / p + prior) / (target.total() + prior))) for g, p in share.items()}
    llr = {i: sum(weight[g] for g in x) / max(len(x), 1) / 1e6 for i, x in grams.items()}
    unseen = sorted(llr[i] for i in set(range(150)) - fitted if passed[i])
    least = unseen[math.ceil(quality_rules.REJECTED * len(unseen)) - 1]
    out = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {r.doc_id: r for r in out.select("row.doc_id", "llr", "kept").collect()}
    for i, _ in rows:
        assert got[i].llr == pytest.approx(llr[i], abs=2e-6)
        assert got[i].kept == (passed[i] and got[i].llr >= least - 1e-9), i
    assert not any(got[i].kept for i in range(200, 240)) and sum(got[i].kept for i in range(200)) > 0.95 * sum(passed[i] for i in range(200))


def test_every_trusted_row_counts(spark, monkeypatch):
    trusted = quality_rules._trusted(spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic"))
    assert trusted.count() == 30_000 and 14_000 < trusted.filter("fitted").count() < 16_000
    pick = random.Random(6)
    values = [pick.gauss(0, 1) for _ in range(3000)] + [-2.5] * 20
    table = spark.createDataFrame([(x,) for x in values], "llr double")
    for share in (0.001, 0.005, 0.5, 1.0):
        assert quality_rules._quantile(table, share) == sorted(values)[math.ceil(share * len(values)) - 1]
    assert quality_rules._quantile(table.limit(0), 0.5) is None
    rows = [(i, " ".join(f"w{int(pick.paretovariate(0.6)) % 300}" for _ in range(80))) for i in range(60)] + [(None, "one " * 60), (3, None)]
    docs, labels = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    judged = lambda: listed(quality_rules.quality_rules(docs, labels), "row.doc_id", "llr", "kept")
    sent = judged()
    monkeypatch.setattr(quality_rules, "BROADCAST_ROWS", 0)
    assert judged() == sent


# 5
def test_chunks_cover_and_resist_shifts():
    pick = random.Random(2)
    text = prose(pick, 800).encode()
    spans = gear_chunks.chunks(b"  " + text)
    assert spans[0][0] == 2 and spans[-1][1] == len(text) + 2 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    pieces = lambda t: {t[a:b] for a, b in gear_chunks.chunks(t)}
    moved = text[:900] + b" an insertion " + text[900:]
    assert len(pieces(text) - pieces(moved)) <= 4


def test_substring_dedup(docs, empty, all_texts, texts):
    passage = texts[30]
    out = gear_chunks.substring_dedup(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    rows = [r for r in out.collect() if r.doc_id in (31, 32)]
    assert all(len(r.text) < len(texts[r.doc_id]) - 0.6 * len(passage) and r.n_chars == len(r.text) for r in rows)
    told = {(r.doc_id, r.n_bytes): r for r in gear_chunks.report(docs).collect()}
    for r in out.collect():
        before = dict(all_texts)[r.doc_id]
        t = told[r.doc_id, len(before.encode())]
        assert len((r.text or "").encode()) == t.n_bytes - t.n_cut_bytes
        if r.doc_id == 30:
            assert r.text == passage
        if r.doc_id in (31, 32):
            assert 30 in t.owner_ids
        if r.doc_id in (3, 5, 6):
            assert r.text == before
    assert gear_chunks.substring_dedup(empty).count() == 0


@pytest.mark.parametrize("share", [10_000, 1e9])
def test_cuts_and_owners(spark, monkeypatch, share):
    """Against a byte-by-byte hash and plain dictionaries; with share 1e9 every digest is hot."""
    monkeypatch.setattr(gear_chunks, "HOT_SHARE", share)
    pick = random.Random(12)
    parts = [prose(pick, 40) for _ in range(6)]
    rows = [(i, " ".join(pick.sample(parts, 2) + [prose(pick, 25)])) for i in range(30)] + [(4, parts[0]), (None, parts[1]), (None, parts[1]), (40, None), (41, " \n"), (42, parts[2]), (42, parts[2])]
    gear, white = [xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], set(b" \t\n\x0b\x0c\r")

    def cut(data):
        start, out = len(data) - len(data.lstrip()), []
        for end in range(start + 1, len(data)):
            if data[end - 1] in white and data[end] not in white and end - start >= gear_chunks.MIN_CHUNK:
                h = 0
                for b in data[max(0, end - gear_chunks.WINDOW) : end]:
                    h = (2 * h + gear[b]) % 2**32
                if h >> (32 - gear_chunks.BITS) == 0:
                    out.append((start, end))
                    start = end
        return out + [(start, len(data))] if data.strip() else []

    owner, texts, seen = {}, [(i, (t or "").encode()) for i, t in rows], collections.Counter()
    for i, data in texts:
        for a, b in cut(data):
            k = data[a:b].rstrip()
            owner[k] = min((x for x in (owner.get(k), i) if x is not None), default=None)
    want = []
    for i, data in texts:
        runs, last = [], None
        for a, b in cut(data):
            if (o := owner[data[a:b].rstrip()]) != i:
                if last != a:
                    runs.append([a, b, set()])
                runs[-1][1] = last = b
                runs[-1][2].add(o)
        runs = [r for r in runs if r[1] - r[0] >= gear_chunks.MIN_RUN]
        want.append((i, len(data), len(runs), sum(b - a for a, b, _ in runs), sorted(set().union(*(r[2] for r in runs)))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.n_bytes, r.n_cut_runs, r.n_cut_bytes, r.owner_ids) for r in gear_chunks.report(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and sum(w[2] for w in want) > 10


# 6
def test_chat_round_trip(spark):
    odd = ["<|im_end|>\n<|im_start|>user\nx", "\\", "\\\\<|", "<\\|", "<|<\\|\\<||>", "é\n\n", "", None, "assistant\n", "<\\_"]
    rows = [(c, t, r, x) for c in (1, 2, None) for t, (r, x) in enumerate(zip(["system", "user", "assistant"] * 4, odd))] + [(1, 2, "assistant", odd[2]), (1, None, None, "first"), (3, 0, "odd\nrole", "t")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = {r.conv_id: r for r in chat_trees.report(df).collect()}
    probe = [(-1, 0, "user", chat_trees.PROBE), (-1, 1, "assistant", chat_trees.PROBE)]
    low = lambda x: (x is not None, x if x is not None else 0)
    for conv in (1, 2, None, 3, -1):
        mine = sorted((r for r in rows + probe if r[0] == conv), key=lambda r: (low(r[1]), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or "")))
        learned = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = out[conv]
        assert r.n_turns == len(mine) and r.turns_sha256 == hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert [r.conv_id for r in chat_trees.report(df.limit(0)).collect()] == [-1]
    more = df.selectExpr("*", "'x' AS tree", "1 AS leaf", "2 AS formatted").union(spark.createDataFrame([(-1, 5, "user", "own", "x", 1, 2)], "conv_id bigint, turn bigint, role string, text string, tree string, leaf int, formatted int"))
    assert {r.conv_id: r.n_turns for r in chat_trees.report(more).collect()} == {k: r.n_turns + (k == -1) for k, r in out.items()}


def test_long_comb_of_replies(spark):
    """A chain of 300 turns with a side branch at each: only the chosen path is enumerated."""
    nodes = [(n, n - 1 or None, 1.0) for n in range(1, 301)] + [(1000 + n, n, 0.0) for n in range(1, 300)]
    df = spark.createDataFrame(nodes, "node bigint, parent bigint, score double").selectExpr("struct(1 AS t) AS tree", "node", "parent", "score")
    got = chat_trees.paths(df)
    assert sorted((r.above, r.node) for r in got.collect()) == [(k, 300 - k) for k in range(300)]


def test_reply_trees(spark):
    pick = random.Random(4)
    nodes = [(1, n, pick.randrange(1, n) if n > 1 else None, "user", f"m{n}", float(pick.randrange(5))) for n in range(1, 40)] + [(2, 1, 2, "user", "loop", 1.0), (2, 2, 1, "user", "loop", 1.0), (2, 3, 1, "user", "below the loop", 1.0), (3, 1, None, "user", "alone", None), (4, 1, 9, "user", "no parent", 1.0), (4, 2, 1, "user", "below", 1.0)]
    df = spark.createDataFrame(nodes, "t bigint, node bigint, parent bigint, role string, text string, score double").selectExpr("struct(t) AS tree", "node", "parent", "role", "text", "score")
    up = {n: p for t, n, p, *_ in nodes if t == 1}
    want = {}
    for leaf in set(up) - set(up.values()):
        way, n = [], leaf
        while n:
            way.append(n)
            n = up[n]
        want[leaf] = way
    got = collections.defaultdict(list)
    for r in chat_trees.paths(df, None).collect():
        if r.tree.t == 1:
            got[r.leaf].append((r.above, r.node))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == want
    assert {r.tree.t for r in chat_trees.paths(df, None).select("tree").distinct().collect()} == {1, 3}
    score = {n: s for t, n, *_, s in nodes if t == 1}
    best = min(want, key=lambda k: (-sum(score[n] for n in want[k]) / len(want[k]), k))
    chosen = {r.tree.t: r.leaf for r in chat_trees.best_paths(df).select("tree", "leaf").distinct().collect()}
    assert chosen == {1: best, 3: 1}


# 7
def unigram_model():
    """The model file with the type in its trainer settings changed to unigram."""
    data = open(sentence_pieces.default_model(), "rb").read()
    out, at = b"", 0
    while at < len(data):
        start = at
        tag, at = sentence_pieces._varint(data, at)
        size, at = sentence_pieces._varint(data, at)
        at += size
        part = data[start:at]
        if tag >> 3 == 2:
            body, k, new = data[at - size : at], 0, b""
            while k < len(body):
                s = k
                t, k = sentence_pieces._varint(body, k)
                if t & 7 == 0:
                    _, k = sentence_pieces._varint(body, k)
                else:
                    n, k = sentence_pieces._varint(body, k) if t & 7 == 2 else ({1: 8, 5: 4}[t & 7], k)
                    k += n
                new += b"\x18\x01" if t >> 3 == 3 else body[s:k]
            assert len(new) == len(body)
            part = data[start : at - size] + new
        out += part
    return out


def test_pieces_equal_the_library(all_texts):
    coder = sentence_pieces.Pieces(open(sentence_pieces.default_model(), "rb").read())
    assert not coder.unigram
    texts = [t for _, t in all_texts] + ["  two  spaces ", "日本語 🎉", "\x00\x01", "http://x.example/a_b?c=1"]
    got = [np.frombuffer(x, np.int32).tolist() for x in coder.encode(texts)]
    assert got == coder.library.encode(texts)
    assert [coder.decode(x) for x in got] == texts


def test_unigram_finds_the_best_segmentation():
    coder = sentence_pieces.Pieces(unigram_model())
    assert coder.unigram
    pick = random.Random(8)
    words = {w for _ in range(20) for w in prose(pick, 30).split()} | {"ab" * 4, "日本", "zzzz"}

    def best(word):
        """Over all segmentations."""
        if not word:
            return 0.0
        ends = [k for k in range(1, len(word) + 1) if word[:k] in coder.scores or k == 1]
        return max(coder.scores.get(word[:k], coder.unknown_score) + best(word[k:]) for k in ends)

    coder.learn(words)
    score = {i: coder.scores.get(coder.library.id_to_piece(i), 0) for i in range(coder.library.get_piece_size())}
    for word in words:
        ids = np.frombuffer(coder.words[word], np.int32).tolist()
        if not any(map(coder.library.is_byte, ids)):
            assert sum(score[i] for i in ids) == pytest.approx(best(word))
    texts = [" ".join(words)] * 2
    assert [coder.decode(np.frombuffer(x, np.int32).tolist()) for x in coder.encode(texts)] == texts


def test_piece_report(docs, empty, all_texts):
    out = sentence_pieces.report(docs)
    assert listed(out, "doc_id", "decoded_sha256") == sorted(((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in all_texts), key=repr)
    assert sentence_pieces.report(empty).count() == 0
    assert {(r.doc_id, r.decoded) for r in sentence_pieces.encode(docs).collect()} == set(all_texts)


def test_encoding_leaves_no_memo_in_workers(spark, docs):
    import pyarrow as pa

    model = open(sentence_pieces.default_model(), "rb").read()

    def probe(batches):
        for batch in batches:
            coder = sentence_pieces.pieces(model)
            yield pa.RecordBatch.from_arrays([pa.array([len(coder.words) + len(coder.apart)] * batch.num_rows)], ["n"])

    assert sentence_pieces.encode(docs).filter("size(ids) > 0").count() > 0
    assert {r.n for r in spark.range(0, 40, 1, 4).mapInArrow(probe, "n bigint").collect()} == {0}


# 8
def test_decontaminate(spark, docs, empty, all_texts, texts):
    w = WORDS.findall(texts[33].translate(UPPER))
    items = [(1, " ".join(w[100:125]).upper()), (2, " ".join(w[118:122])), (3, w[7] + "!"), (4, ""), (5, None), (None, " ".join(w[110:121])), (6, "absent words only here"), (1, " ".join(w[2000:2012])), (10, " ".join(w[100:125]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        x = WORDS.findall((t or "").translate(UPPER))
        for k in range(max(1, len(x) - 9) if x else 0):
            windows[tuple(x[k : k + 10])] |= {i} - {None}
    want = []
    for i, t in all_texts:
        x = WORDS.findall(t.translate(UPPER))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(x) - n + 1):
                if (key := tuple(x[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= {str(y) for y in windows[key]}
        want.append((i, len(x), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert listed(decontaminate.report(docs, bench), *columns) == sorted(want, key=repr)
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and sorted((r.doc_id for r in clean.collect()), key=repr) == sorted((x[0] for x in want if not x[-1]), key=repr)
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).filter("contaminated").count() == 0


# 9
def test_token_counts(docs, empty, all_texts, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_transducer.default_file())
    monkeypatch.setattr(token_transducer, "CHUNK", 700)
    monkeypatch.setattr(token_transducer, "LOOK", 100)
    monkeypatch.setattr(token_transducer, "FAN_IN", 3)
    want = [(i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in all_texts]
    out = token_transducer.token_counts(docs)
    assert listed(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(((*x, x[2] > 512) for x in want), key=repr)
    assert token_transducer.token_counts(empty).count() == 0


def test_chunk_maps_compose_in_any_order(monkeypatch):
    machine = token_transducer.Transducer(open(token_transducer.default_file()).read())
    from tokenizers import Tokenizer

    library, pick, kinds = Tokenizer.from_file(token_transducer.default_file()), random.Random(6), collections.Counter()
    for look in [30] * 150 + [5] * 50:
        text = "".join(pick.choice(["<|endoftext|>", "<|endof", "text|>", " ", "a", "b", "'s", "'r", "e", ".", "12", "\n", " the", "\x85", "́"]) for _ in range(80))
        n = pick.randrange(look, 90)
        parts = [text[i : i + n] for i in range(0, len(text), n)]
        maps = [machine.chunk_map(parts[i - 1][-look:] if i else None, x) for i, x in enumerate(parts)]
        kinds.update(m[0] is None for m in maps[1:])
        k = pick.randrange(1, len(maps)) if len(maps) > 1 else 0
        halves = [reduce(machine.compose, x) for x in (maps[:k], maps[k:]) if x]
        assert machine.total(reduce(machine.compose, halves)) == machine.total(reduce(machine.compose, maps)) == len(library.encode(text, add_special_tokens=False).ids)
    assert kinds[True] and kinds[False]


def test_states_are_bounded_inside_a_word(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_transducer, "STATES", 50)
    machine = token_transducer.Transducer(open(token_transducer.default_file()).read())
    word = "".join(random.Random(3).choice("abcdefghijklmnop") for _ in range(2000))
    assert machine.tokens(word) == len(Tokenizer.from_file(token_transducer.default_file()).encode(word, add_special_tokens=False).ids)
    assert len(machine.states) <= 52


# 10
def plain_scores(texts):
    """The whole model over dictionaries, one cell after the other. texts: id, whether held out, tokens."""
    py, hashed = pitman_yor, lambda w: xxhash.xxh64_intdigest(w.encode(), 42) >> 1
    theta, theta0 = py.CONCENTRATION, py.ROOT_CONCENTRATION
    count = collections.Counter(w for _, held, words in texts if not held for w in words)
    n_tokens, n_words = count.total(), len(count)
    lexicon = {w: i for i, w in enumerate(sorted((w for w in count if count[w] >= py.MIN_CONTEXT), key=hashed))}
    start, name = len(lexicon), lambda w: lexicon.get(w, hashed(w))
    of = lambda words: [(start if not i else lexicon.get(words[i - 1], -1), w) for i, w in enumerate(words)]
    cell = collections.Counter(p for _, held, words in texts if not held for p in of(words))
    own = [n for (u, _), n in cell.items() if u >= 0]
    ratio = lambda a, b: min(0.95, max(0.05, a / (a + 2 * b))) if a + b else 0.5
    d = ratio(own.count(1), own.count(2))
    below = collections.Counter()
    for (u, w), n in cell.items():
        below[w] += n if u < 0 else 1
    rare = [below[w] for w in count if w not in lexicon]
    d0 = ratio(rare.count(1), rare.count(2))

    def numbers(disc):
        s = {(0, 0): 1.0}
        for n in range(py.LARGE):
            for k in range(1, n + 2):
                s[n + 1, k] = s.get((n, k - 1), 0.0) + (n - disc * k) * s.get((n, k), 0.0)
                if n > 40:
                    break
        return s

    tables = {d: py.stirling(d), d0: py.stirling(d0)}
    some = numbers(d)
    for n in range(1, 41):
        for k in range(1, n + 1):
            assert math.exp(tables[d][n, k]) == pytest.approx(some[n, k], rel=1e-9)

    def draw(n, x, u, disc):
        n = round(n)
        if n < 2 or n > py.LARGE:
            return float(min(n, 1)) if n < 2 else py.expected(np.array([n]), np.array([x]), disc)[0]
        log = [tables[disc][n, k] + k * math.log(x) for k in range(1, n + 1)]
        shares = [math.exp(v - max(log)) for v in log]
        want, k = u * sum(shares), 0
        while k < n - 1 and sum(shares[: k + 1]) < want:
            k += 1
        return float(k + 1)

    rand = lambda sweep, w, u: py.uniform(sweep, np.array([name(w)]), np.array([u]))[0]
    customers = collections.Counter()
    for (u, w), n in cell.items():
        customers[u] += n
    now = {c: float(n if c[0] < 0 else 1) for c, n in cell.items()}
    root_t = {w: 1.0 for w in count}
    pairs = [c for c, n in cell.items() if c[0] >= 0 and c[1] in lexicon and n > 1]

    def totals(now, root_t):
        t_u, c_w = collections.Counter(), collections.Counter()
        for (u, w), t in now.items():
            t_u[u] += t
            c_w[w] += t
        return t_u, c_w, sum(c_w.values()), sum(root_t[w] for w in c_w)

    def root(c, t, less, all_c, all_t):
        c -= less
        return (max(c - d0 * min(t, c), 0) + (theta0 + d0 * all_t) / (n_words + 1)) / (theta0 + all_c - less)

    history = []
    for sweep in range(1, py.SWEEPS + 1):
        t_u, c_w, all_c, all_t = totals(now, root_t)
        new = dict(now)
        for u, w in pairs:
            t = now[u, w]
            new[u, w] = draw(cell[u, w], (theta + d * max(t_u[u] - t, 0)) * root(c_w[w], root_t[w], t, all_c, all_t), rand(sweep, w, u), d)
        now = new
        c_w = totals(now, root_t)[1]
        root_t = {w: draw(c_w[w], (theta0 + d0 * max(all_t - 1, 0)) / (n_words + 1), rand(sweep, w, py.ROOT), d0) if w in lexicon else root_t[w] for w in root_t}
        history.append((dict(now), dict(root_t)))
    samples = [[dict(a), dict(b)] for a, b in history]
    for w in count:
        if w not in lexicon:
            mine, t_root = {c: now[c] for c in cell if c[1] == w}, 1.0
            for sweep in range(1, py.SWEEPS + 1):
                t_u, _, all_c, all_t = totals(*history[sweep - 1])
                for c in sorted(mine):
                    if c[0] >= 0 and cell[c] > 1:
                        x = (theta + d * (t_u[c[0]] - 1)) * root(sum(mine.values()), t_root, mine[c], all_c, all_t)
                        mine[c] = draw(cell[c], x, rand(sweep, w, c[0]), d)
                t_root = draw(sum(mine.values()), (theta0 + d0 * max(all_t - 1, 0)) / (n_words + 1), rand(sweep, w, py.ROOT), d0)
                samples[sweep - 1][0].update(mine)
                samples[sweep - 1][1][w] = t_root
    kept = [(*totals(*x), *x) for x in samples[py.BURN_IN :]]
    # the tables that rarer words have in a context count with their mean
    mean = collections.Counter()
    for t_u, *_ in kept:
        for u, t in t_u.items():
            mean[u] += t
    pair_t = [collections.Counter() for _ in kept]
    for s, (*_, now, _) in enumerate(kept):
        for (u, w), t in now.items():
            if w in lexicon:
                pair_t[s][u] += t
    rare_t = {u: (mean[u] - sum(p[u] for p in pair_t)) / len(kept) for u in mean}

    def p(u, w):
        total = 0.0
        for s, (_, c_w, all_c, all_t, now, root_t) in enumerate(kept):
            at_root = root(c_w.get(w, 0), root_t.get(w, 0), 0, all_c, all_t)
            t_u = pair_t[s][u] + rare_t.get(u, 0)
            n = cell[u, w] if u >= 0 else 0
            total += at_root if u < 0 else (n - d * now.get((u, w), 0) * (n > 0) + (theta + d * t_u) * at_root) / (theta + customers[u])
        return total / len(kept)

    whole = {u: sum(p(u, w) for w in count) + p(u, "a word that is not there") for u in (-1, start, 0)}
    assert all(x == pytest.approx(1, rel=1e-9) for x in whole.values())
    return {i: sum(math.log10(p(u, w)) for u, w in of(words)) for i, _, words in texts}


def test_language_model(spark, docs, empty, all_texts, monkeypatch):
    monkeypatch.setattr(pitman_yor, "MIN_CONTEXT", 30)
    monkeypatch.setattr(pitman_yor, "PAIRS", 40)
    count, told = collections.Counter(), []
    for i, t in all_texts:
        w = SPACED.findall(t.translate(UPPER)) + ["\n"]
        held = i is None or zlib.crc32(str(i).encode()) % 10 == 0
        told.append((i, held, w))
        count.update([] if held else w)
    n, v = sum(count.values()), len(count)
    out = pitman_yor.score(docs).collect()
    want = [(i, held, len(w), sum(x in count for x in w), n) for i, held, w in told]
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in out), key=repr) == sorted(want, key=repr)
    base = {i: sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) for i, _, w in told}
    scores = plain_scores(told)
    for r in out:
        assert r.base_score == pytest.approx(base[r.doc_id]) and r.score == pytest.approx(scores[r.doc_id], rel=1e-9)
    monkeypatch.setattr(pitman_yor, "SLICE", 2000)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    again = {r.doc_id: r.score for r in pitman_yor.score(docs.repartition(7)).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert all(r.score == pytest.approx(again[r.doc_id], rel=1e-12) for r in out)
    assert pitman_yor.score(empty).count() == 0


def test_language_model_without_training_rows(spark):
    rows = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0] + [(None, None)]
    for r in pitman_yor.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        assert r.score == pytest.approx(0) and r.train_tokens == 0 and r.held_out


def test_every_context_has_a_restaurant(spark, monkeypatch):
    """Beyond the lexicon too: all cells are counted, tables are customers of the root, and each context's probabilities sum to 1."""
    py, hashed = pitman_yor, lambda w: xxhash.xxh64_intdigest(w.encode(), 42) >> 1
    monkeypatch.setattr(py, "LEXICON", 20)
    monkeypatch.setattr(py, "PAIRS", 30)
    pick = random.Random(5)
    texts = [" ".join(f"w{min(int(pick.paretovariate(0.5)), pick.randrange(50, 120))}" for _ in range(pick.randrange(40))) for _ in range(120)]
    texts += ["qa qb qc w1 " * 9, "qa qb new qa w2 newer qc"] + texts[:30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    told = [(i, zlib.crc32(str(i).encode()) % 10 == 0, t.split() + ["\n"]) for i, t in enumerate(texts)]
    assert 2 < sum(held for _, held, _ in told) < 60
    of = lambda words: list(zip([None] + words[:-1], words))
    want = collections.Counter(p for _, held, words in told if not held for p in of(words))
    name = {hashed(w): w for _, _, words in told for w in words}

    model, pairs, rare, after = py.fit(docs)
    listed = [name[h] for h in model.lexicon.tolist()] + [None]
    assert len(listed) <= 21
    n, tables, root = {}, {}, {w: [] for w in listed[:-1]}
    for r in pairs.collect():
        cell = listed[r.key >> 32], listed[r.key & 0xFFFFFFFF]
        n[cell], tables[cell] = r.n, r.tables / py.SAMPLES
    for r in after.collect():
        for w, k, t in zip(r.words, r.ns, r.tables):
            cell = name[r.context], listed[w] if w >= 0 else name[-1 - w]
            n[cell], tables[cell] = k, t / py.SAMPLES
    assert sum(u is not None and u not in listed and k > 1 and tables[u, w] > 1 for (u, w), k in n.items()) > 5
    for r in rare.collect():
        root[name[r.word]] = list(zip(r.customers, r.root_tables))
        for u, k, t in zip(r.contexts, r.ns, r.tables):
            cell = listed[u] if u >= 0 else name.get(-2 - u), name[r.word]
            assert u >= 0 or u == -1 or (n[cell], tables[cell]) == (k, t / py.SAMPLES)
            if u >= 0:
                n[cell], tables[cell] = k, t / py.SAMPLES
    assert {c: k for c, k in n.items() if k} == want and all(min(k, 1) <= tables[c] <= k for c, k in n.items())

    kept = range(py.BURN_IN + 1, py.SWEEPS + 1)
    for w, i in zip(listed[:-1], range(len(listed))):
        root[w] = [(model.root_customers[s][i], model.root_tables[s][i]) for s in kept]
    known = {w for _, w in want}
    for w in known:
        assert sum(c for c, _ in root[w]) / py.SAMPLES == pytest.approx(sum(t for (_, x), t in tables.items() if x == w))
    size, seated = collections.Counter(), collections.Counter()
    for (u, w), k in n.items():
        size[u] += k
        seated[u] += tables[u, w]
    for i, u in enumerate(listed):
        assert sum(model.tables[s][i] for s in kept) / py.SAMPLES == pytest.approx(seated[u])
    d, d0, v = model.discount, model.root_discount, len(known)
    totals = [[sum(root[w][s][k] for w in known) for k in range(2)] for s in range(py.SAMPLES)]

    def p(u, w):
        total = 0.0
        for s, sweep in enumerate(kept):
            c, t = root[w][s] if w in known else (0, 0)
            at_root = (max(c - d0 * min(t, c), 0) + (py.ROOT_CONCENTRATION + d0 * totals[s][1]) / (v + 1)) / (py.ROOT_CONCENTRATION + totals[s][0])
            t_u = model.tables[sweep][listed.index(u)] if u in listed else seated[u]
            total += (py.CONCENTRATION + d * t_u) * at_root / (py.CONCENTRATION + size[u])
        return total / py.SAMPLES + max(n.get((u, w), 0) - d * tables.get((u, w), 0), 0) / (py.CONCENTRATION + size[u])

    rarer = [w for w in known if w not in listed]
    assert len(rarer) > 40 and {"qa", "qb"} & set(rarer)
    for u in [None, *listed[:3], *rarer[:20], "qa", "not there"]:
        assert sum(p(u, w) for w in known) + p(u, "not there") == pytest.approx(1, rel=1e-9)
    # cells handed over in small pieces
    monkeypatch.setattr(py, "GATHER", 300)
    monkeypatch.setattr(py, "ROWS", 7)
    out = {r.doc_id: r.score for r in py.score(docs.repartition(3)).collect()}
    for i, _, words in told:
        assert out[i] == pytest.approx(sum(math.log10(p(u, w)) for u, w in of(words)), rel=1e-9)


def test_no_table_of_the_language_model_passes_through_the_driver(spark, monkeypatch):
    """But for vectors over the lexicon and the compressed head, which changes no score."""
    monkeypatch.setattr(pitman_yor, "LEXICON", 40)
    monkeypatch.setattr(pitman_yor, "PAIRS", 300)
    pick = random.Random(7)
    docs = [(i, " ".join(f"w{pick.randrange(pick.randrange(1, 60))}" for _ in range(80))) for i in range(120)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows, as_arrow = [], type(docs).toArrow
    heads, head = [], pitman_yor._head
    with monkeypatch.context() as patch:
        patch.setattr(type(docs), "toArrow", lambda df: rows.append(as_arrow(df)) or rows[-1])
        patch.setattr(type(spark), "createDataFrame", lambda *_, **__: pytest.fail("a table was made on the driver"))
        patch.setattr(pitman_yor, "_head", lambda pairs: heads.append(head(pairs)) or heads[-1])
        out = {r.doc_id: r.score for r in pitman_yor.score(docs).collect()}
    assert rows and max(t.num_rows for t in rows) <= 41
    size, packed = sum(n for n, _ in heads[0].parts), sum(len(x) for _, x in heads[0].parts)
    key, log = heads[0]()
    assert 100 < size == len(key) == len(log) <= 300 and packed < 16 * size and (np.diff(key) > 0).all() and (log < 0).all()
    monkeypatch.setattr(pitman_yor, "PAIRS", 0)
    for r in pitman_yor.score(docs).collect():
        assert r.score == pytest.approx(out[r.doc_id], rel=1e-9)


def test_tables_of_rarer_contexts_are_drawn_one_cell_after_the_other():
    py, pick = pitman_yor, np.random.default_rng(4)
    model = py.Model(np.arange(6), np.ones(6), 900, 50)
    model.discount, model.root_discount, model.customers = 0.6, 0.7, np.full(7, 30.0)
    for _ in range(py.SWEEPS + 1):
        model.root_customers.append(pick.integers(20, 90, 6).astype(float))
        model.root_tables.append(np.full(6, 2.0))
        model.totals.append((400.0, 60.0))
    context, at = np.array([77, 78, 79]), np.array([0, 4, 5])
    word, n = np.array([0, 1, 2, -9, 3, -8, 0, 5]), np.array([9, 1, 150, 7, 20, 0, 4, 2])
    sums, seated = model.sweep_after(context, at, word, n, py.stirling(0.6))
    for row, (a, b) in enumerate([(0, 4), (4, 5), (5, 8)]):
        now, want = [float(min(k, 1)) for k in n[a:b]], [0.0] * (b - a)
        for sweep in range(1, py.SWEEPS + 1):
            for j in range(a, b):
                if n[j] > 1 and word[j] >= 0:
                    root = (model.root_customers[sweep][word[j]] - 1 - 0.7 * 2 + (py.ROOT_CONCENTRATION + 0.7 * 60) / 51) / (py.ROOT_CONCENTRATION + 400 - 1)
                    x = (py.CONCENTRATION + 0.6 * (sum(now) - now[j - a])) * root
                    now[j - a] = py.draw(n[j : j + 1], np.array([x]), py.uniform(sweep, word[j : j + 1], context[row]), py.stirling(0.6), 0.6)[0]
            want = [t + x * (sweep > py.BURN_IN) for t, x in zip(want, now)]
        assert sums[a:b] == pytest.approx(want) and seated[row] == pytest.approx(sum(want) / py.SAMPLES)
    assert sums[0] > py.SAMPLES


# the pipeline
def test_pipeline_stages(spark, docs, texts, tmp_path):
    import corpus_pipeline

    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    w = texts[33].split()
    spark.createDataFrame([(1, " ".join(w[100:125]))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, str(tmp_path))
        assert after.columns == docs.columns and after.count() <= kept.count(), name
        kept = after
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id: r.decoded for r in out.collect()} == {r.doc_id: r.text for r in kept.collect()}
    assert not {33, 34} & {r.doc_id for r in out.collect()}


def test_prefixes_find_every_similar_pair_of_different_roots(spark):
    from metaloom.llm import near_copies

    rng, sets = random.Random(5), []
    for group in range(6):
        base = [group * 1000 + i for i in range(rng.choice([1, 4, 5, 30, 100]))]
        for _ in range(25):
            changed = rng.random() * 0.3
            sets.append(sorted({x if rng.random() > changed else rng.randrange(10_000, 10_050) for x in base}))
    similar = lambda a, b: 5 * len(set(a) & set(b)) >= 4 * len(set(a) | set(b))
    root = [rng.randrange(40) for _ in sets]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if root[i] != root[j]]
    want = {p for p in pairs if similar(sets[p[0]], sets[p[1]])}
    table = spark.createDataFrame(list(enumerate(sets)), "node bigint, shingles array<bigint>")
    roots = spark.createDataFrame(list(enumerate(root)), "node bigint, root bigint")
    found = {tuple(r) for r in near_copies._prefix_pairs(table, roots).collect()}
    assert want and want <= found and found <= set(pairs) and len(found) < len(pairs) // 3
    assert {tuple(r) for r in near_copies._alike(near_copies._prefix_pairs(table, roots), table).collect()} == want
