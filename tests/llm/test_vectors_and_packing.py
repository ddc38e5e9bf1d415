"""Operators 11 to 13 against brute force, and the packing against the tokenizer library."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from metaloom.llm import packing, vector_codes, whitening

VECTORS = "vec_id bigint, embedding array<float>, label int, x string, id int, part int, n int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", 1, 2, 3) for i, v, label in rows], VECTORS).repartition(3)


@pytest.fixture(scope="module")
def some():
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 0.3, (6, 32))
    rows = [(int(i), [float(np.float32(c)) for c in centres[i % 6] + rng.normal(0, 0.05, 32)], None if i % 7 == 0 else int(i % 3)) for i in rng.permutation(300)]
    rows += [rows[0], rows[1], (5000, rows[2][1], 2), (None, rows[3][1], 1), (None, rows[4][1], None)] + [(6000 + k, rows[5][1], 9) for k in range(40)]
    bad = [(7001, None, 1), (7002, [], 1), (-5, [None] * 32, 1), (-4, [float("nan")] * 32, 1), (-3, [float("inf")] + [0.0] * 31, 1), (7003, [1.0] * 31, 1)]
    return rows, bad


def lloyd(rows, parts=8, entries=16, rounds=6):
    """Every distance computed."""
    x = [(i, tuple(math.floor(4096 * c) for c in v), label) for i, v, label in rows]
    x.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(x[0][1]) // parts
    cut = [[r[1][p * size : (p + 1) * size] for r in x] for p in range(parts)]
    books = [[cut[p][k] for k in range(min(entries, len(x)))] for p in range(parts)]
    far = lambda a, b: sum((c - d) ** 2 for c, d in zip(a, b))

    def nearest(p):
        return [min((far(v, e), k) for k, e in enumerate(books[p])) for v in cut[p]]

    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for v, (_, k) in zip(cut[p], nearest(p)):
                members[k].append(v)
            books[p] = [tuple(sum(c) // len(members[k]) for c in zip(*members[k])) if k in members else e for k, e in enumerate(books[p])]
    found = [nearest(p) for p in range(parts)]
    out = [(r[0], "".join(f"{found[p][k][1]:02x}" for p in range(parts)), sum(found[p][k][0] for p in range(parts)), r[2]) for k, r in enumerate(x)]
    by_label = collections.Counter()
    for r in out:
        by_label[r[3]] += r[2]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], digest) for i, code, error, label in out), key=repr)


@pytest.mark.parametrize(("block", "hot"), [(2048, 1000), (40, 4)])
def test_codes_equal_brute_force(spark, some, monkeypatch, block, hot):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    monkeypatch.setattr(vector_codes, "HOT_LABELS", hot)
    rows, bad = some
    out = vector_codes.report(vectors(spark, rows + bad))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == lloyd(rows)


def test_codes_of_few_or_no_rows(spark, some):
    rows, bad = some
    assert vector_codes.report(vectors(spark, bad[:5])).count() == 0
    assert vector_codes.report(vectors(spark, rows).limit(0)).count() == 0
    assert sorted(map(tuple, vector_codes.report(vectors(spark, rows[:5])).collect()), key=repr) == lloyd(rows[:5])
    # lengths that can't be cut equally, and components too large for squares
    odd = [(k, [float(k), -1e30, 3e38, 0.5, float(-k)], 1) for k in range(20)]
    out = vector_codes.report(vectors(spark, odd)).collect()
    assert len(out) == 20 and all(r.error >= 0 and r.code[2:4] == "00" for r in out)


def test_both_trees_find_the_nearest_and_whole_nodes_are_used():
    rng = np.random.default_rng(1)
    seen = collections.Counter()
    for n in (1, 3, 16, 17, 500):
        for k in (1, 2, 5, 16):
            for spread in (3, 3000):
                x, books = rng.integers(-spread, spread, (4, n, 6)), rng.integers(-spread, spread, (4, k, 6))
                if n == 500:
                    x[:, 100:] = books[:, :1] + rng.integers(0, 2, (4, 400, 6))
                tree = vector_codes.Tree(x, 8)
                found, work = vector_codes.walk(tree, books)
                seen.update(work)
                want = ((x[:, :, None, :] - books[:, None]) ** 2).sum(-1).argmin(2)
                total, count = vector_codes.sums(tree, found, k)
                for t in range(4):
                    got = np.empty(n, dtype=int)
                    got[tree.order[t][tree.real[t]]] = found[t][tree.real[t]]
                    assert (got == want[t]).all()
                    for e in range(k):
                        assert (total[t, e] == x[t][want[t] == e].sum(0)).all() and count[t, e] == (want[t] == e).sum()
    assert seen["whole"] > 100 and seen["leaf"] > 100


# 13
def whitened_by_numpy(rows):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    covariance = np.cov((fit - sums / n).T, bias=True)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    return n, x, sums, values, axes


@pytest.mark.parametrize("top", [16, 40])
def test_whitening_equals_numpy(spark, some, top):
    rows, bad = some
    n, x, sums, values, axes = whitened_by_numpy(rows)
    out = whitening.report(vectors(spark, rows + bad), components=top).collect()
    assert len(out) == len(rows) * min(top, 32)
    want = collections.defaultdict(list)
    for (i, _, _), v in zip(rows, x):
        want[i].append((int(sum((n * int(c) - int(s)) ** 2 for c, s in zip(v, sums))), (v - sums / n) @ axes / np.sqrt(values)))
    signs = {}
    for r in out:
        assert r.n == n and r.identity_error < 1e-8
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-8)
        options = [w for d, w in want[r.vec_id] if d == r.deviation]
        assert options
        value = min((w[r.component - 1] for w in options), key=lambda w: abs(abs(w) - abs(r.whitened)))
        assert abs(abs(value) - abs(r.whitened)) < 1e-6
        if abs(value) > 1e-3:
            assert signs.setdefault(r.component, np.sign(value * r.whitened)) == np.sign(value * r.whitened)


def test_whitening_of_degenerate_tables(spark, some):
    rows, bad = some
    assert whitening.report(vectors(spark, bad[:5])).count() == 0
    assert whitening.report(vectors(spark, rows).limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    one = whitening.report(vectors(spark, [rows[0]] * 3)).collect()
    assert len(one) == 48 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.identity_error is None for r in one)
    two = whitening.report(vectors(spark, rows[:2])).collect()
    assert [r.whitened is None for r in sorted(two)] == ([False] + [True] * 15) * 2
    huge = whitening.report(vectors(spark, [(k, [1e30 * (-1) ** k, float(k)], 0) for k in range(10)])).collect()
    assert len(huge) == 20 and all(r.whitened is not None for r in huge if r.component == 1)


def test_polarisation_is_exact_where_squares_leave_a_long():
    rng = np.random.default_rng(2)
    d = rng.integers(-(2**29), 2**29, (50, 5))
    squares = [int(s) for s in whitening.polarised(d)]
    rest = [sum(map(int, d[:, k])) for k in range(5)]
    found, trace = whitening.covariance(50, rest, squares)
    exact = [[(50 * sum(int(r[i]) * int(r[j]) for r in d) - rest[i] * rest[j]) / 2500 for j in range(5)] for i in range(5)]
    assert found.tolist() == exact and trace == pytest.approx(sum(exact[k][k] for k in range(5)), rel=1e-15)


# 12
DOCS = "doc_id bigint, text string, row string, part int, seq bigint, start string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_file())


def check_packing(spark, library, texts, **options):
    df = spark.createDataFrame([(i, t, "clash", 1, 2, "x") for i, t in texts], DOCS).repartition(3)
    out, cut = packing.pack(df, keep_ids=True, **options)
    size = options.get("size", packing.SIZE)
    rows, ids = out.collect(), collections.defaultdict(list)
    for i, t in texts:
        ids[i].append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4"))
    documents, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        documents[r.part, r.row].append(r)
        places[r.sequence_id].append(r)
    left = {i: list(x) for i, x in ids.items()}
    tokens = {}
    for key, of in documents.items():
        of.sort(key=lambda r: r.start)
        assert [r.start for r in of] == np.cumsum([0, *[r.length for r in of]])[:-1].tolist() and min(r.length for r in of) > 0
        own = next(x for x in left[of[0].doc_id] if len(x) == of[0].doc_tokens and all(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in of))
        left[of[0].doc_id] = [x for x in left[of[0].doc_id] if x is not own]
        assert sum(r.length for r in of) == len(own)
        tokens[key] = own
    assert not any(left.values())
    lengths = []
    for of in places.values():
        of.sort(key=lambda r: r.offset)
        assert [r.offset for r in of] == np.cumsum([0, *[r.length for r in of]])[:-1].tolist()
        lengths.append(sum(r.length for r in of))
    total = sum(len(x) for some in ids.values() for x in some)
    # no padding at all
    assert sorted(lengths) == sorted([size] * (total // size) + [1 << k for k in range(12) if (total % size) >> k & 1])
    for r in packing.sequences(out, cut, size, pad=7).collect():
        want = np.concatenate([tokens[p.part, p.row][p.start : p.start + p.length] for p in places[r.sequence_id]])
        assert np.frombuffer(r.ids, "<u4").tolist() == want.tolist()
    return rows


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(4)
    words = ["Tree", "éle", "house,", "river.", "b́ird", "ΣΑΣ", "İn", "don't", "x<|endoftext|>y", "́", "日本語の文", "12345", "##", "a\x85b", "z w", "-" * 90]
    prose = lambda n: "".join(pick.choice(words) + pick.choice([" ", "\n", "\t", "  ", "\r\n", " "]) for _ in range(n))
    made = [(i, prose(pick.choice([1, 5, 40, 150, 400]))) for i in range(60)] + [(100, prose(6000)), (101, None), (102, ""), (103, " \n "), (None, prose(30)), (None, None), (104, "y" * 30_000)]
    return made + [made[0], made[0], made[60]]


def test_packing(spark, library, texts):
    check_packing(spark, library, texts)


@pytest.mark.parametrize(("size", "unit", "stream"), [(64, 4, 128), (128, 8, 1 << 15)])
def test_packing_in_small_sequences(spark, library, texts, monkeypatch, size, unit, stream):
    monkeypatch.setattr(packing, "STREAM", stream)
    monkeypatch.setattr(packing, "RANGES", 3)
    monkeypatch.setattr(packing, "AT_ONCE", 500)
    monkeypatch.setattr(packing, "MEMO", 8)
    check_packing(spark, library, texts, size=size, unit=unit)


def test_encoder_equals_the_library(library, monkeypatch):
    pick = random.Random(8)
    letters = "aZé\u00dfÑñ\u00d7\u00f7'st,.#$09 \n\u0301\u00b5İΣς\x85\u2028½²字\x1f<|"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(60))) for _ in range(800)] + ["I'll don't 'street ##'s '' x's's", "a<|endoftext|>b <|startoftext|>", "É" * 200, "café's 3ème été,"]
    for memo in (8, 400_000):
        monkeypatch.setattr(packing, "MEMO", memo)
        from pathlib import Path

        found = packing.Encoder(Path(packing.default_file()).read_text())
        assert found.by_words
        for k in range(0, len(texts), 50):
            for text, ids in zip(texts[k : k + 50], found.encode(texts[k : k + 50])):
                assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    import public_tokenizers

    other = packing.Encoder(Path(public_tokenizers.path("byte_bpe_50k.json")).read_text())
    assert not other.by_words and np.frombuffer(other.encode(["a  b"])[0], "<u4").tolist() == other.library.encode("a  b").ids


def test_packing_of_few_texts(spark, library):
    assert check_packing(spark, library, [(1, None)])[0].length == 1
    check_packing(spark, library, [(1, "one two three")])
    empty = spark.createDataFrame([], DOCS)
    assert packing.report(empty).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and packing.report(empty).count() == 0


def test_patterns_hold_all_pieces_in_few_sequences():
    rng = np.random.default_rng(0)
    for n in (1, 5, 200, 20_000):
        sizes = np.minimum(rng.lognormal(6, 1.2, n).astype(int) % 2048 + 1, 2047)
        counts = collections.Counter((-(-sizes // 8)).tolist())
        found, have = packing.patterns(counts, 256), collections.Counter()
        for p in found:
            assert sum(c * k for c, k in p.of.items()) <= 256
            for c, k in p.of.items():
                have[c] += k * p.times
        assert all(have[c] >= k for c, k in counts.items())
        assert sum(p.times for p in found) <= sum(c * k for c, k in counts.items()) / 256 * 1.01 + 2


def test_knapsack_and_inverse():
    pick = random.Random(1)
    for _ in range(20):
        classes = np.array(sorted(pick.sample(range(1, 20), 4)))
        prices = np.array([pick.random() for _ in classes])
        worth, of = packing.knapsack(prices, classes, 24)
        best = {0: 0.0}
        for w in range(1, 25):
            best[w] = max([best[w - 1]] + [best[w - c] + p for c, p in zip(classes.tolist(), prices) if c <= w])
        assert worth == pytest.approx(best[24]) == pytest.approx((of * prices).sum()) and (of * classes).sum() <= 24
    square = np.random.default_rng(3).normal(size=(40, 40))
    square[0, 0] = 0
    assert np.abs((packing.inverted(square)[:, :, None] * square[None]).sum(1) - np.eye(40)).max() < 1e-9
