"""Vector codes, the prefix trie and SimHash components against brute-force versions."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from tidewater.llm import common, conversations, simhash, vector_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship_package(spark)


# vector codes


def whole(v, width):
    if v is None or any(x is None or not np.isfinite(x) for x in v):
        return None
    x = [int(np.floor(np.float64(c) * 256)) for c in v]
    return [max(-vector_codes.BOUND, min(vector_codes.BOUND, c)) for c in x] + [0] * (width - len(x))


def brute_codes(rows, width, parts=16, entries=64, rounds=2):
    kept = [(i, label, whole(v, width)) for i, label, v in rows if whole(v, width) is not None]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    step = width // parts
    codes, errors, books = [[] for _ in kept], [0] * len(kept), []
    for p in range(parts):
        cells = [r[2][p * step : (p + 1) * step] for r in kept]
        book = [list(c) for c in cells[:entries]]

        def nearest(cell):
            return min((sum((a - b) ** 2 for a, b in zip(cell, e)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            groups = collections.defaultdict(list)
            for cell in cells:
                groups[nearest(cell)[1]].append(cell)
            for k, found in groups.items():
                book[k] = [sum(c) // len(found) for c in zip(*found)]
        for n, cell in enumerate(cells):
            d, k = nearest(cell)
            codes[n].append(k)
            errors[n] += d
        books.append(book)
    total = collections.Counter()
    for (_, label, _), e in zip(kept, errors):
        total[label] += e
    return collections.Counter((r[0], r[1], bytes(c), e, total[r[1]]) for r, c, e in zip(kept, codes, errors)), books


def coded(df):
    out, books = vector_codes.compress_vectors(df)
    return collections.Counter((r.vec_id, r.label, bytes(r.codes), r.error, r.label_error) for r in out.collect()), books


def vectors(n, width, seed=0, spread=0.3):
    r = random.Random(seed)
    return [(i, r.choice([None, 0, 1, 7]), [float(np.float32(r.gauss(0, spread))) for _ in range(width)]) for i in range(n)]


def test_vector_codes_with_every_case(spark):
    rows = vectors(150, 32)
    rows += [(3, 1, rows[40][2]), (3, 1, rows[40][2]), (None, None, rows[41][2]), (500, 2, None), (501, 2, [1.0, None]), (502, 2, [float("nan")] * 32), (503, 2, [float("inf")] * 32)]
    rows += [(504, 7, []), (505, 7, [0.5] * 20), (506, 7, [-1e30, 1e30] + [0.0] * 30)]
    df = spark.createDataFrame([(i, v, la, "x", 1, "c") for i, la, v in rows], "vec_id long, embedding array<float>, label int, code string, error int, codes string").repartition(4)
    got, books = coded(df)
    want, expected = brute_codes(rows, 32)
    assert got == want
    assert books.entries.tolist() == expected and books.text() == ",".join(str(x) for b in expected for e in b for x in e)


def test_vector_codes_small_and_empty(spark):
    schema = "vec_id long, embedding array<double>, label string"
    rows = [(2, "a", [0.1] * 16), (1, "b", [0.2] * 16)]
    got, books = coded(spark.createDataFrame([(i, v, la) for i, la, v in rows], schema))
    assert books.entries.shape == (16, 2, 1) and got == brute_codes(rows, 16)[0]
    for none in ([], [(1, [float("nan")], "a")]):
        out, books = vector_codes.compress_vectors(spark.createDataFrame(none, schema))
        assert books is None and out.columns == ["vec_id", "label", "codes", "error", "label_error"] and out.count() == 0


def test_walk_in_small_blocks_and_chunks(spark, monkeypatch):
    r = np.random.default_rng(1)
    rows = r.integers(-3, 4, (500, 4))
    entries = r.integers(-3, 4, (20, 4))
    leaves = vector_codes.leaves_of(rows)
    assert len(leaves.parts) == len({tuple(x) for x in rows.tolist()}) and leaves.counts.sum() == 500 and (leaves.parts[leaves.leaf_of] == rows).all()
    want = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
    for block in (1, 3, 7, 1000):
        best, error = vector_codes.nearest(leaves, entries, block)
        assert (best[leaves.leaf_of] == want.argmin(axis=1)).all() and (error[leaves.leaf_of] == want.min(axis=1)).all()


def test_decoded_vectors_are_off_by_the_error(spark):
    rows = vectors(80, 16, 3)
    out, books = vector_codes.compress_vectors(spark.createDataFrame([(i, v, la) for i, la, v in rows], "vec_id long, embedding array<float>, label int"), entries=8)
    found = out.collect()
    back = books.vectors(np.array([list(r.codes) for r in found]))
    given = {i: whole(v, 16) for i, _, v in rows}
    assert [int(((np.array(given[r.vec_id]) - b) ** 2).sum()) for r, b in zip(found, back)] == [r.error for r in found]


# prefix trie


def brute_trie(rows):
    found = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            tie = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16]
            found[c].append(((t is not None, t or 0, tie), (r, x)))
    own = {c: [y for _, y in sorted(v)] for c, v in found.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for c, q in built.items():
        for d in range(len(q) + 1):
            members[tuple(q[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, collections.Counter()
    for p in sorted(members, key=len, reverse=True):
        m = members[p]
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = ((len(m) - 1) * len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in children[p])
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out[(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def nodes(df, width):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return collections.Counter(tuple(r[n] for n in names) for r in conversations.prefix_nodes(df, width).collect())


def chats():
    r = random.Random(5)
    rows = []
    for c in range(90):
        if c % 7 == 6:
            continue  # absent ids, some of them the first of their family
        n = 40 if c in (10, 11, 12, 60) else r.choice([1, 2, 3, 5, 9, 20])
        shared = c in (10, 11, 12, 60, 61, 62)
        rows += [(c, t, r.choice(["user", "assistant"]) if not shared else "user", f"same {t}" if shared and t < 30 else r.choice(["hi", "é ok", "", "x" * 30])) for t in range(n)]
    rows += [(5, None, None, None), (5, None, "system", "first"), (5, 0, "user", "tied"), (5, 0, "user", "tied"), (5, 0, "user", "tied too"), (None, 0, "user", "lost"), (None, None, None, None)]
    rows += [(10**12, t, "user", "long ago " * 40_000) for t in range(2)] + [(-3, 0, "user", "x"), (-5, 1, "user", "y")]
    return rows


@pytest.mark.parametrize("width", [8, 3])
def test_prefix_trie(spark, width):
    rows = chats()
    want = brute_trie([r for r in rows if (r[0] or 0) >= 0])
    df = spark.createDataFrame([(t, c, x, ro, "clash", 1) for c, t, ro, x in rows if (c or 0) >= 0], "turn long, conv_id long, text string, role string, node string, depth int").repartition(5)
    assert nodes(df, width) == want
    assert max(k[1] for k in want) > 3 * 8  # several blocks, shared and alone


def test_prefix_trie_of_copies_and_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(5 * c, t, "user", f"t{t}") for c in range(200) for t in range(12)]
    assert nodes(spark.createDataFrame(rows, schema).repartition(6), 4) == brute_trie(rows)
    assert conversations.prefix_nodes(spark.createDataFrame([], schema)).count() == 0
    assert conversations.prefix_nodes(spark.createDataFrame([(None, 1, "user", "x")], schema)).count() == 0


# SimHash


def brute_print(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 4 and group[a] != group[b]:
            group = [group[a] if g == group[b] else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return collections.Counter((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, group))


def near_copies(n, seed=1):
    r = random.Random(seed)
    base = [f"w{r.randrange(500)}" for _ in range(300)]
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(300)] = f"edit{r.randrange(10**6)}"
        rows.append((1000 - i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("long_list", [1024, 1])
def test_simhash_components(spark, long_list):
    rows = near_copies(60) + [(1, None), (2, ""), (2, " \t\n"), (3, "One two"), (4, "one TWO"), (5, "É é"), (None, "one two"), (None, "alone here with several words"), (6, "x " * 70_000), (6, "x " * 70_000)]
    rows += [(2000 + i, " ".join(f"u{random.Random(i).randrange(99)}" for _ in range(40 + i))) for i in range(20)]
    df = spark.createDataFrame([(t, i, "clash", 1) for i, t in rows], "text string, doc_id long, print string, n int").repartition(4)
    got = collections.Counter(map(tuple, simhash.simhash_components(df, long_list).collect()))
    assert got == brute_components(rows)
    assert len({k[1] for k in got}) > 30


@pytest.mark.parametrize("long_list", [1024, 3])
def test_simhash_links_of_any_byte_pattern(spark, long_list):
    """Fingerprints at 0 to 6 differing bits anywhere, and a crowd around one of them: connected exactly as brute force says."""
    r = random.Random(7)
    prints = set()
    for _ in range(60):
        a = r.getrandbits(64)
        prints.add(a)
        for k in range(1, 7):
            prints.add(a ^ sum(1 << b for b in r.sample(range(64), k)))
    center = r.getrandbits(64)
    prints |= {center ^ sum(1 << b for b in r.sample(range(24), 3)) for _ in range(80)}
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    work = common.Workspace(spark, "links")
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "print long"), work, long_list).collect()
    group = {p: p for p in signed}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in found:
        assert bin((a ^ b) & (1 << 64) - 1).count("1") <= 4
        group[root(a)] = root(b)
    for (a, x), (b, y) in itertools.combinations(zip(prints, signed), 2):
        if bin(a ^ b).count("1") <= 4:
            assert root(x) == root(y)


def test_simhash_of_an_empty_table(spark):
    out = simhash.simhash_components(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0
