"""Each operator against a brute-force version, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import common, decontam, html, jaccard, language, language_model, packing, quality, rules, suffix, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, kept string, score double, cls string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(r.choice("abcdefgé") * r.randint(1, 3) + str(r.randrange(vocabulary)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    common.ship_package(spark)
    base = words(1, 120)
    edited = base.split()
    edited[60] = "changed"
    passage = words(2, 60)
    rows = [(1, base), (2, base), (2, base), (3, " ".join(edited)), (4, None), (5, ""), (6, "One two"), (7, "one TWO\n"), (8, " \t\n"), (9, words(3, 3000)),
            (10, words(4, 80) + "\n" + passage), (11, passage + " " + words(5, 70)), (12, "x" * 900), (13, "é" * 300), (14, words(6, 51) + "\nsame line\nsame line\n"), (None, words(7, 60)), (None, base)]
    rows += [(100 + i, words(50 + i, 90)) for i in range(20)]
    return spark.createDataFrame([(i, t, "en" if i else None, "clash", 0.5, "c") for i, t in rows], SCHEMA).repartition(3)


def empty(docs):
    return docs.limit(0)


def test_components(docs):
    rows = docs.select("doc_id", "text").collect()

    def shingles(t):
        w = WORD.findall(lower(t))
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [shingles(r.text) for r in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = group[a], group[b]
            group = [x if g == y else g for g in group]
    least = {g: min((rows[i].doc_id for i in range(len(rows)) if group[i] == g and rows[i].doc_id is not None), default=None) for g in set(group)}
    want = collections.Counter((r.doc_id, len(s), least[g] if s else r.doc_id) for r, s, g in zip(rows, sets, group))
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect())
    assert got == want
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and not {2, 3, 7} & set(ids) and ids[None] == 1 and ids[4] == ids[5] == ids[8] == 1


def test_large_regions_are_exact(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_REGION", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    base = words(1, 100, 10_000).split()
    rows = []
    for i in range(50):
        r = random.Random(i)
        copy = list(base)
        for _ in range(r.randint(0, 4)):
            copy[r.randrange(100)] = f"edit{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(96)} for i, t in rows}
    group = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
            lo, hi = sorted((group[a], group[b]))
            group = {k: lo if g == hi else g for k, g in group.items()}
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(df).collect()} == group


@pytest.mark.parametrize("limit", [suffix.FILTER_IDS, 0])
def test_repeats(docs, limit):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    count = collections.Counter(b[i : i + 200] for _, b in rows for i in range(len(b) - 199))
    want = collections.Counter()
    for k, b in rows:
        cover = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                cover[i] += 1
                cover[i + 200] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])[: len(gone)]).sum())
        want[(k, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())] += 1
    got = suffix.remove_repeats(docs, limit=limit).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert collections.Counter(map(tuple, got)) == want


def test_pipeline_form_keeps_columns(docs):
    left = suffix.without_repeats(docs)
    assert left.columns == docs.columns and left.where("doc_id = 100").count() == 1 and left.where("doc_id = 2").count() == 0


def test_contamination(spark, docs):
    texts = {r.doc_id: r.text for r in docs.where("doc_id >= 100").collect()}
    w = texts[100].split()
    items = [(1, " ".join(w[5:17]).upper()), (2, "one two"), (3, "!!"), (4, None), (5, " ".join(w[40:49]) + " other words"), (1, " ".join(w[5:17])), (6, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    grams = []
    for i, t in items:
        x = ITEM_WORD.findall(lower(t))
        grams += [(str(i), x[k : k + 10]) for k in range(max(1, len(x) - 9))] if x else []
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        x, hit, found = ITEM_WORD.findall(lower(r.text)), set(), set()
        for i, g in grams:
            for k in range(len(x) - len(g) + 1):
                if x[k : k + len(g)] == g:
                    hit.update(range(k, k + len(g)))
                    found.add(i)
        want[(r.doc_id, len(x), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))] += 1
    got = decontam.decontaminate(docs, bench).drop("items").collect()
    assert collections.Counter(map(tuple, got)) == want
    clean = decontam.clean_rows(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(n for k, n in want.items() if not k[5])


def test_contamination_of_many_windows(spark):
    """Windows of every width that begin and end at text borders, one of them in a third of all rows, a long text, clashing columns."""
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(6)] + ["É", "ß9"]
    items = [(f"i{k}", " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 5, 9, 10, 14])))) for k in range(40)] + [("a,b", "the shared one"), ("b", "The-shared one"), (None, "w1"), ("n", None)]
    items = [(k, t) for k, t in items if t is None or len(t.split()) > 2 or k in ("a,b", "b", None)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(60)) + (" the shared one" if i % 3 == 0 else "")) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "the shared"), (0, rows[0][1]), (63, words(9, 60_000) + " the shared one " + words(10, 60_000)), (None, "the shared one")]
    rows += [(70 + i, f"w1 {t} w2 w3 {t}") for i, (k, t) in enumerate(items) if t]
    docs = spark.createDataFrame([(i, t, "x", 1.5) for i, t in rows], "doc_id long, text string, words string, size double").repartition(4)
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id string, text string, doc_id int")
    grams = {}
    for k, t in items:
        x = ITEM_WORD.findall(lower(t))
        for a in range(max(1, len(x) - 9)) if x and k else ():
            grams.setdefault(tuple(x[a : a + 10]), set()).add(k)
    want = collections.Counter()
    for i, t in rows:
        x, hit, found = ITEM_WORD.findall(lower(t)), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(x) - n + 1):
                if ids := grams.get(tuple(x[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= ids
        want[(i, len(x), len(hit), len(found), ",".join(sorted(found)), bool(hit))] += 1
    got = decontam.decontaminate(docs, bench)
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got.collect()) == want
    assert any(k[2] > 20 for k in want) and any(k[0] == 63 and k[2] >= 3 for k in want)
    clean = decontam.clean_rows(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(n for k, n in want.items() if not k[5])
    assert decontam.clean_rows(docs.limit(0), bench).count() == 0 and decontam.clean_rows(docs, bench.limit(0)).count() == len(rows)


def test_rules_base(docs):
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        t = r.text or ""
        w = WORD.findall(t)
        tri = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        rep = {k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        want[(r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w))] += 1
    got = rules.quality_rules(docs).collect()
    assert collections.Counter(tuple(r)[:7] for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)
    p = np.array([[1.0, 0.0], [0.5, 0.5]])
    assert np.allclose(rules.js_distance(p, np.array([0.0, 1.0])), [1.0, math.sqrt((0.5 * math.log2(0.5 / 0.25) + 0.5 * math.log2(0.5 / 0.75) + math.log2(1 / 0.75)) / 2)])


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(common.TOKENIZER)
    rows = packing.pack_documents(docs, common.TOKENIZER, capacity=64).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range((len(ids) - 1) % 64 + 1, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            want[(r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want


def test_packing_exchanges_to_the_end(spark):
    """Sizes of which every part alone leaves gaps, a third of them one row that repeats; no worse than one best-fit run over all."""
    r = random.Random(2)
    lengths = [r.randint(1, 64) for _ in range(1500)] + [23] * 750
    rows = [(7 if n == 23 else i, 0, 0, n, n, i) for i, n in enumerate(lengths)]
    work = common.Workspace(spark, "test-packing")
    table = work.write(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, number long").repartition(3), "pieces")
    packed = packing.pack(table, work, capacity=64, part_pieces=100, exchange=400)
    got = packed.collect()
    assert collections.Counter(r.length for r in got) == collections.Counter(lengths)
    by = collections.defaultdict(list)
    for x in got:
        by[x.sequence_id].append((x.offset, x.length))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(spans)) and sum(spans[-1]) <= 64
    used, bound = packing.packing_bound(packed, 64)
    alone = packing.best_fit_decreasing(np.array(sorted(lengths, reverse=True)), 64)[2]
    assert used == len(by) and packing.lower_bound(np.array(lengths), 64) == bound <= used <= alone + 8
    whole = packing.pack(table, work, capacity=64)
    assert bound <= packing.packing_bound(whole, 64)[0] <= alone


def test_units_equal_the_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from tidewater.llm import textkernel as K

    tokenizer = Tokenizer.from_file(common.TOKENIZER)
    tokenizer.encode_special_tokens = True
    bits = ["a", " ", "\n", "\n\n", " b", "é", "’", "'s", "don't", " ", "x ", "  ", "\t", ".", "...", "¿Qué?", "ñ.", "÷", "12", "3a", "<|endoftext|>", "—", "€.", "\x00", " "]
    r = random.Random(0)
    texts = ["".join(r.choices(bits, k=r.randint(0, 30))) for _ in range(3000)]
    table = packing.unit_table(common.TOKENIZER)
    for chunk in K.chunks(pa.array(texts)):
        ids, offsets = packing.token_ids(chunk, table)
        for i in range(chunk.n):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == tokenizer.encode(texts[chunk.first + i], add_special_tokens=False).ids + [2]


def test_bounds_hold():
    r = np.random.default_rng(1)
    for _ in range(30):
        lengths = np.sort(r.integers(1, 101, r.integers(1, 300)))[::-1]
        bins, offsets, used = packing.best_fit_decreasing(lengths, 100)
        assert np.bincount(bins, lengths).max() <= 100 and len(np.unique(bins)) == used >= packing.lower_bound(lengths, 100)


def test_language_model_base_and_mass(docs):
    rows = [(r.doc_id, WORD.findall(lower(r.text)) + ["\n"]) for r in docs.select("doc_id", "text").collect()]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    count = collections.Counter(x for i, w in rows if not held(i) for x in w)
    n, v = sum(count.values()), len(count)
    got = language_model.score_texts(docs, frequent=50).collect()
    want = sorted((i if i is not None else -1, held(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for i, w in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    model = language_model.MaxEnt(np.zeros(language_model.CLASSES))
    model.weights[:] = np.random.default_rng(0).normal(size=model.weights.shape)
    assert np.allclose(np.exp(model.log_softmax(np.array([[0, 2048, 4096]]))).sum(), 1, atol=1e-5)


def test_html():
    page = """<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=/x>Menu</a></ul></nav><!-- <p>no</p> -->
    <div class="ad">Buy, now</div><article><h1>Head &amp; line</h1><p><b>First,  para\n with, commas and enough text to count.<p>Second<br>one &lt;here&gt;.</p><section id="comments"><p>I think, that, it is great, indeed so</p></section></article>
    <aside>side</aside><footer><p>&copy; foot</p></footer>"""
    assert html.extract(page) == "Head & line\nFirst, para with, commas and enough text to count.\nSecond one <here>."
    assert html.extract(None) == html.extract("") == html.extract("<p></p>") == ""
    long = "<div id=content>" + "<p>Some words, more words, and so on until there is enough.</p>" * 3000 + "</div><div class=sidebar><p>x, y, z and so on and so on and on</p></div>"
    assert html.extract(long).count("\n") == 2999
    assert html.extract("<p>unclosed <a href='x") == "unclosed <a href='x"


def test_classifiers_and_language(spark):
    common.ship_package(spark)
    r = random.Random(3)
    good = lambda k: " ".join(random.Random(k).choice(["the", "of", "river", "stone", "house", "and", "water", "road"]) + random.Random(k * 7 + i).choice(["", "s", "ed", ","]) for i in range(80)) + "."
    rows, labels = [], []
    for k in range(600):
        junk, toxic = k % 5 == 0, k % 4 == 1
        text = "WIN!! $$$ " * 40 if junk else good(k)
        if toxic:
            text = text.replace(" ", " scoundrel ", 1)
        rows.append((k, text, "x"))
        if r.random() < 0.7:
            labels.append((k, int(not junk), int(toxic)))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "the house", "x"), (0, rows[0][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels + [(5, None, None)], "doc_id long, quality int, toxic int")
    truth = {k: (k % 5 != 0, k % 4 == 1) for k in range(600)}
    for got, which in ((quality.score_quality(df, lab), 0), (toxicity.score_toxicity(df, lab), 1)):
        found = got.collect()
        assert len(found) == len(rows) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in found)
        held = [x for x in found if x.held_out and x.doc_id in truth]
        assert np.mean([x.predicted == truth[x.doc_id][which] for x in held]) > 0.95
    none = lab.limit(0)
    assert {x.score for x in quality.score_quality(df, none).collect()} == {0.5}
    assert toxicity.score_toxicity(df, none).count() == len(rows)
    assert quality.keep_quality(df, lab).columns == df.columns
    texts = {"en": "the house and the river of stone " * 8, "fr": "la maison et les rivières de pierre que " * 8}
    pages = [(i, f"http://{l}.example.net/{l}/{i}", f'<html lang="{l}"><body><p>{texts[l]}</p>') for i, l in enumerate(["en", "fr"] * 5)] + [(90, None, None), (91, "http://fr.example.net/", '<html lang="en"><p>' + texts["fr"])]
    found = {x.page_id: x.lang for x in language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), spark.createDataFrame([(t, l) for l, t in texts.items()] + [(None, "en"), ("x", None)], "text string, lang string")).collect()}
    assert all(found[i] == ("en", "fr")[i % 2] for i in range(10)) and found[91] == "fr" and found[90] in texts


def test_empty_tables(docs, spark):
    none = empty(docs)
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (jaccard.jaccard_components(none), suffix.remove_repeats(none), decontam.decontaminate(none, bench), rules.quality_rules(none), packing.pack_documents(none, common.TOKENIZER), language_model.score_texts(none), quality.score_quality(none, labels), toxicity.score_toxicity(none, labels), html.main_texts(pages), language.identify(pages, none)):
        assert df.count() == 0
    assert decontam.decontaminate(docs, bench).where("contaminated").count() == 0
