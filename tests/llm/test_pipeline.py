"""The corpus pipeline stage by stage, and the verdict of the distribution rules, against brute-force versions."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tidewater.llm import common, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(["the", "of", "river", "stone", "house", "and", "water", "road"]) + str(r.randrange(300)) for _ in range(n)) + "."


def shingles(t):
    w = WORD.findall(lower(t))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_duplicates(rows):
    """Rows that stay: one of the least id per group of linked rows, every row without shingles."""
    sets = [shingles(r.text) for r in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
            x, y = group[a], group[b]
            group = [x if g == y else g for g in group]
    least = {}
    for g, r in zip(group, rows):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    return collections.Counter(r.doc_id for r, s in zip(rows, sets) if not s) + collections.Counter(least[g] for g in {g for g, s in zip(group, sets) if s})


def repeated_passages(rows):
    raw = [(r.doc_id, (r.text or "").encode()) for r in rows]
    count = collections.Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    out = {}
    for (k, b), r in zip(raw, rows):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        left = bytes(np.frombuffer(b, np.uint8)[~gone]).decode("utf-8", "ignore")
        if not gone.any() or left:
            out[k] = left if gone.any() else r.text
    return out


def contaminated(text, items):
    w = ITEM_WORD.findall(lower(text))
    own = {tuple(w[i : i + n]) for n in {min(len(x), 10) for x in items} for i in range(len(w) - n + 1)}
    return any(tuple(x[i : i + min(len(x), 10)]) in own for x in items if x for i in range(max(1, len(x) - 9)))


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Input rows and the rows after each stage."""
    common.ship_package(spark)
    root = str(tmp_path_factory.mktemp("pipeline"))
    items = [prose(9000 + i, 25) for i in range(3)]
    passage = prose(777, 60)
    rows = []
    for k in range(400):
        text = "WIN!! $$$ cheap " * 30 if k % 5 == 0 else prose(k, 90)
        if k % 20 == 1:
            text = prose(k - k % 100, 90) + (" extra" if k % 40 == 1 else "")
        if k % 20 == 2:
            text += "\n" + passage
        if k % 20 == 3:
            text += " " + items[k % 3]
        rows.append((k, text, "en", "web", len(text)))
    rows += [(500, None, "en", "web", None), (501, "", None, None, 0), (502, prose(502, 4000), "en", "web", None)]
    spark.createDataFrame(rows, DOCUMENTS).repartition(5).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(k, int(k % 5 != 0), 0) for k in range(400) if k % 4], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs = common.table(spark, root, "documents")
    after = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, root)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        after.append(docs.collect())
    return after, [ITEM_WORD.findall(lower(t)) for t in items]


def test_quality_stage_drops_junk_and_keeps_prose(run):
    after, _ = run
    ids = {r.doc_id for r in after[1]}
    prose_ids = {k for k in range(400) if k % 5} | {502}
    assert len(ids & prose_ids) >= 0.98 * len(prose_ids) and len([k for k in range(0, 400, 5) if k in ids]) <= 2
    assert {tuple(r) for r in after[1]} <= {tuple(r) for r in after[0]}


def test_near_duplicate_stage(run):
    after, _ = run
    assert collections.Counter(r.doc_id for r in after[2]) == near_duplicates(after[1])
    assert len(after[2]) < len(after[1])


def test_repeated_passage_stage(run):
    after, _ = run
    want = repeated_passages(after[2])
    assert {r.doc_id: r.text for r in after[3]} == want
    before = {r.doc_id: r.text for r in after[2]}
    changed = [r for r in after[3] if r.text != before[r.doc_id]]
    assert changed and all(r.n_chars == len(r.text) for r in changed)


def test_decontamination_stage(run):
    after, items = run
    want = {r.doc_id for r in after[3] if not contaminated(r.text, items)}
    assert {r.doc_id for r in after[4]} == want and len(want) < len(after[3])


def test_packing_stage(run):
    from tokenizers import Tokenizer

    after, _ = run
    tokenizer = Tokenizer.from_file(common.TOKENIZER)
    length = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in after[4]}
    tokens, used = collections.Counter(), collections.defaultdict(list)
    for r in after[5]:
        tokens[r.doc_id] += r.length
        used[r.sequence_id].append((r.offset, r.length))
    assert tokens == length
    for pieces in used.values():
        ends = list(itertools.accumulate(n for _, n in sorted(pieces)))
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 1024


def distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    part = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a > 0)
    return math.sqrt(max(0.0, min(1.0, (part(p) + part(q)) / 2)))


def char_classes(text):
    """Lower, upper, digits, space, newline, stop and comma, other punctuation, symbols, beyond ASCII, other ASCII."""
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,", "!?:;'\"-()", "#*$%&|<>"]
    out = [0] * 10
    for c in text:
        out[8 if ord(c) > 127 else next((i for i, g in enumerate(groups) if c in g), 9)] += 1
    return out


def test_rules_verdict(spark):
    common.ship_package(spark)
    r = random.Random(4)
    # under 100 different words per language, so that no cut between equally frequent words is needed
    vocabulary = {"en": [f"the{i}" for i in range(30)] + ["Stone,", "and."], "fr": [f"é{i}" for i in range(30)] + ["maison,", "et"], "xx": ["rare"]}
    rows = []
    for k in range(120):
        lang = ("en", "fr", None)[k % 3]
        weights = [1 / (i + 1) for i in range(32)]
        text = " ".join(r.choices(vocabulary[lang or "en"], weights, k=r.randint(45, 110)))
        if k % 10 == 7:
            text = " ".join(f"{r.randrange(20)}#$" for _ in range(80))
        if k % 10 == 8:
            text = text.upper() + " QZ" * r.randint(0, 20)
        rows.append((k, text, lang))
    rows += [(200, None, "en"), (201, "", "fr"), (202, " ".join(["rare"] * 5), "xx")]
    base = {}
    for k, t, _ in rows:
        w = WORD.findall(t or "")
        tri = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        rep = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        base[k] = len(w) < 50 or 100 * len(rep) > 50 * len(w)
    chars, words = collections.defaultdict(lambda: np.zeros(10)), collections.defaultdict(collections.Counter)
    for k, t, lang in rows:
        if not base[k]:
            chars[lang or ""] += char_classes(t)
            words[lang or ""].update(WORD.findall(lower(t)))
    known = sorted(x for x in words if words[x].total() >= rules.MIN_REFERENCE_WORDS)
    assert known == ["", "en", "fr"]
    want = {}
    for k, t, _ in rows:
        w = WORD.findall(lower(t))
        if len(w) < rules.MIN_WORDS:
            want[k] = (not base[k], None, None, None)
            continue
        best = None
        for x in known:
            top = [y for y, _ in words[x].most_common(rules.COMMON_WORDS)]
            own = collections.Counter(y if y in words[x] and y in top else None for y in w)
            d = distance([own[y] for y in [*top, None]], [words[x][y] for y in top] + [words[x].total() - sum(words[x][y] for y in top)])
            if best is None or d < best[0] - 1e-12:
                best = d, x
        c = distance(char_classes(t), chars[best[1]])
        kept = not base[k] and best[0] <= rules.MAX_WORD_DISTANCE and c <= rules.MAX_CHAR_DISTANCE
        want[k] = (kept, best[1], round(best[0], 6), round(c, 6))
    got = rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)).collect()
    shown = {x.doc_id: (x.kept, x.language, None if x.js_words is None else round(x.js_words, 6), None if x.js_chars is None else round(x.js_chars, 6)) for x in got}
    assert shown == want
    assert {base[k] for k in range(120)} == {True, False} and {v[0] for v in want.values()} == {True, False}
