"""The operators on documents: against plain versions, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from lumenframe.llm import fingerprints, jaccard, langid, mixing, packing, pseudo, quality
from lumenframe.llm.wordhash import U

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, _text string, u long"
WHITE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in WHITE.split(lower) if w]


def corpus():
    """Rows with every odd case; the last columns clash with names that operators use inside."""
    rng = random.Random(5)
    pool = {"en": "the of and to in is that it was for river stone light".split(), "de": "der die und zu ist nicht das ein für über straße haus".split()}
    rows = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(rng.choice(pool[lang]) + rng.choice(["", "", "x", "yz", "q"]) for _ in range(rng.randint(3, 120))), lang, f"s{i % 4}", 0))
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    for i in range(60, 90):  # near copies of one text
        near = list(base)
        for _ in range(i % 7):
            near[rng.randrange(150)] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(near), "en", "hot", 0))
    rows += [(90, None, "en", "s1", 0), (91, "", None, None, 0), (92, " \t\n", "de", None, 0), (93, "One", "en", "s1", 0), (94, "one two", "en", "s1", 0), (95, "ONE two", None, "s1", 0)]
    rows += [(96, rows[3][1], "en", "s1", 0), (96, rows[3][1], "en", "s1", 0), (None, rows[4][1], "en", "s2", 0), (97, "long " * 30_000, "en", "s2", 0), (98, "x" * 5000, "en", "s3", 0), (99, "ünï 你好 🎉   a", "de", "s3", 0)]
    return [(*r, "clash", "clash", 1) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, k=3, percent=90):
    sets = [(i, shingles(t, k)) for i, t, *_ in rows]
    up = {i: i for i, _ in sets if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if None not in (i, j) and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(i), root(j)
                up[max(p, q)] = min(p, q)
    return Counter((i, len(x), None if i is None else root(i) if x else i) for i, x in sets)


def test_jaccard_equals_brute_force(docs, empty):
    found = jaccard.components(docs).collect()
    expected = brute_components(corpus())
    # A row without an id has no component of its own; it may name its class.
    assert Counter((r.doc_id, r.n_shingles, r.component_id if r.doc_id is not None else None) for r in found) == expected
    assert jaccard.components(empty).collect() == []


def test_jaccard_in_large_clusters(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "UNIT", 900)
    found = jaccard.components(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id if r.doc_id is not None else None) for r in found) == brute_components(corpus())


def test_jaccard_with_one_id_of_several_texts(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(3, a, ""), (5, a, ""), (5, b, ""), (7, b + " end", ""), (9, b + " end", ""), (11, "other words here", "")]
    found = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string, keys string").repartition(3)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)
    assert {r.component_id for r in found} == {3, 11}


def test_one_of_each_keeps_whole_rows(docs):
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = {c for i, _, c in brute_components(corpus(), 5, 80) if i is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) - {None} == expected and len(ids) == len(expected) + 1


def test_skip_join_and_signatures():
    rng = np.random.default_rng(0)
    for turn in range(25):
        percent = (90, 80)[turn % 2]
        least = jaccard.bands(percent)
        base = [rng.integers(0, 1 << 63, size=rng.integers(8, 160)).astype(U) for _ in range(3)]
        sets = []
        for _ in range(40):
            s = base[rng.integers(3)].copy()
            at = rng.choice(len(s), min(len(s), int(rng.integers(0, max(2, len(s) // (percent // 10))))), replace=False)
            s[at] = rng.integers(0, 1 << 63, size=len(at)).astype(U)
            sets.append(np.unique(s))
        up = list(range(len(sets)))
        root = lambda x: x if up[x] == x else root(up[x])  # noqa: B023, E731
        for i in range(len(sets)):
            for j in range(i):
                o = len(np.intersect1d(sets[i], sets[j]))
                if 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                    up[max(root(i), root(j))] = min(root(i), root(j))
                    # Whatever is called common, linked sets meet: the order alone changes.
                    some = np.unique(np.concatenate(base)[rng.random(sum(map(len, base))) < 0.4])
                    some = np.unique(some >> U(16))
                    common = some, rng.integers(3, 50, len(some))
                    for known in (common, (np.zeros(0, U), np.zeros(0, np.int64))):
                        keys = [set(jaccard.rare_signatures(s, percent, least, known)) for s in (sets[i], sets[j])]
                        assert keys[0] & keys[1]
                    assert set(jaccard.signatures(sets[i], percent, least)) & set(jaccard.signatures(sets[j], percent, least))
        expected = [root(i) for i in range(len(sets))]
        up = list(range(len(sets)))
        for a, b in jaccard.skip_join(np.arange(len(sets)), sets, percent):
            up[max(root(a), root(b))] = min(root(a), root(b))
        assert [root(i) for i in range(len(sets))] == expected


def test_quality_rejects_junk_and_keeps_text(spark, empty):
    rng = random.Random(1)
    text = lambda: " ".join("".join(rng.choice("abcdefghiou") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 200)))
    rows = [(i, text()) for i in range(300)]
    rows += [(300 + i, " ".join([rng.choice(["spam", "buy"])] * 80)) for i in range(20)] + [(320 + i, " ".join(w + "###" for w in text().split())) for i in range(20)] + [(340 + i, text().upper() + "!!") for i in range(10)]
    rows += [(400, None), (401, ""), (402, " \n"), (403, "word " * 20_000), (403, "word " * 20_000), (None, text())]
    found = {r.doc_id: r for r in quality.classify(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[i].keep for i in range(300)) == 300
    assert sum(found[i].keep for i in range(300, 350)) <= 2
    assert not any(found[i].keep for i in (400, 401, 402, 403)) and found[400].score == 0
    assert quality.classify(empty).collect() == []


def test_quality_em_finds_rates():
    rng = np.random.default_rng(2)
    good = rng.random(20_000) < 0.8
    right = np.where(good, 0.998, 0.6)[:, None]
    vote = (rng.random((20_000, len(quality.NAMES))) < right) == good[:, None]
    labels = quality.Labels(Counter(quality.code(list(v)) for v in vote.astype(int)))
    assert abs(labels.share - 0.8) < 0.05
    guess = np.array([labels.posterior(quality.code(list(v))) > 0.5 for v in vote[:2000].astype(int)])
    assert (guess == good[:2000]).mean() > 0.97


@pytest.mark.parametrize("share", [0.8, 0.6])
def test_quality_em_finds_every_labellers_own_rates(share):
    rng = np.random.default_rng(12)
    good = rng.random(40_000) < share
    on_good = np.array([0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 0.85, 0.97, 0.9, 0.75, 0.65])  # votes good on good texts
    on_bad = np.array([0.4, 0.1, 0.3, 0.6, 0.2, 0.5, 0.15, 0.4, 0.05, 0.3, 0.2])  # votes good on bad texts
    vote = (rng.random((len(good), len(on_good))) < np.where(good[:, None], on_good, on_bad)).astype(int)
    vote[rng.random(vote.shape) < 0.1] = 2
    labels = quality.Labels(Counter(quality.code(list(v)) for v in vote))
    assert abs(labels.share - share) < 0.03
    assert np.abs(labels.rates[1] - on_good).max() < 0.03 and np.abs(labels.rates[0] - on_bad).max() < 0.03


def test_quality_em_finds_the_one_bad_labeller():
    rng = np.random.default_rng(13)
    good = rng.random(20_000) < 0.8
    on_good = np.array([0.8] + [0.998] * (len(quality.NAMES) - 1))
    vote = (rng.random((len(good), len(on_good))) < np.where(good[:, None], on_good, 0.5)).astype(int)
    labels = quality.Labels(Counter(quality.code(list(v)) for v in vote))
    assert abs(labels.rates[1][0] - 0.8) < 0.03 and abs(labels.share - 0.8) < 0.03
    assert np.mean([labels.posterior(quality.code(list(v))) > 0.5 for v in vote[good][:2000]]) > 0.99


def test_quality_reads_whole_tokens():
    assert quality.shape("Ab1,," + "x" * 100 + "9") == "Aa0,a0"


def test_languages(docs, empty, spark):
    found = langid.with_languages(docs).collect()
    assert len(found) == len(corpus())
    lang = {r[0]: r[2] for r in corpus()}
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 60:
            assert r.lang_pred == lang[r.doc_id]
        if r.doc_id in (90, 91, 92):
            assert r.lang_pred == "und" and r.score == 0
    assert langid.with_languages(empty).collect() == []
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.with_languages(unlabelled).collect()] == ["und"]


def test_languages_never_look_at_the_label(docs):
    model = langid.train(docs)
    from pyspark.sql import functions as F

    one = langid.identify(docs, model).collect()
    two = langid.identify(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")), model).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_backoff_goes_to_shorter_grams():
    model = langid.Model([("en", "thing", 50), ("en", "things", 50), ("de", "ding", 50), ("de", "dinge", 50)])
    assert model.word("thingsy").argmax() == model.langs.index("en")
    assert model.predict("dingen dingx")[0] == "de" and model.predict("123 !!")[0] == "und"


def test_languages_counted_in_the_cluster_equal_plain_backoff(docs, monkeypatch):
    """The model against plain counts, sums and logs, with bounds that cut off words and n-grams."""
    monkeypatch.setattr(langid, "MAX_WORDS", 15)
    monkeypatch.setattr(langid, "MAX_GRAMS", 12)
    model = langid.train(docs)
    counts = {}
    for text, lang in {(text, lang) for _, text, lang, *_ in corpus()}:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(re.findall(r"[^\W\d_]+", text.lower()))
    langs = sorted(counts)

    def rows(by_lang, most, least=1):
        total = sum(by_lang.values(), Counter())
        kept = {k for c in by_lang.values() for k in sorted((k for k in c if total[k] >= least), key=lambda k: (-c[k], k))[:most]}
        mass = {x: sum(by_lang[x][k] for k in kept) for x in langs}
        logs = {k: [math.log(by_lang[x][k] + 0.5) - math.log(mass[x] + 0.5 * len(kept)) for x in langs] for k in kept}
        return {k: np.array(v) - np.mean(v) for k, v in logs.items()}

    known = rows(counts, 15, 2)
    by_n = {}
    for n in range(1, langid.MAX_N + 1):
        grams = {x: Counter() for x in langs}
        for x, c in counts.items():
            for w, k in c.items():
                for g in langid.grams(w, n):
                    grams[x][g] += k
        by_n[n] = rows(grams, 12)

    def word(w):
        if w in known:
            return known[w]
        for n in range(langid.MAX_N, 0, -1):
            found = [by_n[n][g] for g in langid.grams(w, n) if g in by_n[n]]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(langs))

    assert model.langs == langs
    for w in {w for c in counts.values() for w in c} | {"unseen", "haustx", "q", "漢"}:
        assert np.allclose(model.word(w), word(w), atol=1e-4), w


def test_packing_holds_every_id_once(docs, empty):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = lambda t: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
    rows = packing.packed(docs).collect()
    by = {}
    for r in rows:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    expected = Counter((i, len(ids(t))) for i, t, *_ in corpus())
    assert set(by) == set(expected)
    text = {(i, len(ids(t))): ids(t) for i, t, *_ in corpus()}
    for key, pieces in by.items():
        starts = Counter()
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(text[key][p.start : p.start + p.length].tobytes())
            starts.update(range(p.start, p.start + p.length))
        assert set(starts) == set(range(key[1])) and set(starts.values()) == {expected[key]}
    sequences = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert sequences.get(r.sequence_id, 0) == r.offset
        sequences[r.sequence_id] = r.offset + r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in sequences.values())
    assert packing.packed(empty).collect() == []


def test_token_ids_equal_the_other_library():
    from tokenizers import Tokenizer
    import public_tokenizers
    from lumenframe.llm.tokens import encoder

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 700), rng.randrange(0x4E00, 0x4F00), 0x1F600, 10, 9, 0xA0])) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    texts += ["it's we'll I'M", "  two  spaces\n\n x \t", "<|endoftext|> a", "x" * 3000, "\u0000́e"]
    for t in texts:
        assert encoder()(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_token_ids_of_a_file_with_merges_in_another_order(tmp_path):
    import json

    import public_tokenizers
    from lumenframe.llm.tokens import encoder
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        file = json.load(f)
    file["model"]["merges"].reverse()
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(file, f)
    own = Tokenizer.from_file(path)
    assert encoder(path)("the river thereof").tolist() == own.encode("the river thereof", add_special_tokens=False).ids != encoder()("the river thereof").tolist()


def test_packing_puts_like_documents_together():
    rng = np.random.default_rng(4)
    topics = [rng.integers(2 + 1000 * k, 1000 + 1000 * k, 300) for k in range(4)]
    docs = [rng.choice(topics[i % 4], 500).astype(np.uint16) for i in range(64)]
    same = [len({d % 4 for d, _, _ in w}) for w in packing.pack(docs)]
    assert np.mean(same) < 1.5


def test_packing_ranks_by_all_terms_and_fills_windows_with_neighbours():
    rng = np.random.default_rng(7)
    # Each document shares ten rare ids with one of another topic, and 300 common ones with its own topic.
    docs = [np.concatenate([2 + 1000 * (i % 2) + rng.permutation(300), 5000 + 10 * (i // 2) + np.arange(10)]) for i in range(40)]
    assert all(d % 2 == 0 for d in list(packing.Index(docs).neighbours(0, np.array([len(d) for d in docs])))[:19])
    # Short documents: a window holds far more than 24 of them.
    short = [2 + 1000 * (i % 2) + rng.integers(0, 300, 40) for i in range(400)]
    first = next(iter(packing.pack(short)))
    assert len(first) > 50 and all(d % 2 == 0 for d, _, _ in first)


def plain_bm25(docs, seed, k1=1.2, b=0.75):
    """Scores of all documents for a seed's terms, by the textbook."""
    bags, mean = [Counter(d.tolist()) for d in docs], sum(map(len, docs)) / len(docs)
    df = Counter(t for bag in bags for t in bag)
    idf = {t: math.log(1 + (len(docs) - n + 0.5) / (n + 0.5)) for t, n in df.items()}
    return [sum(idf[t] * bag[t] * (k1 + 1) / (bag[t] + k1 * (1 - b + b * len(d) / mean)) for t in bags[seed] if t in bag) for d, bag in zip(docs, bags, strict=True)]


@pytest.mark.parametrize("dense", [1, 8, 10**9])
def test_packing_ranks_as_plain_bm25(monkeypatch, dense):
    monkeypatch.setattr(packing, "DENSE", dense)
    monkeypatch.setattr(packing, "AHEAD", 7)
    rng = np.random.default_rng(10)
    docs = [(rng.zipf(1.3, rng.integers(1, 200)) % 400 + 2).astype(np.uint32) for _ in range(150)]
    docs[40] = docs[41] = docs[7]
    left = np.array([len(d) for d in docs])
    index = packing.Index(docs)
    for seed in range(0, 150, 3):
        left[rng.integers(0, 150, 4)] = 0
        score = plain_bm25(docs, seed)
        found = list(index.neighbours(seed, left))
        assert set(found) == {d for d, s in enumerate(score) if s > 0 and left[d] and d != seed}
        assert all(score[a] >= score[c] - 1e-4 * (1 + score[a]) for a, c in zip(found, found[1:], strict=False))


def test_packing_counts_all_documents(docs, empty):
    tokens = packing.tokenized(docs.repartition(5))
    sets = [np.frombuffer(r.ids, "<u4") for r in tokens.collect()]
    df, n, mean = packing.counted(tokens)
    assert n == len(corpus()) and abs(mean - np.mean([len(x) for x in sets])) < 1e-9
    assert (df == np.bincount(np.concatenate([np.unique(x) for x in sets]))).all()
    assert packing.counted(packing.tokenized(empty)) is None


def test_fingerprints(docs, empty):
    rows = {r.doc_id: r for r in fingerprints.fingerprints_of_edits(docs.filter("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    texts = {r[0]: r[1] or "" for r in corpus() if r[0] is not None}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        text, following = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert rows[i].n_chars == len(text) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1
        x, y = shingles(text, 5), shingles(edited, 5)
        if x and y:
            assert abs(rows[i].near_edited - len(x & y) / len(x | y)) < 0.25
        if text == edited:
            assert rows[i].near_edited == 1 and rows[i].fingerprint == rows[i].edited_fingerprint
    assert rows[90].fingerprint == rows[91].fingerprint == ""
    assert fingerprints.fingerprints_of_edits(empty).collect() == []


def test_next_row_over_many_buckets(spark):
    rng = random.Random(6)
    ids = rng.sample(range(10**9), 300) + list(range(200)) + [None]
    rows = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string")
    order = sorted((i for i in ids if i is not None), reverse=True) + [None]
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    found = fingerprints.with_next(rows, per_bucket=3).collect()
    assert {r.doc_id: r.next_doc_id for r in found} == following and len(found) == len(ids)


def plain_mix(rows):
    sizes = [(i, s, len(words(t)) if t else 0) for i, t, _, s, *_ in rows]
    sources = sorted({s for _, s, _ in sizes}, key=lambda s: (s is None, s))
    total = {s: sum(n for _, x, n in sizes if x == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    goal, open_, target = 1.5 * sum(total.values()), set(sources), {}
    while open_:
        level = goal / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * total[s] <= weight[s] * level}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            target[s] = 2.0 * total[s]
            goal -= target[s]
        open_ -= full
    return sizes, total, target


def test_mixing_meets_targets(docs, empty):
    rows = mixing.mix(docs).collect()
    sizes, total, target = plain_mix(corpus())
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, n) for i, _, n in sizes)
    for s in total:
        own = [r for r in rows if r.source == s]
        assert all(r.source_size == total[s] and abs(r.target - target[s]) < 1e-6 * (1 + target[s]) for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= 1
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert mixing.mix(empty).collect() == []


def test_mixing_over_many_buckets(docs, monkeypatch):
    once = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "PER_BUCKET", 2)
    assert sorted(map(str, mixing.mix(docs).collect())) == once


def test_mixed_documents_with_repeated_ids_meet_targets(spark):
    rows = [(1, " ".join(f"w{k}" for k in range(100)) + f" v{i}", "en", f"s{i % 3}", 0) for i in range(15)] + [(None, "one two three", "en", "s0", 0)] * 5
    sizes, total, target = plain_mix(rows)
    taken = Counter()
    for r in mixing.mixed_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")).collect():
        taken[r.source] += len(words(r.text))
    assert all(abs(taken[s] - target[s]) <= 101 for s in total)


def test_pseudo_likelihood(docs, empty, spark):
    rows = {r.doc_id: r for r in pseudo.score(docs).collect()}
    for i, t, *_ in corpus():
        assert rows[i].n_words == len(words(t))
        assert (rows[i].mean_log_prob is None) == (not words(t)) and rows[i].log_prob <= 0
    assert pseudo.score(empty).collect() == []


def test_pseudo_likelihood_learns_both_sides(spark):
    rng = random.Random(8)
    pairs = [(f"a{k}", f"b{k}") for k in range(12)]
    good = lambda: " ".join(x for _ in range(40) for x in rng.choice(pairs))
    rows = [(i, good()) for i in range(400)]
    for i in range(400, 440):
        bag = good().split()
        rng.shuffle(bag)
        rows.append((i, " ".join(bag)))
    found = {r.doc_id: r.mean_log_prob for r in pseudo.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert np.mean([found[i] for i in range(400)]) > np.mean([found[i] for i in range(400, 440)]) + 0.5


def test_pseudo_likelihood_trains_on_all_texts_of_a_large_table(spark, monkeypatch):
    rows = [(i, f"word{i % 50} next{i % 50} other") for i in range(4100)]
    weights = []
    plain = pseudo._averaged

    def averaged(copies):
        copies = pseudo.materialize(copies, "seen")
        weights.append(sum(r.weight for r in copies.select("weight").collect()))
        return plain(copies)

    monkeypatch.setattr(pseudo, "_averaged", averaged)
    pseudo.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert weights == [3 * 4100] * pseudo.ROUNDS


@pytest.mark.parametrize("near", [0, 50, 10_000])
def test_pseudo_likelihood_gives_every_word_its_own_probability(spark, monkeypatch, near):
    monkeypatch.setattr(pseudo, "VOCABULARY", 40)
    monkeypatch.setattr(pseudo, "NEAR", near)
    times = {f"word{k}": 1 + k % 3 if k >= 40 else 20 for k in range(3000)}
    rows = [(k, w) for k, (w, n) in enumerate(times.items()) for _ in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    vocabulary, network, counts = pseudo.train(docs)
    found = {r.doc_id: r.log_prob for r in pseudo.scored(docs, vocabulary, network, counts).collect()}
    # With nothing around, all words together leave only what is kept for unmet ones.
    ids, at, *_ = vocabulary.padded(["word2999"])
    unmet = sum(math.exp(network.log_classes(ids, at, np.array([c]), network.tables())[0]) / vocabulary.class_mass[c] for c in range(pseudo.ALONE + pseudo.KNOWN, len(vocabulary.class_mass)))
    assert abs(sum(math.exp(v) for v in found.values()) + unmet - 1) < 1e-3
    # In a class, words have shares by their own counts.
    kinds = {}
    for k, w in enumerate(times):
        ids, at, *_ = vocabulary.padded([w])
        if k >= 40:
            kinds.setdefault(int(vocabulary.cls[ids[at]][0]), []).append(found[k] - math.log(times[w]))
    assert all(max(v) - min(v) < 1e-3 for v in kinds.values()) and len(kinds) == pseudo.UNKNOWN


def test_stages_on_odd_and_empty_tables(docs, empty, spark):
    import corpus_pipeline
    from lumenframe.llm.common import materialize

    for table in (docs, empty):
        held = table
        for name, stage in corpus_pipeline.STAGES:
            before, held = held, materialize(stage(spark, held, ""), name)
            assert name == "packing" or held.columns == before.columns
        if table is empty:
            assert held.count() == 0
