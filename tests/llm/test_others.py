"""Chats, pages, vectors, components, the pipeline, and the queries over whole tables."""

import hashlib
import html as entities
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from lumenframe.llm import ann, chat, components, html, jaccard, langid
from lumenframe.llm.common import materialize

CONV = "conv_id long, turn long, role string, text string, window long, pos int"


def conversations():
    rng = random.Random(9)
    rows = []
    for c in range(12):
        if c % 3 == 0:
            rows.append((c, 0, "system", "Be kind <|im_end|>\n"))
        for t in range(1, rng.randint(2, 40)):
            rows.append((c, t, ("user", "assistant")[t % 2], rng.choice(["", "a\\|<|b", "<|im_start|>assistant\nx", "word " * rng.randint(1, 400), "ü🎉\\", "<<|im_end|>", "%0A%"])))
    rows += [(50, 0, None, None), (50, 1, "assistant", None), (51, 0, "a\nb%<|im_end|>", "x"), (None, 0, "user", "hi"), (None, 1, "assistant", "ho"), (52, None, "user", "first"), (52, 0, "assistant", "same"), (52, 0, "assistant", "same"), (53, 0, "assistant", "y" * 20_000)]
    return rows


def test_chats_read_back_as_they_were(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, 7, 7) for r in rows], CONV)
    found = {r.conv_id: r for r in chat.read_back(chat.windows(df)).collect()}
    windows = chat.windows(df).collect()
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        r = found[c]
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(w.formatted) for w in windows if w.conv_id == c)
    assert chat.windows(spark.createDataFrame([], CONV)).collect() == []


def test_chat_windows_keep_the_system_turn_and_the_budget(spark):
    rows = [(1, 0, "system", "Be brief.")] + [(1, t, ("user", "assistant")[t % 2], f"turn{t} " * 20) for t in range(1, 60)]
    windows = sorted(chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=300, history=80).collect(), key=lambda w: w.window)
    assert len(windows) > 5
    for k, w in enumerate(windows):
        assert w.formatted.startswith("<|im_start|>system\nBe brief.<|im_end|>\n")
        assert len(re.findall(r"[^\x20\x09-\x0D]{1,4}", w.formatted)) <= 300
        assert (w.n_repeated > 1) == (k > 0)


def test_chat_windows_fill_their_budget(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"<| w{t}") for t in range(400)] + [(2, t, "user", "long " * (200 if t == 3 else 5)) for t in range(20)]
    for w in chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=200, history=40).collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]{1,4}", w.formatted))
        own = w.formatted.count("<|im_start|>") - w.n_repeated
        assert n <= 200 or own == 1
        if w.conv_id == 1 and 0 < w.window < 20:
            assert n > 175


def page(host, i, body, label="article"):
    return (i, f"https://{host}/p{i}", f'<html><head><title>t</title></head><body><div class="top"><a href="/">Home</a> <a href="/x">News</a></div><{label}><h1>Title {i}</h1>{body}</{label}><div class="strap">The same words everywhere</div><aside>side {i}</aside></body></html>')


def test_pages(spark):
    rows = [page("a.example", i, f"<p>Body &amp; soul {i}\n  next.<p>Second{i}<ul><li>one<li>two</ul>") for i in range(12)]
    rows += [page("b.example", 100 + i, f"<p>Free text number {i}</p><p>and more {i}</p>", "section") for i in range(12)]
    rows += [(200, "https://c.example/1", None), (201, None, "<p>Lone"), (202, "https://c.example/2", ""), (203, "u", "<div class='comments'><p>nice</p></div><main><p>Kept <script>x<y</script>text</p><form>mail</form></main><footer>f</footer>"), (203, "u", "<p>" + "long " * 50_000), (None, "https://d.example", "<!-- <p>no --><p>yes</p>")]
    found = html.extracted(spark.createDataFrame([(*r, "host", "wrapper") for r in rows], "page_id long, url string, html string, host string, wrapper string").repartition(4)).collect()
    text = {}
    for r in found:
        assert r.n_chars == len(r.text)
        text.setdefault(r.page_id, []).append(r.text)
    for i in range(12):
        assert text[i] == [f"Title {i}\nBody & soul {i} next.\nSecond{i}\none\ntwo"]
        # Without an article element, the wrapper alone tells menu and strap from content.
        assert text[100 + i] == [f"Title {100 + i}\nFree text number {i}\nand more {i}"]
    assert text[200] == text[202] == [""] and text[201] == ["Lone"] and text[None] == ["yes"]
    assert sorted(text[203], key=len) == ["Kept text", ("long " * 50_000).strip()]
    assert html.extracted(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_names_of_elements():
    text = lambda body: html.main_text(f"<body class='has-sidebar'>{body}</body>")
    assert text("<div class='content with-sidebar'><p>kept</p></div><div id='leftSidebar'>side</div>") == "kept"
    assert text("<div class='site-header'>Site</div><div class='cookie-notice'>We</div><p>kept</p><div class='ad-slot'>buy</div>") == "kept"
    assert text("<header>Site</header><article><header><h1>Title</h1></header><p>kept</p><div class='newsletter-signup'>join</div></article><section id='comments'><article>nice</article></section>") == "Title\nkept"
    assert text("<p>a<table><tr><th>h<td>d</table><blockquote>q</blockquote><pre>x  y\n z</pre>") == "a\nh\nd\nq\nx y z"


def test_simple_tree_matching():
    tree = lambda s: html.parse(s)[0]
    a, b = tree("<div><p>x</p><ul><li>y</li></ul></div>"), tree("<div><h2>t</h2><p>z</p><ul><li>1</li><li>2</li></ul></div>")
    assert html.matched(a, b) == 5  # root, div, p, ul and the merged li
    assert [k.label for k in html.merge(a, b).kids[0].kids] == ["h2.", "p.", "ul."]
    assert [run for run, *_ in html.parse("&lt;b&gt; &#x41;&nbsp;B <b>c</b><br>d")[1]] == [entities.unescape("&lt;b&gt; A B c d")]


def test_wrapper_decides_with_names_as_evidence(spark):
    menu = "".join(f"<li>Entry {k}</li>" for k in range(8))
    rows = []
    for i in range(50):  # a constant list of eight entries, a notice among the paragraphs, boilerplate inside of main
        rows.append((i, "https://a.example/", f"<body><ul>{menu}</ul><div><p>Text {i}</p><p>We use biscuits</p><p>More {i}</p></div></body>"))
        rows.append((100 + i, "https://b.example/", f"<main><p>Sign here for letters</p><p>Story {i} <math><mi>x</mi></math> and <svg><text>drawn</text></svg></p></main>"))
        rows.append((200 + i, "https://c.example/", f'<div class="social-science post-tags-free"><p>Article {i}</p></div><div class="big-share-of-page"><p>Tell friends</p><p>{i}</p></div>'))
    rows += [(300, "https://d.example/", "<p title=don't>Hello</p><p>World it's ok</p><p>Third</p>"), (301, "https://d.example/", "<div class=\"a\"id='b' data-x=\"</p>\" hidden>no</div><p a=b/c>yes</p>")]
    rows += [(400 + i, "https://e.example/", "<p>Same page, four times</p>") for i in range(4)]
    found = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(50):
        assert found[i] == f"Text {i}\nMore {i}"
        assert found[100 + i] == f"Story {i} x and drawn"
        assert found[200 + i] == f"Article {i}\n{i}"
    assert found[300] == "Hello\nWorld it's ok\nThird" and found[301] == "yes"
    assert {found[400 + i] for i in range(4)} == {"Same page, four times"}


def test_pages_of_any_depth_and_width(spark):
    import time

    deep = "<div>" * 10_000 + "deep" + "</div>" * 9_000 + "<p>more"
    wide = "".join(f"<h2>a{k}</h2><p>b{k}</p>" for k in range(4_000))
    odd = "".join(f"<div class='x{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}'>c{k}</div>" for k in range(2_000))
    rows = [(1, "https://a.example/", deep), (2, "https://a.example/", deep + " tail"), (3, "https://b.example/", wide), (4, "https://b.example/", "<p>first</p>" + wide), (5, "https://c.example/", odd), (6, "https://c.example/", odd[len(odd) // 2 :] + odd[: len(odd) // 2])]
    began = time.time()
    found = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()}
    assert time.time() - began < 60
    assert found[1] == "deep\nmore" and found[2] == "deep\nmore tail" and found[3].count("\n") == 7_999 and found[4].startswith("first\na0\nb0")
    assert found[5].count("\n") == 1_999


def test_tree_matching_equals_brute_force():
    rng = random.Random(4)

    def tree(depth):
        node = html.Node(rng.choice("ab"))
        node.kids = [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else []
        return node

    def brute(a, b):
        if a.label != b.label:
            return 0
        best = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
        for i, x in enumerate(a.kids):
            for j, y in enumerate(b.kids):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute(x, y))
        return 1 + best[-1][-1]

    for _ in range(300):
        a, b = tree(3), tree(3)
        assert html.matched(a, b) == brute(a, b)


def test_nearest(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((400, 16)).round(3)
    vectors[300:] = vectors[7]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] + [1.0] * 15), (1150, [None] + [1.0] * 15), (1200, [float("inf")] + [1.0] * 15), (1250, []), (None, [1.0] * 16), (1300, [1.0, 2.0])]
    found = {}
    for r in ann.nearest(spark.createDataFrame([(*r, 0.5, 1) for r in rows], "vec_id long, embedding array<double>, score double, shard int")).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {i for i in range(0, 400, 50)}
    hit = 0
    for q, rows in found.items():
        rows.sort()
        cosine = [sum(x * y for x, y in zip(vectors[q], v, strict=True)) / math.sqrt(sum(x * x for x in vectors[q]) * sum(x * x for x in v)) for v in vectors]
        best = sorted((-round(c, 12), i) for i, c in enumerate(cosine) if i != q)[:5]
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5]
        assert all(abs(s - cosine[i]) < 1e-12 for _, i, s in rows)
        hit += len({i for _, i, _ in rows} & {i for _, i in best})
    assert hit >= 38
    assert [i for _, i, _ in found[300]] == [7, 301, 302, 303, 304]
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_nearest_with_huge_and_tiny_components(spark):
    rows = [(0, [1e200, 2e200]), (1, [1.0, 2.0]), (2, [1e-200, 3e-200]), (3, [-5e-324, 0.0]), (4, [1e308, -1e308]), (50, [2.0, 4.0])]
    found = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    small = {0: (1, 2), 1: (1, 2), 2: (1, 3), 3: (-1, 0), 4: (1, -1), 50: (1, 2)}
    cosine = lambda a, b: (a[0] * b[0] + a[1] * b[1]) / math.sqrt((a[0] ** 2 + a[1] ** 2) * (b[0] ** 2 + b[1] ** 2))
    for q in (0, 50):
        expected = sorted((-round(cosine(small[q], v), 9), i) for i, v in small.items() if i != q)
        assert [(-round(s, 9), i) for _, i, s in sorted(found[q])] == expected


def test_nearest_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 60)
    monkeypatch.setattr(ann, "BLOCK", 3)
    vectors = np.random.default_rng(2).standard_normal((500, 8))
    found = ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 500, 50):
        order = [i for i in np.argsort(-(unit @ unit[q])) if i != q][:5]
        hit += len(set(order) & {r.vec_id for r in found if r.query_id == q})
    assert len(found) == 50 and hit >= 48


def test_components_over_many_partitions(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(1000 + i, 1001 + i) for i in range(40)]
    rng.shuffle(links)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        found = {r.node: r.component for r in components.connected_components(materialize(spark.createDataFrame(links, "a long, b long").repartition(6), "links")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    up = {x: x for pair in links for x in pair}
    root = lambda x: x if up[x] == x else root(up[x])
    for a, b in links:
        up[max(root(a), root(b))] = min(root(a), root(b))
    assert found == {x: root(x) for x in up}


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], "/root/testdata/sf0.001"), name))
    return out


def test_pipeline_stages_by_plain_versions(spark, stages):
    from collections import Counter

    from test_documents import brute_components, plain_mix, words

    rows = [[tuple(r) for r in s.collect()] for s in stages]
    raw, languages, good, single, mixed, packed = rows
    assert all(s.columns == stages[0].columns for s in stages[1:5])
    assert set(languages) <= set(raw) and set(good) <= set(languages) and set(single) <= set(good)
    labels = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    assert sum(labels[r[0]].quality for r in raw if r[0] in labels) - sum(labels[r[0]].quality for r in good if r[0] in labels) <= 1
    assert sum(1 for r in good if r[0] in labels and not labels[r[0]].quality) <= 1
    assert {r[0] for r in single} == {c for _, _, c in brute_components(good, 5, 80)}
    sizes, total, target = plain_mix([(i, t, lang, s, n) for i, t, lang, s, n in single])
    taken = Counter()
    for i, t, _, s, _ in mixed:
        taken[s] += len(words(t))
    longest = max(n for _, _, n in sizes)
    assert all(abs(taken[s] - target[s]) <= longest for s in total)
    tokens = Counter()
    for doc, start, length, _, doc_tokens, _, _ in packed:
        tokens[doc, doc_tokens] += length
    times = Counter(r[0] for r in mixed)
    assert all(n == size * times[doc] for (doc, size), n in tokens.items()) and {d for d, _ in tokens} == set(times)


def test_queries_are_registered_for_every_operator():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_texts_that_share_a_passage_seldom_meet(spark):
    """A passage that many texts hold makes no list; near copies still meet."""
    rng = random.Random(3)
    passage = " ".join(f"common{i}" for i in range(60))
    rows = []
    for i in range(300):
        own = [f"w{rng.randrange(10**7)}" for _ in range(200)]
        at = rng.randrange(200)
        rows.append((i, " ".join(own[:at]) + " " + passage + " " + " ".join(own[at:])))
        if i % 10 == 0:
            rows.append((1000 + i, rows[-1][1] + " end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    common = jaccard.common_items(docs, 5, 80, 80_000)
    assert 15 < (common[1] > 100).sum() <= 56
    met = jaccard._candidates(docs, 80_000, 5, 80, common).collect()
    assert {(i, 1000 + i) for i in range(0, 300, 10)} <= {(min(r.a, r.b), max(r.a, r.b)) for r in met} and len(met) < 60
    assert {r.doc_id: r.component_id for r in jaccard.components(docs, 5, 80, rare=True).collect()} == {i: i - 1000 if i >= 1000 else i for i, _ in rows}
    assert [len(x) for x in jaccard.common_items(docs.limit(0), 5, 80, 0)] == [0, 0]


def test_local_links_are_spread(spark, monkeypatch):
    """Very many links of one partition go to many groups."""
    monkeypatch.setattr(jaccard, "LISTED", 1000)
    docs = spark.createDataFrame([(i, f"a{i // 2} b{i // 2} c{i // 2}") for i in range(4000)], "doc_id long, text string").coalesce(1)
    groups = Counter()

    def held(df, *_):
        groups.update(r.bucket for r in df.filter("bucket < 0").select("bucket").collect())
        return df

    monkeypatch.setattr(type(docs), "groupBy", lambda self, *c, own=type(docs).groupBy: own(held(self) if c == ("bucket",) else self, *c))
    assert len({(r.a, r.b) for r in jaccard._candidates(docs, 16_000, 3, 90).collect()}) == 2000
    assert len(groups) >= 8


def test_languages_of_texts_without_letters_and_of_one_id(spark):
    kinds = {"en": "the of and river stone light".split(), "de": "der die und fluss stein licht".split()}
    rng = random.Random(1)
    rows = [(7, " ".join(rng.choice(kinds[lang]) for _ in range(12)), lang) for lang in ("en", "de") for _ in range(4000)]
    for ids in ([7], [None], [8], list(range(50))):
        docs = spark.createDataFrame([(ids[i % len(ids)], t, lang) for i, (_, t, lang) in enumerate(rows)], "doc_id long, text string, lang string").repartition(4)
        model = langid.train(docs, per_lang=300)
        assert [model.predict(t)[0] for t in ("the river and", "der fluss und")] == ["en", "de"]
        counts = model.words["the"], model.words["der"]
        assert len(set(counts)) == 2 and len(model.words) == 12
    for text in ("½ ² Ⅷ", "12 345 _ !", "٣ ¼", "", None):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("ʰx")[0] in ("en", "de")
    # Copies of a text train once.
    again = spark.createDataFrame([(i, "the river", "en") for i in range(3000)] + [(i, "der fluss", "de") for i in range(3000)], "doc_id long, text string, lang string")
    assert langid.train(again, per_lang=10_000).words == {}


def test_ids_equal_the_files_own_library_for_special_strings():
    import public_tokenizers
    from lumenframe.llm.tokens import encoder
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|", "<|endoftext|> \n", "é<|endoftext|>é"):
        assert encoder()(text).tolist() == own.encode(text, add_special_tokens=False).ids
    assert 50256 in encoder()("a <|endoftext|> b").tolist()


def test_names_alone_decide_nothing_that_varies(spark):
    """Parts with ambiguous names stay while their texts vary, and constant sentences of articles go; passages and near copies stay."""
    rows = []
    for i in range(40):
        rows.append((i, "https://a.example/", f'<nav><a href="/">Home</a></nav><div class="print-content"><p>Body {i} of print</p></div><footer>f</footer>'))
        rows.append((100 + i, "https://b.example/", f'<article><h1>T{i}</h1><p class="teaser">Lead {i}</p><p>Story {i}</p><p>Sign up for our letters today</p><p>End {i}</p></article>'))
        rows.append((200 + i, "https://c.example/", f'<main><h1>Poll {i}</h1><div class="responses"><p>Answer {i}</p></div><div class="tags"><p>On {i}</p></div></main>'))
        shared = "<p>A passage that some articles share word for word</p>" if i % 3 == 0 else ""
        rows.append((300 + i, "https://d.example/", f"<article><p>One {i}</p>{shared}<p>Two {i}</p></article>"))
        # Near copies: all but one paragraph is the same on every page.
        rows.append((400 + i, "https://e.example/", f"<article><p>First part</p><p>Second part</p><p>Third part {i}</p><p>Fourth part</p><p>Last part</p></article>"))
    found = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(40):
        assert found[i] == f"Body {i} of print"
        assert found[100 + i] == f"T{i}\nLead {i}\nStory {i}\nEnd {i}"
        assert found[200 + i] == f"Poll {i}\nAnswer {i}\nOn {i}"
        assert found[300 + i] == f"One {i}\n" + ("A passage that some articles share word for word\n" if i % 3 == 0 else "") + f"Two {i}"
        assert found[400 + i].startswith("First part\n") and found[400 + i].endswith("Last part")
