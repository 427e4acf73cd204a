"""Repair of conversations, pieces with spans, and spelling variants: against plain versions, and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from pathlib import Path

import duckdb
import pytest
from lumenframe.llm import pieces, queries, repair, variants

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string, lost boolean, fault string, at long, same string"


def conversations():
    rng = random.Random(11)
    said = ["Fine.", "Fine.", "well", "Is it?", "", " \t\n", "Yes! \n", "no stop", "ü🎉."]
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t + 2 * (t > 4), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "u2"]), rng.choice(said)))
    rows += [(70, None, None, None), (70, None, "user", "a."), (70, 3, "assistant", "b."), (71, None, "user", "x."), (None, 0, "user", "hi."), (None, 1, "assistant", "ho."), (72, 5, "user", "same."), (72, 5, "user", "same."), (72, 5, "user", "same.")]
    rows += [(73, t, ("user", "assistant")[t % 2], "word " * 20_000 + f"{t}.") for t in range(4)] + [(74, t, "user", "again.") for t in range(300)]
    return rows


@lru_cache(maxsize=None)
def best(rows, i, state, inserts):
    """The least (cost, letters) from row i: every list of edits is tried."""
    options = [(0, "")] if i == len(rows) and state in (0, 3) else []
    then = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    if inserts < 3:
        cost, letters = best(rows, i, then, inserts + 1)
        options.append((cost + 2, "I" + letters))
    if i < len(rows):
        role, fault = rows[i]
        cost, letters = best(rows, i + 1, state, 0)
        options.append((cost + 3, "D" + letters))
        if fault not in ("blank", "duplicate"):
            late = fault == "truncated"
            cost, letters = best(rows, i + 1, then, 0)
            options.append((cost + 2 + late, "R" + letters))
            kept = 1 if role[:1] == "s" and state == 0 else 2 if role[:1] == "u" and state != 2 else 3 if role[:1] == "a" and state == 2 else None
            if kept:
                cost, letters = best(rows, i + 1, kept, 0)
                options.append((cost + late, "K" + letters))
    return min(options, default=(10**9, ""))


def plain_report(rows):
    """One conversation's (gaps, blank, duplicate, truncated, illegal, cost, audit, digest), from (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        cut = text.rstrip(" \t\n\x0b\f\r")
        faults.append("blank" if not cut else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = {t for t, *_ in rows if t is not None}
    initials = [role[:1] for _, role, _ in rows]
    cost, audit = best(tuple((role, f) for (_, role, _), f in zip(rows, faults, strict=True)), 0, 0, 0)
    left, out, state = list(rows), [], 0
    for edit in audit:
        give = "assistant" if state == 2 else "user"
        role, text = (give, "") if edit == "I" else left.pop(0)[1:]
        if edit == "D":
            continue
        role = give if edit == "R" else role
        state = {"s": 1, "u": 2, "a": 3}[role[0]]
        out.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    counts = Counter(faults)
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def test_repair_equals_all_lists_of_edits(spark):
    source = conversations()
    found = {r.conv_id: r for r in repair.report(repair.edits(repair.damaged(spark.createDataFrame([(*r, True, "x", 1, "x") for r in source], CONV).repartition(3)))).collect()}
    by = defaultdict(list)
    for c, t, role, text in source:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        rows = {0: 0, 3: 2}.get(kind, 1)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        by[c] += [(t, "user" if kind == 4 else role, text)] * rows
    assert set(found) == set(by)
    for c, rows in by.items():
        if c == 74:
            continue  # too long for the plain version
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        assert tuple(found[c])[1:] == plain_report(rows), (c, rows)
    assert found[74].duplicate + found[74].blank == found[74].audit.count("D") == len(by[74]) - 2


def test_repair_gives_the_turns(spark):
    rows = [(1, 0, "assistant", "Well.", False), (1, 1, "assistant", "Really?", False), (2, 0, "system", "Be.", True), (3, 0, "user", "One.", False), (3, 1, "user", "One.", False), (3, 2, "assistant", "Two.", False)]
    edited = repair.edits(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, lost boolean"))
    turns = [tuple(r)[2:] for r in repair.repaired(edited).orderBy("conv_id", "at").collect()]
    assert turns == [("user", "Well."), ("assistant", "Really?"), ("user", "One."), ("assistant", "Two.")]
    assert sorted((r.conv_id, r.audit, r.cost) for r in repair.report(edited).collect()) == [("1", "RK", 2), ("2", "", 0), ("3", "KDK", 3)]
    assert repair.report(repair.edits(repair.damaged(spark.createDataFrame([], CONV)))).collect() == []


def test_one_long_conversation_among_short_ones(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.", False) for t in range(30_000)] + [(c, t, "user", f"{t}.", False) for c in range(2, 40) for t in range(3)]
    found = {r.conv_id: r for r in repair.report(repair.edits(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, lost boolean").repartition(5))).collect()}
    assert found[1].audit == "K" * 30_000 and found[1].cost == 0 and {found[c].audit for c in range(2, 40)} == {repair.cheapest([("user", None)] * 3)[1]}


DOCS = "doc_id long, text string, word string, n long, root string, group string, ids string, key string"


def texts():
    rng = random.Random(2)
    odd = ["a", "the", " ", "  ", "\n", "é", "▁", "🎉", "中文", "ing", "<s>", "<0x0A>", "\t", "\x00", "2024", ".", "�", "𐍈", "Straße"]
    rows = [(i, "".join(rng.choice(odd) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    return [*rows, (None, "no id"), (300, None), (301, ""), (301, ""), (302, "x" * 40_000), (303, "word " * 60_000), (304, "    "), (305, "▁▁")]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def test_pieces_equal_the_library(spark, library):
    docs = spark.createDataFrame([(*r, "w", 1, "r", "g", "i", "k") for r in texts()], DOCS).repartition(3)
    found = pieces.encoded(docs)
    rows = found.collect()
    said = Counter((r.doc_id, r.text) for r in pieces.decoded(found).collect())
    assert said == Counter((i, library.decode(library.encode(t or ""))) for i, t in texts())
    by = defaultdict(list)
    for i, t in texts():
        by[i].append(t or "")
    assert len(rows) == len(texts())
    for r in rows:
        text = by[r.doc_id][0]
        whole = library.encode(text, return_type="proto")
        assert (r.ids, r.begins, r.ends) == ([p.id for p in whole.pieces], [p.begin for p in whole.pieces], [p.end for p in whole.pieces])
    for r in pieces.digests(docs).collect():
        ids = library.encode(by[r.doc_id][0])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert r.n_bytes == len(by[r.doc_id][0].encode())
    assert pieces.digests(docs.limit(0)).collect() == pieces.encoded(docs.limit(0)).collect() == []


def test_decoding_of_any_ids(library):
    import public_tokenizers

    own, rng = pieces.Model(public_tokenizers.path(pieces.MODEL)), random.Random(8)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(260), 259, 28705]) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf"])
def test_normalisation_by_a_character_map(rule):
    """The installed model's map is empty; the library's own maps show the longest prefixes and the alignment."""
    import public_tokenizers
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(theirs.serialized_model_proto())
    own = pieces.Model(public_tokenizers.path(pieces.MODEL))
    own.map, own.trim = pieces.CharMap(proto.normalizer_spec.precompiled_charsmap), True
    rng = random.Random(1)
    odd = ["ﬁ", "①", "ｱｲｳ", "㌀", "¨", "x", "ｶﾞ", "é", "　", "  ", "Ⅷ", "ß", "A", "\t", "中"]
    for _ in range(400):
        text = "".join(rng.choice(odd) for _ in range(rng.randint(0, 25)))
        said, align = own.normalise(text)
        assert said == theirs.normalize(text)
        data = text.encode()
        assert len(align) == len(said.encode()) + 1 and (align[1:] >= align[:-1]).all() and align[-1] <= len(data)
        for place in align:
            data[:place].decode()  # every place is between two characters


def near(a, b):
    """Whether one insertion, deletion or replacement makes b of a."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def families():
    rng = random.Random(6)
    rows = []
    for f in range(12):
        base = "".join(rng.choice("abcdé") for _ in range(rng.randint(7, 11)))
        rows += [(1000 * f + k, " ".join([base] * 60 + [w for w in (base[: k % 7] + rng.choice("abx") + base[k % 7 + 1 :], base[: k % 8] + "aa" + base[k % 8 :], base[:-1]) for _ in range(k % 5)])) for k in range(25)]
    rows += [(1, "aaaaaaa aaaaaaaa AAAAAAAAA aaaaaab, aaaaaab"), (2, "aaaaaaa aaaaaaaa aaaaaaaaa ÀÉÿßöäü ÀÉÿßöäü àÉÿßöäü àÉÿßöäü"), (3, None), (None, "nameless nameless"), (4, ""), (5, "short words only"), (6, "b" * 5000), (6, "b" * 5000), (7, "0aaaaaaa9aaaaaaa_aaaaaaa")]
    rng.shuffle(rows)
    return rows


def plain_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    out = {}
    for w in n:
        found = sorted((x for x in n if near(w, x)), key=lambda x: (-n[x], x))
        form = found[0] if found and n[found[0]] >= 10 * n[w] else None
        out[w] = [form, w, n[w], len(found), n[form] if form else None]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: tuple(r) for w, r in out.items()}


@pytest.mark.parametrize("hot", [2, 12, variants.HOT])
def test_variants_equal_all_pairs(spark, hot):
    rows = families()
    docs = spark.createDataFrame([(*r, "w", 1, "r", "g", "i", "k") for r in rows], DOCS).repartition(4)
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.grouped(docs, hot=hot).collect()}
    assert found == plain_variants(rows)
    assert any(f for f, *_ in found.values()) and variants.grouped(docs.limit(0)).collect() == []


def test_active_nodes_of_a_trie():
    rng = random.Random(3)
    for _ in range(30):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(60)})
        assert sorted(variants.Trie(words).pairs()) == sorted((i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b))


def test_chains_of_forms_end_in_roots(spark):
    """Each form is ten times as frequent, and one edit away from the next."""
    words = [("aaaaaaa", 2), ("aaaaaab", 20), ("aaaaabb", 200), ("aaaabbb", 2000), ("aaabbbb", 20_000)]
    docs = spark.createDataFrame([(i, w) for w, n in words for i in range(n)], "doc_id long, text string").repartition(4)
    rows = {r.word: r for r in variants.grouped(docs).collect()}
    known = plain_variants([(i, w) for w, n in words for i in range(n)])
    assert {w: (r.form, r.root, r.n, r.n_near, r.form_n) for w, r in rows.items()} == known


@pytest.mark.parametrize("name", ["op11_repair_conversations", "op13_group_variants"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    result = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = sorted(map(str, result.fetchall()))
    assert sorted(str(tuple(r[c] for c in columns)) for r in queries.queries()[name](spark, SF).collect()) == expected


def test_query_of_pieces_equals_the_library(spark, library):
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.queries()["op12_encode_pieces"](spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = library.encode(text[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.n_bytes) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), len(text[r.doc_id].encode()))
