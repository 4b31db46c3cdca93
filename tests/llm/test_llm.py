"""Operators for training data: brute force, exact round trips and edge cases."""

import itertools
import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oracle import compare, connection
from pagewright.llm import canonical_values as V
from pagewright.llm import format_copies as D
from pagewright.llm import packing as B
from pagewright.llm import page_spam as W
from pagewright.llm import registry
from pagewright.llm import repeated_lines as L
from pagewright.llm import splitting as S
from pagewright.llm import tokens as K
from pagewright.llm import visual_form as N
from pagewright.llm.visual_queries import same_looking_pairs

SQL = {k: (m.QUERIES[k], s) for m in registry.MODULES for k, s in m.SQL.items()}


@pytest.mark.parametrize("name", list(SQL))
def test_matches_statement(spark, sf, name):
    compare(spark, *SQL[name], sf, connection(sf))


# 2


def test_copies_of_records(spark):
    rows = [
        (1, '{"text":"Straße 5!","k":["A b","c"],"n":1}'), (2, ' {"n":1.0, "k":["ab","C."], "text":"STRASSE 5"} '), (3, '{"text":"Strasse 6","k":["A b","c"],"n":1}'),
        (4, '{"text":"Straße 5!","k":["A","bc"],"n":1}'), (5, ""), (6, None), (7, '{"text":"x'), (8, "[1]"), (9, '{"a":1} tail'), (10, '{"a":1}{"a":1}'), (11, '{"a":1}'),
        (11, '{"a":1}'), (None, '{"a":1}'), (12, '{ "a" : 1 }'), (13, '{"t":"caf\u00e9"}'), (14, '{"t":"cafe\u0301"}'), (15, '{"t":"Cafe"}'),
    ]
    d = spark.createDataFrame(rows, "line_id long, raw string")
    for floor in (2, 10_000):  # hot and cold paths
        groups, copies = D.collapse(D.keyed_lines(d, "line_id", "raw"), floor=floor, salts=3)
        assert sorted(map(tuple, copies.collect())) == [(1, 2), (11, 12), (14, 15)]  # a mark is no letter
        assert sorted(map(tuple, groups.collect())) == [(1, 2), (3, 1), (4, 1), (11, 2), (13, 1), (14, 2)]
    groups, copies = D.collapse(D.keyed_lines(d.limit(0), "line_id", "raw"))
    assert groups.count() == copies.count() == 0


# 3


@pytest.mark.parametrize("floor", [2, 10_000])
def test_repeated_lines_against_brute_force(spark, floor):
    rng = random.Random(5)
    texts = ["a b", "A-B!", "c", "", "12", "d d", "é", "É"]
    rows = [(i, rng.choice(["s", "t", None]), rng.choice([None, "\n".join(rng.choice(texts) for _ in range(rng.randint(0, 5)))])) for i in range(60)]
    rows += rows[:5]
    d = spark.createDataFrame(rows, "chunk_id int, source_file string, text string")
    want, seen = set(), {}
    key = lambda x: re.sub(r"[\W\d_]+", "", "".join(c for c in x if not unicodedata.combining(c))).lower()
    for i, s, t in rows:
        for n, line in enumerate((t or "").split("\n") if t is not None and s else [], 1):
            if key(line):
                seen.setdefault((s, key(line)), set()).add(i)
                want.add((i, n, s, key(line)))
    want = {(i, n) for i, n, s, k in want if len(seen[s, k]) >= 4}
    occ, _ = L.frequent_sequences(d, min_docs=4, floor=floor)
    assert {(r.id, r.line_no) for r in occ.collect()} == want
    own = {r.chunk_id: r.own_text for r in L.strip_repeated(d, occ).collect()}
    for i, _, t in rows:
        assert own[i] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (i, n) not in want))


def test_sequences_of_any_length(spark):
    """All sequences of consecutive frequent lines, planted ones of seven lines and repeated lines included, with the
    longest that begins at each line."""
    rng = random.Random(2)
    notice = [f"notice {w}" for w in ("one", "two", "three", "four", "five", "six", "seven")]
    rows = []
    for i in range(40):
        own = [f"own {chr(97 + i % 26)} {chr(97 + rng.randrange(26))}" for _ in range(3)]
        body = rng.choice([notice, notice[:4], notice[2:], notice[::-1], ["notice one"] * 3, []])
        # own lines may stand between repeated ones
        body = [x for y in body for x in ([y, rng.choice(own)] if rng.random() < 0.3 else [y])]
        rows.append((i, f"s{i % 2}", "\n".join([own[0], *body, own[1], "", *body[:2]])))
    d = spark.createDataFrame([*rows, rows[0], (99, None, "x")], "chunk_id int, source_file string, text string")
    key = lambda x: re.sub(r"\W", "", x)
    docs_of = {}
    for i, s, t in rows:
        for line in t.split("\n"):
            if key(line):
                docs_of.setdefault((s, key(line)), set()).add(i)
    seqs, kept = {}, {}
    for i, s, t in rows:
        kept[i] = [(n, key(x)) for n, x in enumerate(t.split("\n"), 1) if key(x) and len(docs_of[s, key(x)]) >= 4]
        for a in range(len(kept[i])):
            for b in range(a + 1, len(kept[i]) + 1):
                seqs.setdefault((s, tuple(k for _, k in kept[i][a:b])), set()).add(i)
    frequent = {q: ids for q, ids in seqs.items() if len(ids) >= 4}
    assert max(len(q) for _, q in frequent) >= 7
    occ, seq = L.frequent_sequences(d, min_docs=4)
    assert sorted((r.length, r.docs) for r in seq.collect()) == sorted((len(q), len(ids)) for (_, q), ids in frequent.items())
    want = set()
    for i, s, _ in rows:
        for a, (n, _) in enumerate(kept[i]):
            want.add((i, n, max(b - a for b in range(a + 1, len(kept[i]) + 1) if (s, tuple(k for _, k in kept[i][a:b])) in frequent)))
    assert {(r.id, r.line_no, r.length) for r in occ.collect()} == want
    occ, seq = L.frequent_sequences(d.limit(0))
    assert occ.count() == seq.count() == 0


# 4


def test_pieces_join_and_hold_the_limit(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["alpha", "beta,", "gamma.", "delta\n", "e\n\nf", "ñandú;", "保険", "x" * 50])
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 400)))) for i in range(30)] + [(99, None), (100, ""), (101, "x" * 10_000), (None, "a")]
    rows += [rows[0]]
    d = spark.createDataFrame(rows, "chunk_id long, text string")
    got = {}
    for r in S.split_oversized(d, limit=100, overlap=20).orderBy("chunk_id", "piece_no").collect():
        got.setdefault(r.chunk_id, []).append(r)
    texts = dict(rows)
    assert set(got) == {i for i, t in texts.items() if i is not None and t is not None}
    for i, ps in got.items():
        t = texts[i]
        assert "".join(t[p.own_start : p.end] for p in ps) == t
        for k, p in enumerate(ps):
            assert p.size <= 100 and p.piece == t[p.start : p.end] and p.piece_no == k and p.n_pieces == len(ps)
            if k:
                assert int(len(S._UNIT.findall(t[p.start : p.own_start])) * 1.3) + 1 <= 20
    with pytest.raises(ValueError):
        S.split_oversized(d, limit=50, overlap=50)


def test_cuts_stand_at_the_strongest_boundary_near():
    text = " ".join(f"w{i}" for i in range(60)) + "\n\n" + " ".join(f"v{i}" for i in range(50))
    (_, _, end), *_ = S.split_text(text, limit=100, overlap=0)
    assert text[:end].endswith("w59\n\n")


# 5


def test_values_are_mapped():
    m = V.Matcher([(1, "eligibility"), (1, "who can join"), (2, "dental_care"), (2, "Dental Care"), (3, "appeals"), (4, "disability income"), (4, "handling of personal files")])
    best = lambda v: (m.match([v])[0] or [(0, 0)])[0][0]
    for v, e in (
        ("b) Eltgibility", 1), ("join, can, who", 1), ("\nDENTAL__CARE (cont.)", 2), ("Appea.", 3), ("apepals", 3), ("HANDL. OF PERSO FILES", 4), ("IV - disability-income pt 1", 4),
        ("song lyrics", 0), ("xx-xx", 0), ("page 94", 0), ("", 0), ("é" * 500, 0), ("12", 0),
    ):
        assert best(v) == e, v


@pytest.mark.parametrize("letters, size", [("abc", 7), ("мос", 7), ("東京都", 7), ("abcdefgh", 100), ("мосąе", 140)])
def test_automaton_equals_edit_distance(letters, size):
    def osa(a, b):
        d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1]

    def with_cuts(q, name):
        """A name may be cut at its end, to half of its letters and three, for one error."""
        least, row = max(3, -(-len(name) // 2)), osa(q, name)
        return min([row[-1], *(x + 1 for x in row[least:-1])])

    rng = random.Random(3)
    names = list({"".join(rng.choice(letters) for _ in range(rng.randint(3, size))) for _ in range(12)})
    m = V.Matcher(list(enumerate(names)))
    names = ["".join(V.words_of(n)) for n in names]

    def typed():
        if rng.random() < 0.3 or size > 20:
            q = list(rng.choice(names))
            for _ in range(rng.randint(0, 6)):
                q[rng.randrange(len(q))] = rng.choice(["", "x", *letters])
            return "".join(q)[: rng.choice([size, 999])]
        return "".join(rng.choice([*letters, "d"]) for _ in range(rng.randint(1, size + 1)))

    qs = [typed() for _ in range(300 if size < 20 else 60)]
    hits = 0
    for q, got in zip(qs, m.search(qs), strict=True):
        want = {i: e for i, n in enumerate(names) if (e := with_cuts(q, n)) <= V.allowed(max(len(q), len(n))) and e <= V.allowed(len(q) + 2)}
        assert got == (want if q else {}), q
        hits += len(want)
    assert hits > 20


def test_values_of_any_script_and_length():
    names = [(1, "Москва"), (2, "東京都庁"), (3, "हिन्दी भाषा"), (4, "x" * 70), (5, "Łódź"), (6, "القاهرة")]
    m = V.Matcher(names)
    for entry, name in names:
        assert m.match([name])[0] == [(entry, 0)]
    assert m.match(["Моска", "МОСКВА (cont.)", "東都庁", "भाषा हिन्दी", "x" * 68, "हिनदी भाषा", "Лондон"]) == [[(1, 1)], [(1, 0)], [(2, 1)], [(3, 0)], [(4, 1)], [(3, 1)], []]


def test_long_reference_lists_are_searched_in_blocks(spark):
    entries = spark.createDataFrame([(i, f"name {chr(97 + i)}{chr(98 + i)}{chr(99 + i)}xyz", None) for i in range(20)] + [(None, "lost", [])], "id int, n string, o array<string>")
    d = spark.createDataFrame([(1, "name abcxyz"), (2, "NAME bcdxy"), (3, None), (4, "unknown"), (5, "name abcxyz")], "k int, v string")
    whole = V.map_to_list(d, "v", entries, "id", ["n"], ["o"], ["k"])
    parts = V.map_to_list(d, "v", entries, "id", ["n"], ["o"], ["k"], size=6)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    assert {r.k: len(r.matches) > 0 for r in parts.collect()} == {1: True, 2: True, 3: False, 4: False, 5: True}
    assert all(r.matches == [] for r in V.map_to_list(d, "v", entries.limit(0), "id", ["n"], ["o"], ["k"]).collect())


def test_longer_values_match_in_every_order():
    names = [(8, "second look at a denial"), (38, "gym and coaching rewards"), (27, "keeping cover after leaving"), (5, "payouts")]
    m = V.Matcher(names)
    for v, got in (
        ("xook, second, at, a, denial", [(8, 1)]), ("and, coachin,g rewards, gym", [(38, 0)]), ("a, xook, denial, at, secnod", [(8, 2)]),
        ("gym, and, xoaching, re wards", [(38, 1)]), ("one, two, three, four, five", []), ("z " * 30, []),
    ):
        assert m.match([v])[0] == got, v


def test_long_names_and_values_match():
    long = "deputy associate director of interdepartmental infrastructure administration and procurement"
    m = V.Matcher([(1, long), (2, "payouts"), (3, "a" * 29 + " " + "b" * 30)])
    for v, got in (
        (long, [(1, 0)]), (long.replace("director", "dixector"), [(1, 1)]), (", ".join(long.split()[::-1]), [(1, 0)]), (long.replace("administration", "admin"), [(1, 3)]),
        (long.replace("administration", "administ"), [(1, 1)]), ("b" * 32 + " " + "a" * 29, [(3, 2)]), ("a" * 29 + "b" * 32, [(3, 2)]), ("payout", [(2, 1)]),
    ):
        assert m.match([v])[0] == got, v


def test_alignment_equals_the_best_order():
    rng = random.Random(5)
    names = ["abc bca cabba", "aabb cc bab"]
    m = V.Matcher(list(enumerate(names)))
    for _ in range(150):
        words = rng.choice(names).split()
        rng.shuffle(words)
        text = list(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice("abcd ")
        words = "".join(text).split()
        best = {}
        for found in m.search(["".join(p) for p in set(itertools.permutations(words))]):
            for k, e in found.items():
                best[k] = min(e, best.get(k, 99))
        assert m.align(words) == best, words


# 6


def test_normal_form():
    pairs = [("Ｐａｙ　５", "Pay 5"), ("a b c", "a b c"), ("résumé", "résumé"), ("Со​st", "Cost"), ("x\r\ny\rz", "x\ny\nz"), ("ﬁne", "fine"), ("ậ", "ậ"), ("", "")]
    got = N.normalize_array(pa.array([a for a, _ in pairs] + [None])).to_pylist()
    assert got == [b for _, b in pairs] + [None]
    for a, b in (("Pay", "pay"), ("x²", "x2"), ("resume", "résumé"), ("½", "1/2"), ("O", "0"), ("l", "I")):
        x, y = N.normalize_array(pa.array([a, b])).to_pylist()
        assert x != y


def test_composition_equals_the_standard():
    rng = random.Random(2)
    al = ["a", "e", "o", "́", "̈", "̣", "̧", "é", "ậ", "한", "ᄒ", "ᅡ", "ᆫ", "が", "か", "゙", "x"]
    rows = ["x" + "".join(rng.choice(al) for _ in range(rng.randint(0, 9))) for _ in range(20_000)]
    a = N.normalize_array(pa.array(rows))
    assert a.to_pylist() == [unicodedata.normalize("NFC", r) for r in rows]
    assert N.normalize_array(a).equals(a)
    assert N.normalize_array(pa.array(rows).slice(7, 100)).to_pylist() == a.to_pylist()[7:107]


def test_same_looking_pairs(spark):
    rows = [("t", 1, "d", "Pay"), ("t", 2, "d", "Ｐay"), ("t", 3, "d", "Pay"), ("t", 2, "d", "Ｐay"), ("t", 4, "e", "P​ay"), ("t", 5, "d", "pay"), ("t", 6, "d", " "), ("t", 7, "d", " "), ("t", 8, "d", None), ("c", 9, "d", "P­ay"), ("c", 10, "d", "ᏢᎪᎩ x"), ("c", 11, "d", "PᎪᎩ x"), ("c", 11, "d", "ᏢAᎩ x")]
    d = spark.createDataFrame(rows, "rec_kind string, id long, scope string, text string")
    assert sorted(map(tuple, same_looking_pairs(d).collect())) == [("c", 10, 11), ("t", 1, 2), ("t", 2, 3)]
    many = spark.createDataFrame([("t", i, "d", "Pay" if i % 3 else "Ｐay") for i in range(60)], d.schema)
    assert {tuple(r)[1:] for r in same_looking_pairs(many, floor=10).collect()} == {(a, b) for a in range(60) for b in range(a + 1, 60) if (a % 3 == 0) != (b % 3 == 0)}
    assert same_looking_pairs(d.limit(0)).count() == 0


# 7


def test_ids_equal_the_library(spark):
    enc = K.load(f"{K.DEFAULT_DIR}/byte_bpe_50k.tiktoken")
    texts = ["", None, "Hello  world\n\n x", "it's <|endoftext|>", "é保́", " " * 30_000 + "a1b2!" * 20_000 + "\n" * 9_000, "x" * 30_000, "a" * 30_000 + " " * 40_000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for i, ids in K.encode_corpus(d).collect():
        t = texts[i] or ""
        assert enc.decode(ids) == t
        if len(t) < 100:
            assert ids == enc.encode_ordinary(t)
    assert {r.doc_id: r.text for r in K.decode_corpus(K.encode_corpus(d)).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_segments_keep_the_ids():
    enc = K.load(f"{K.DEFAULT_DIR}/byte_bpe_50k.tiktoken")
    rng = random.Random(1)
    al = ["a", "Z", "9", " ", "  ", "\n", "'", "s", "ll", ".", "-", "é", "保", " ", "\t", "'s"]
    for _ in range(2000):
        t = "".join(rng.choice(al) for _ in range(rng.randint(0, 60)))
        ids = []
        for part, whole in K.segments(t, rng.choice([1, 3, 7])):
            ids += list(enc._core_bpe.encode_single_piece(part.encode())) if whole else enc.encode_ordinary(part)
        assert ids == enc.encode_ordinary(t)


def test_segments_of_every_script():
    enc = K.load(f"{K.DEFAULT_DIR}/byte_bpe_50k.tiktoken")
    rng = random.Random(3)
    ranges = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x340), (0x370, 0x530), (0x5D0, 0x700), (0x900, 0x980), (0x2000, 0x2070), (0x3000, 0x3100), (0x4E00, 0x4F00), (0xAC00, 0xAD00), (0xFF00, 0xFFF0), (0x1F600, 0x1F650)]
    for _ in range(1500):
        t = "".join(chr(rng.randrange(*rng.choice(ranges))) if rng.random() < 0.8 else rng.choice(" '\n") for _ in range(rng.randint(0, 40)))
        ids = []
        for part, whole in K.segments(t, rng.choice([1, 2, 5])):
            ids += list(enc._core_bpe.encode_single_piece(part.encode())) if whole else enc.encode_ordinary(part)
        assert ids == enc.encode_ordinary(t), t
    for sentence in ("これは長い文章です。東京都の会議は、3時に始まります。", "Это очень длинный текст о плане. ", "هذا نص طويل جدا عن الخطة. ", "यह एक लंबा पाठ है। ", "긴 글입니다. "):
        t = sentence * (1_000_000 // len(sentence.encode()))
        parts = [len(p) for p, _ in K.segments(t)]
        assert max(parts) < K.SEGMENT + 100 and sum(parts) == len(t)
        assert K.encode_ids(enc, t).tolist() == enc.encode_ordinary(t)


# 8


def test_packing(spark):
    rng = np.random.default_rng(0)
    n = np.concatenate([rng.integers(1, 700, 3000), [0, 5000, 2048, 4096]])
    rows = [(i, int(x)) for i, x in enumerate(n)] + [(9999, None)]
    d = spark.createDataFrame(rows, "doc_id int, n_tokens int")
    got = B.pack(d, items_per_shard=1000).toPandas()
    assert set(got.doc_id) == {i for i, _ in rows}
    fill = got[got.container.notna()].groupby(["shard", "container"]).n_tokens.sum()
    assert fill.max() <= 2048 and fill.sum() == n.sum()
    assert len(fill) <= np.ceil(n.sum() / 2048) * 1.01 + 4
    per = got.groupby("doc_id").agg(n=("n_tokens", "sum"), pieces=("piece_no", "count"))
    for i, x in rows:
        assert per.loc[i, "n"] == (x or 0) and per.loc[i, "pieces"] == max(1, -(-(x or 0) // 2048))
    assert B.pack(d.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, 700)] * 4000, "doc_id int, n_tokens int")
    per = B.pack(nameless, items_per_shard=500).groupBy("shard").count().collect()
    assert len(per) == 8 and max(r["count"] for r in per) < 1000


# 9


def test_spam_pages(spark):
    rng = random.Random(4)
    who = ["the member", "a trustee", "the office", "each worker"]
    sentence = lambda: f"After the close of the plan year {rng.choice(who)} must send the {rng.choice(['form', 'notice', 'claim'])} to the regional office by mail."
    spam = lambda: ", ".join(f"{rng.choice(['cheap', 'best', 'top'])} {rng.choice(['cover', 'quote', 'rollover'])} {rng.choice(['Darley', 'Oston', 'Velmora', 'Kenria'])}{rng.randint(1, 99)}" for _ in range(40))
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        text = spam() if bad else " ".join(sentence() for _ in range(8))
        rows.append((i, text, f"host{i % 12}"))
        if i % 2 == 0 and i < 200:
            labels.append((i, int(bad)))
    rows += [(500, None, "h"), (501, "", None), (502, "  ", "h"), rows[0]]
    d = spark.createDataFrame(rows, "doc_id int, text string, source string")
    l = spark.createDataFrame([*labels, (3, None)], "doc_id int, is_spam int")
    got = {r.doc_id for r in W.spam_pages(d, l).where("is_spam").collect()}
    assert got == {i for i in range(240) if i % 4 == 0}
    assert W.spam_pages(d.limit(0), l).count() == 0


def test_both_kinds_of_evidence_decide(spark):
    """Pages of words outside sentences are spam only if other hosts hold their phrases, and phrases of other hosts
    are spam only outside sentences: dropping either evidence changes the result."""
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
    keys = [f"{a} {b} {c}" for a in ("cheap", "best", "top") for b in ("cover", "quote") for c in ("oston", "darley", "velmora")]
    rows, labels = [], []
    for i in range(300):
        kind = i % 3
        if kind == 0:  # keyword phrases
            text = " | ".join(rng.sample(keys, 12))
        elif kind == 1:  # a directory of names
            text = " | ".join(f"{name()} {name()} {name()}" for _ in range(12))
        else:  # sentences in common phrases
            text = " ".join(f"After the close of the year ask for the {rng.choice(keys)} form at the office nearby." for _ in range(4))
        rows.append((i, text, f"host{i % 20}"))
        if i < 240:
            labels.append((i, int(kind == 0)))
    d = spark.createDataFrame(rows, "doc_id int, text string, source string")
    l = spark.createDataFrame(labels, "doc_id int, is_spam int")
    found = lambda p: {r.doc_id for r in p.where("is_spam").collect()}
    spam = {i for i in range(300) if i % 3 == 0}
    p = W.spam_pages(d, l)
    assert found(p) == spam
    weights = W.fit_labels(p.drop("score", "is_spam"), l)
    assert all(w >= 0 for w in weights[1:])
    weights[1 + W.FEATURES.index("replicated")] = 0
    assert found(p.withColumn("is_spam", W.score(weights) > 0.5)) < spam
    # the evidence itself: names are not replicated, sentences are no lists
    e = {r.doc_id: r for r in p.collect()}
    assert min(e[i].replicated for i in spam) > 0.5 and max(e[i].replicated for i in range(1, 300, 3)) == 0
    assert all(e[i].list_density == 0 and e[i].replicated == 0 for i in range(2, 300, 3))
    # the same pages on one host are not replicated, a copied page counts on every host
    one = W.page_evidence(d.withColumn("source", F.lit("h")))
    assert one.agg(F.max("replicated")).collect()[0][0] == 0
    copies = spark.createDataFrame([(k, "alpha beta gamma | delta epsilon", f"h{k}") for k in range(4)], "doc_id int, text string, source string")
    assert W.page_evidence(copies).agg(F.min("replicated")).collect()[0][0] > 0
    assert W.page_evidence(copies.where("doc_id > 0")).agg(F.max("replicated")).collect()[0][0] == 0


def test_labels_of_one_class_teach_nothing(spark):
    d = spark.createDataFrame([(1, "cheap cover, cheap cover", "h"), (2, None, "h")], "doc_id int, text string, source string")
    for rows in ([(1, 1)], []):
        got = W.spam_pages(d, spark.createDataFrame(rows, "doc_id int, is_spam int")).collect()
        assert [(r.doc_id, r.score, r.is_spam) for r in got] == [(1, None, None)]


def test_held_out_accuracy(spark):
    """Trained on the labels of even documents, right on those of odd ones."""
    sf = "/root/testdata/sf0.1"
    lab = spark.read.parquet(f"{sf}/page_labels.parquet").where("is_spam is not null")
    even, odd = lab.where("doc_id % 2 = 0"), lab.where("doc_id % 2 = 1")
    assert even.where("is_spam = 1").count() > 40
    p = W.spam_pages(spark.read.parquet(f"{sf}/documents.parquet"), even)
    t = p.select("doc_id", F.col("is_spam").cast("int").alias("got")).join(odd, "doc_id").select("got", "is_spam").collect()
    assert len(t) > 400 and sum(r.is_spam for r in t) > 40
    assert sum(r.got == r.is_spam for r in t) / len(t) >= 0.99
    assert sum(r.got and r.is_spam for r in t) / sum(r.is_spam for r in t) >= 0.95


def test_nothing_else_imports_the_package():
    import pathlib

    import pagewright

    root = pathlib.Path(pagewright.__file__).parent
    for p in root.rglob("*.py"):
        if p.parent.name != "llm":
            assert "pagewright.llm" not in p.read_text(), p
