"""Fill-in-middle, byte-level BPE and product codes against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from finecast.llm import byte_bpe, fill_middle, product_codes
from tests.llm import odd

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
TRICKY = ["<P>x<S>", "a<", "<", "<P", "S>", "$1 \\2 {3}", "a\nb\r\nc d", "naïve ΣΑΣ 𝔘𝔫𝔦 🏳️‍🌈 x", "\x00\x1c\x85", "it's we'LL 'd'd ''s", "   tabs\t\t  end  ", "1a2b33 c-d_e", "ࡰࡱ \U0001e900x", "　  x"]


def _sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    more = spark.createDataFrame([(100 + i, t, "en", "t") for i, t in enumerate(TRICKY * 8)], "doc_id long, text string, lang string, source string")
    return odd.documents(spark).unionByName(more, allowMissingColumns=True)


def _cut(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = _sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", text, None, None
    if h4 % 100 < 20:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_fill_middle(docs):
    src = odd.clashing(docs).withColumn("fim_form", docs.doc_id)
    out = fill_middle.fill_middle(src)
    assert [c for c in out.columns if c not in fill_middle.ADDED] == [c for c in src.columns if c != "fim_form"]
    rows = out.withColumn("back", fill_middle.restored(out.fim_output, out.fim_form)).collect()
    assert {r.fim_form for r in rows} == {"plain", "spm", "psm"}
    for r in rows:
        assert tuple(r[c] for c in fill_middle.ADDED) == _cut(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert fill_middle.fill_middle_report(odd.empty(docs)).count() == 0


def test_fill_middle_of_a_very_long_text(spark):
    text = ("word " * 400 + "é" * 300 + "\n" + "x" * 5000) * 200
    df = spark.createDataFrame([(i, text) for i in range(6)], "doc_id long, text string")
    for r in fill_middle.fill_middle_report(df).collect():
        n, form, out, p, m = _cut(r.doc_id, text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, p, m, _sha(out), _sha(text))


def test_fill_middle_takes_other_marks_and_rates(docs):
    marks = ("$1", "\\2", "{m}")
    out = fill_middle.fill_middle(docs, marks=marks, plain=0, spm=50, seed=9)
    rows = out.withColumn("back", fill_middle.restored(out.fim_output, out.fim_form, marks)).collect()
    for r in rows:
        held = any(x in (r.text or "") for x in marks)
        assert (r.fim_form == "plain") == (held or not r.text)
        assert r.back == (r.text or "")
        if r.fim_form == "psm":
            assert r.fim_output.startswith("$1") and r.fim_output.index("\\2") == r.fim_prefix_chars + 2


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _library(v):
    return tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks=v.ranks, special_tokens={})


def test_byte_bpe(docs, vocabulary):
    src = odd.clashing(docs).withColumn("bpe_ids", docs.doc_id)
    coded = byte_bpe.encode(src, vocabulary)
    assert sorted(coded.columns) == sorted(src.columns)
    library = _library(vocabulary)
    for r in byte_bpe.decode(coded, vocabulary).collect():
        assert r.bpe_ids == library.encode_ordinary(r.text or "")
        assert bytes(r.bpe_bytes) == (r.text or "").encode()
    at_once = byte_bpe.encode(src, vocabulary, decoded="token").select("bpe_ids", "token", "text").collect()
    assert all(r.bpe_ids == library.encode_ordinary(r.text or "") and bytes(r.token) == (r.text or "").encode() for r in at_once)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.bpe_report(docs, vocabulary).collect()}
    ids = [(i, library.encode_ordinary(t or ""), t or "") for i, t in docs.select("doc_id", "text").collect()]
    assert got == {(i, len(x), _sha(" ".join(map(str, x))), _sha(t)) for i, x, t in ids}
    assert byte_bpe.bpe_report(odd.empty(docs), vocabulary).count() == 0


def test_every_code_point_is_cut_as_the_library_does(spark, vocabulary):
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"é{c}{c} {c}9{c}!" for c in every[at : at + 512]) for at in range(0, len(every), 512)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    library = _library(vocabulary)
    got = {r.doc_id: r.bpe_ids for r in byte_bpe.encode(df, vocabulary).collect()}
    assert all(got[i] == library.encode_ordinary(t) for i, t in enumerate(texts))


def _one_by_one(ranks, word):
    """The lowest-ranked pair, leftmost first, over and over."""
    if word in ranks:
        return [ranks[word]]
    parts = [bytes([b]) for b in word]
    while True:
        found = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_replay_of_ranks_in_any_order():
    """Ranks that no training would give: long tokens before their parts, overlaps, ties."""
    rng = random.Random(4)
    for _ in range(60):
        tokens = {"".join(rng.choices("abc", k=rng.randint(2, 5))).encode() for _ in range(25)}
        order = [bytes([b]) for b in range(256)] + sorted(tokens)
        rng.shuffle(order)
        v = byte_bpe.Vocabulary({t: i for i, t in enumerate(order)}, "")
        words = ["".join(rng.choices("abcd", weights=[5, 4, 3, 1], k=rng.randint(1, 30))).encode() for _ in range(50)]
        assert v.encoded(words) == [_one_by_one(v.ranks, w) for w in words]
        assert byte_bpe.replay(v, []) == []


def test_a_long_word_takes_time_in_proportion(vocabulary):
    word = b"ab" * 200_000
    ids = byte_bpe.replay(vocabulary, [word, b"hello", b"a" * 100_001])
    assert b"".join(vocabulary.tokens[t].as_py() for t in ids[0]) == word
    assert ids[1] == [vocabulary.ranks[b"hello"]]


def test_an_unknown_id_fails(spark, vocabulary):
    df = spark.createDataFrame([([50_256],)], "bpe_ids array<int>")
    with pytest.raises(Exception, match="lacks an id"):
        byte_bpe.decode(df, vocabulary).collect()


def _full_lloyd(rows, parts=4, entries=256, rounds=4):
    """(id, label, ints) rows in order of id; every part looks at every entry in every round."""
    w = len(rows[0][2]) // parts
    cut = [[r[2][p * w : p * w + w] for p in range(parts)] for r in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for c in cut:
                members[near(p, c[p])[1]].append(c[p])
            books[p] = [[sum(v) // len(v) for v in zip(*members[i], strict=True)] if i in members else e for i, e in enumerate(books[p])]
    return [[near(p, c[p]) for p in range(parts)] for c in cut], books


def _vectors(spark, n, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        v = [0.5] * dim if hot else (rng.integers(-3, 4, dim) / 7).round(2).tolist() if i % 2 else rng.normal(0, 0.3, dim).tolist()
        rows.append((int(i * 3 % (n + 1)), v, None if i % 5 == 0 else 0 if hot else i % 4))
    bad = [(-5, None, 1), (-4, [0.1] * (dim - 1) + [None], 1), (-3, [float("nan")] + [0.1] * (dim - 1), 1), (-2, [float("inf")] * dim, None), (-1, [-float("inf")] + [0.0] * (dim - 1), 2)]
    return spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").repartition(7)


@pytest.mark.parametrize(("n", "entries", "rounds"), [(420, 256, 4), (150, 16, 6), (40, 256, 2)])
def test_product_codes(spark, n, entries, rounds):
    df = odd.clashing(_vectors(spark, n)).withColumn("pq_error", odd.F.lit(1))
    coded, books = product_codes.product_codes(df, entries=entries, rounds=rounds)
    assert set(coded.columns) == set(df.columns) - {"embedding"} | {"pq_code"}
    kept = sorted((r.vec_id, r.label, [int(np.floor(1024.0 * x)) for x in r.embedding]) for r in df.where("vec_id >= 0").collect())
    want, entries_want = _full_lloyd(kept, 4, entries, rounds)
    got = {r.vec_id: (r.pq_code, r.pq_error) for r in coded.collect()}
    assert got == {k[0]: ([i for _, i in c], sum(d for d, _ in c)) for k, c in zip(kept, want, strict=True)}
    assert books.entries.tolist() == entries_want
    back = product_codes.rebuilt(coded, books).select("vec_id", "pq_vector").first()
    assert len(back.pq_vector) == 8


def test_codes_report(spark):
    df = _vectors(spark, 200)
    rows = product_codes.codes_report(odd.clashing(df)).collect()
    by = defaultdict(int)
    labels = {r.vec_id: r.label for r in df.collect()}
    for r in rows:
        by[labels[r.vec_id]] += r.error
    assert len(rows) == 200 and all(r.label_error == by[labels[r.vec_id]] and re.fullmatch("[0-9a-f]{8}", r.code) for r in rows)
    assert len({r.codebooks_sha256 for r in rows}) == 1
    assert product_codes.codes_report(odd.empty(df)).count() == 0


def test_codes_of_odd_widths_and_repeated_ids(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0]), (1, [1.0, 2.0, 3.0, 4.0]), (1, [0.0, 2.0, 3.0, 4.0]), (None, [9.0] * 4), (2, [1.0]), (3, []), (4, [1e30, 0.0, 0.0, 0.0]), (5, [3.0e5] * 4)]
    coded, books = product_codes.product_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = sorted((str(r.vec_id), r.pq_code, r.pq_error) for r in coded.collect())
    assert [g[0] for g in got] == ["1", "1", "1", "5", "None"]
    # The first entries are (id, vector) in order: 0 2 3 4, 1 2 3 4 twice, id 5, the null id.
    assert [g[1] for g in got] == [[0, 0, 0, 0], [1, 0, 0, 0], [1, 0, 0, 0], [3, 3, 3, 3], [4, 4, 4, 4]]
    assert all(g[2] == 0 for g in got)
    for width in ([1.0, 2.0, 3.0], []):
        coded, books = product_codes.product_codes(spark.createDataFrame([(1, width)], "vec_id long, embedding array<float>"))
        assert coded.count() == 0 and books.entries.size == 0


def test_fixed_parts_look_only_at_entries_that_moved():
    rng = np.random.default_rng(1)
    for _ in range(20):
        c = rng.integers(-6, 7, (2, 12, 3))
        x = rng.integers(-6, 7, (80, 2, 3))
        none = np.full((80, 2), -1), np.zeros((80, 2), np.int64)
        near, far, taken = product_codes.assign(x, product_codes.Codebooks(c, np.ones((2, 12), bool)), *none)
        assert taken == 80 * 2 * 12
        fresh = c.copy()
        fresh[:, ::4] += rng.integers(-3, 4, fresh[:, ::4].shape)
        moved = (fresh != c).any(2)
        books = product_codes.Codebooks(fresh, moved)
        one, two = product_codes.assign(x, books, near, far), product_codes.assign(x, books, *none)
        assert (one[0] == two[0]).all() and (one[1] == two[1]).all()
        again = moved[np.arange(2)[None, :], near]
        assert one[2] == (again * 12 + ~again * moved.sum(1)[None, :]).sum() < two[2]


def test_distances_are_exact_for_large_integers():
    x, c = np.array([[1 << 27, -(1 << 27)]]), np.array([[-(1 << 27) + 1, (1 << 27) - 1], [3, 4]])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e, strict=True)) for e in c] for r in x]
    assert product_codes._distances(x, c).tolist() == want
