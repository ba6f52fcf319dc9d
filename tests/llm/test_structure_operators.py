"""Url filter, chat format, HTML extraction, suffix dedup, n-gram join, components, pipeline."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from finecast.llm import chat, html_blocks, html_extract, ngram_join, suffix_dedup, url_filter
from finecast.llm.components import components
from tests.llm import odd


def _least(pairs):
    up = {}

    def find(a):
        up.setdefault(a, a)
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {a: find(a) for a in up}


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(0, 70)]
    hub = [(500, 500 + i) for i in range(1, 90)]
    mess = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(110)]
    pairs = chain + hub + mess + [(5, 5), (None, 3), (3, None), (1, 0), (0, 1)]
    rng.shuffle(pairs)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == _least(pairs)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_url_filter(spark):
    urls = [
        "https://WWW.Example.NET/en/x#top", "http://sub.example.net/fr/x", "https://example.com/de/1", "https://example.com/en/1", "https://notnet/x", "http://a.org/fr/1",
        "http://a.org/fr", "http://net", "http://net?x", "nonsense", "", None, "ftp://a.net/\n/x", "https://shop.example/a", "https://shop.example/b", "https://shop.example/c", "https://free.example/d",
    ]
    html = {13: '<link rel="canonical" href="https://blocked.net/a">', 14: "<meta http-equiv=refresh content=\"0; url=/a\">", 15: '<link href="https://shop.example/b" rel=canonical>', 16: '<link rel="canonical" href="https://blocked.net/q">'}
    rows = [(i, u, html.get(i)) for i, u in enumerate(urls)] + [(13, urls[13], html[13]), (99, "https://example.net/en/ok", '<link rel="canonical" href="https://free.example/d">')]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = url_filter.judge(odd.clashing(df)).collect()
    assert len(out) == len(rows)
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}
    assert by[0] == ("www.example.net", "/en/x", "example.net/en/", "allow")
    assert by[1] == ("sub.example.net", "/fr/x", "net/", "block")
    assert by[2][2:] == ("example.com/de/", "block") and by[3][2:] == (None, "allow") and by[4][2:] == (None, "allow")
    assert by[5][2:] == ("org/fr/", "allow") and by[6][2:] == (None, "allow")
    assert by[7] == ("net", "", None, "allow") and by[8] == ("net", "", None, "allow")
    assert by[9] == by[10] == by[11] == ("", "", None, "allow")
    assert by[12] == ("a.net", "/\n/x", "net/", "block")
    assert [by[i][2:] for i in (13, 14, 15)] == [(None, "block")] * 3  # aliases of a blocked address
    assert by[16][2:] == (None, "allow")  # an allowed alias outweighs a blocked one
    assert url_filter.judge(odd.empty(df)).count() == 0


def test_url_filter_relative_and_settled_targets(spark):
    link = lambda to: f'<link rel="canonical" href="{to}">'
    cases = {
        "https://a.example.com/x/p": ("en/./y", "https://a.example.com/x/en/y"), "https://a.example.com/x/q?z=1": ("../en/x.html", "https://a.example.com/en/x.html"),
        "https://a.example.com/r#f": ("?id=1", "https://a.example.com/r?id=1"), "https://a.example.com": ("p.html", "https://a.example.com/p.html"),
        "https://a.example.com/x/y/": ("../../../..", "https://a.example.com/"), "https://a.example.com/m": ("mailto:me", None), "https://a.example.com/n": ("http://b.net/../c?u=/../d", "http://b.net/c?u=/../d"),
    }
    df = spark.createDataFrame([(u, to) for u, (to, _) in cases.items()], "u string, t string")
    assert {r["u"]: r["r"] for r in df.select("u", url_filter.resolved_url(F.col("u"), F.col("t")).alias("r")).collect()} == {u: want for u, (_, want) in cases.items()}
    pages = [
        (1, "https://example.com/x", link("de/x")), (2, "https://example.com/a/b/c", link("../../de/y")), (3, "https://example.com/z", '<meta http-equiv="refresh" content="0; url=de/z.html">'),
        (4, "https://one.example/p", link("http://www.two.example/q.html")), (5, "https://two.example/q/", link("https://blocked.net/a")), (6, "https://example.com/en", link("mailto:x")),
    ]
    out = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow"}


def test_chat_round_trip(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "a\\b <| \\n <|im_end|>\n"), (1, 2, "assistant", ""), (2, 5, "assistant", said), (2, 3, "user", said), (3, 0, None, None), (3, 0, None, None),
        (None, 1, "user", "x"), (4, None, "assistant", "first"), (4, 0, "us\ner", "second"), (4, 0, "us\ner", "second"), *[(5, i, "assistant" if i % 2 else "user", odd.prose(5, i)) for i in range(37)],
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.chat_report(odd.clashing(df)).collect()}
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.chat_report(odd.empty(df)).count() == 0


def test_chat_branches(spark):
    nodes = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 5.0), (1, 4, 3, "user", "more", 3.0), (1, 5, 2, "user", "end", None), (2, 1, 99, "user", "orphan", 1.0), (3, 1, 2, "user", "ring", 1.0), (3, 2, 1, "user", "ring", 1.0)]
    df = spark.createDataFrame(nodes, "conv_id long, node long, parent long, role string, text string, score double")
    best = {r["conv_id"]: r for r in chat.format_trees(df).collect()}
    assert [t for _, t in chat.read_back(best[1]["formatted"], [])[0]] == ["q", "good", "more"]
    assert set(best) == {1, 2}
    both = chat.format_trees(df, top=5).where("conv_id = 1").orderBy("branch").collect()
    assert [[t for _, t in chat.read_back(r["formatted"], [])[0]] for r in both] == [["q", "good", "more"], ["q", "bad", "end"]]


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="<p>x</p>";</script></head><body><header><a href="/">Home page</a></header>'
    '<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav><div class="cookie notice">We use cookies &amp; more</div><article><h1>Big &lt;news&gt;</h1>'
    "<p>First\n  para <b>bold</b><br>line &copy; &#x263A;<!-- hid<p>den --><p>Second para, with words. And more of them here.</p><div class=ad>Buy now</div><blockquote>Said so</blockquote></article>"
    '<aside class="sidebar"><p>Side words of some length, as sidebars have.</p></aside><section class="comments"><p>Nice article, I think!</p></section><form><label>Mail</label></form><footer>&copy; Us</footer></body></html>'
)


@pytest.fixture(scope="module")
def labeller(spark):
    texts = [(i, PAGE.replace("First", odd.prose(20, i)).replace("Second", odd.prose(9, i + 1))) for i in range(40)]
    return html_extract.fit(spark.createDataFrame(texts, "page_id long, html string"))


def test_blocks():
    got = [b.text for b in html_blocks.blocks(PAGE)]
    assert got[:5] == ["T", "Home page", "One", "Two", "We use cookies & more"]
    assert "First para bold line © ☺" in got and "Big <news>" in got
    assert [b.text for b in html_blocks.blocks("a <p>b<script>never closed <p>x")] == ["a", "b"]
    assert html_blocks.blocks("") == [] and [b.text for b in html_blocks.blocks("5 < 6 & 7 > 2 &am")] == ["5 < 6 & 7 > 2 &am"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>5</mn></math> hold.</p><p>b", ["Let x=5 hold.", "b"]),
        ("<p>a</p><svg><p>kept</p><p>b</p>", ["a", "kept", "b"]),
        ("<p>see <svg viewBox='0'><title>Icon</title><desc>a circle</desc><text>label</text></svg> there</p>", ["see label there"]),
        ("<p>1 <math><semantics><mi>y</mi><annotation encoding='tex'>\\y</annotation></semantics></math> 2</p>", ["1 y 2"]),
        ("<p>x <object data='a'>instead</object> y<noscript> z</noscript><canvas>c</canvas></p>", ["x instead y zc"]),
        ("<div>x <iframe src='a'>never shown</div><div>y</div>", ["x", "y"]),
        ("<p>a<math><mi>q</p><p>b</math> c</p>", ["aq", "b c"]),
        ("<p>a <svg><title>never closed<p>b</p>", ["a", "b"]),
        ("<title>T</title><p>a<script>x<p>y</script>b<textarea>t</textarea>", ["T", "ab"]),
    ],
)
def test_html_blocks_keep_what_a_page_shows(page, want):
    assert [b.text for b in html_blocks.blocks(page)] == want


def test_html_extract(spark, labeller):
    rows = [(1, PAGE), (1, PAGE), (2, None), (3, ""), (4, "</p></div>"), (5, PAGE.replace("Second", "word " * 20000))]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("old")).withColumn("url", F.lit(None).cast("string"))
    out = html_extract.extract(df, labeller).collect()
    want = "Big <news>\nFirst para bold line © ☺\nSecond para, with words. And more of them here.\nSaid so"
    assert [r["text"] for r in out if r["page_id"] == 1] == [want, want]
    assert {r["page_id"]: r["text"] for r in out if r["page_id"] in (2, 3, 4)} == {2: "", 3: "", 4: ""}
    assert len([r for r in out if r["page_id"] == 5][0]["text"]) > 100_000
    assert html_extract.html_report(odd.empty(df)).count() == 0


def test_labeller_uses_the_whole_page(labeller):
    import numpy as np

    rng = np.random.default_rng(9)
    wrong = total = 0
    for _ in range(150):
        page = html_extract.made_page([odd.prose(60, i) for i in range(30)], rng)
        c = labeller.chances([html_extract.vectors([b for b, _ in page])])[0]
        wrong += sum((a >= 0.5) != bool(y) for a, (_, y) in zip(c, page, strict=True))
        total += len(page)
    assert wrong / total < 0.08
    alone = labeller.chances([html_extract.vectors([page[0][0]])])[0]
    assert len(alone) == 1


def _removed(rows, length=100):
    seen, out = set(), {}
    for key, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = [True] * length
            seen.add(w)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("pieces", [suffix_dedup.PIECES, 2])
def test_suffix_dedup(spark, pieces, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECES", pieces)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé\0") for _ in range(rng.randrange(1, 7)))
    passage = [" ".join(word() for _ in range(60)) for _ in range(4)]
    rows = [(i, " ".join(word() for _ in range(rng.randrange(0, 80))) + rng.choice(passage)[rng.randrange(0, 80) :] + " ".join(word() for _ in range(30))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, "ab" * 300), (201, "ab" * 120 + "c" + "ba" * 90), (202, None), (203, ""), (204, "z" * 99), (205, "z" * 100), (206, "z" * 101)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.repeats_report(odd.clashing(df)).collect()}
    assert got == _removed(rows)


@pytest.mark.parametrize("pieces", [suffix_dedup.PIECES, 1])
@pytest.mark.parametrize("partitions", [1, 5])
def test_repeats_have_all_occurrences(spark, partitions, pieces, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECES", pieces)
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefghijkl ") for _ in range(n))
    passage = [noise(150), noise(260)]
    bodies = [noise(70) + p + noise(90) + noise(60) for p in passage for _ in range(2)]
    texts = [b for b in bodies for _ in range(4)] + [noise(300)] * 3 + [passage[0], passage[0], noise(5) + bodies[1]]
    rows = list(enumerate(texts))
    found = suffix_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)).collect()
    own, below, size = {}, {}, {}
    for r in found:
        size[r["repeat"]] = r["size"]
        if r["parent"] is not None:
            below.setdefault(r["parent"], set()).add(r["repeat"])
        if r["doc"] is not None:
            own.setdefault(r["repeat"], set()).add((r["doc"], r["start"]))

    def occurrences(k):
        return own.get(k, set()).union(*[occurrences(c) for c in below.get(k, ())])

    assert len(size) > 4
    for k, n in size.items():
        if pieces == 1 and n > 100:
            continue  # a key of many kinds is taken by strings of 100 bytes
        got = occurrences(k)
        i, s = min(got)
        string = texts[i][s : s + n]
        assert got == {(j, at) for j, t in rows for at in range(len(t) - n + 1) if t.startswith(string, at)}


def test_suffix_dedup_repeated_ids(spark):
    t = odd.prose(40)
    rows = [(1, t), (1, t), (None, t), (2, t[:150]), (1, t[5:])]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = _removed([((1, 0), t), ((1, 1), t), ((1, 2), t[5:]), ((2, 0), t[:150]), ((None, 0), t)])
    order = sorted([t, t, t[5:]])
    assert len(got) == 5 and sum(len(bytes(r["kept"])) == len(x.encode()) for r in got for x in order[:1] if r["doc_id"] == 1) >= 1
    assert sum(r["n_bytes"] - len(bytes(r["kept"])) > 0 for r in got) >= 4 and want
    assert suffix_dedup.repeats_report(odd.empty(odd.documents(spark))).count() == 0


def test_maximal_repeats_against_brute_force():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(60)).encode() for _ in range(4)] + [b"ab" * 30]
    starts = [len(t) - 7 for t in texts]
    got = {texts[p[0][0]][p[0][1] : p[0][1] + n]: sorted(p) for n, p in suffix_dedup.maximal_repeats(texts, starts, 8)}
    where = {}
    for i, t in enumerate(texts):
        for s in range(len(t)):
            for e in range(s + 8, len(t) + 1):
                where.setdefault(t[s:e], []).append((i, s))
    want = {}
    for w, at in where.items():
        if len(at) > 1:
            left = {texts[i][s - 1] if s else (i, s) for i, s in at}
            right = {texts[i][s + len(w)] if s + len(w) < len(texts[i]) else (i, s) for i, s in at}
            if (len(left) > 1 or any(isinstance(x, tuple) for x in left)) and (len(right) > 1 or any(isinstance(x, tuple) for x in right)):
                want[w] = sorted(at)
    assert got == want


def _similar(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if k else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = _least(links)
    return {i: (len(s), comp.get(i, i)) for i, s in sets.items()}


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_ngram_join(spark, width, percent):
    rng = random.Random(width)
    rows = []
    for g in range(6):
        base = odd.prose(80, g).split()
        for k in range(25 if g else 60):  # one group that needs pivots and more rounds
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            rows.append((g * 100 + k, " ".join(w)))
    rows += [(901, None), (902, ""), (903, "a"), (904, "A"), (905, "a b"), (906, "b a"), (907, "É x y z"), (908, "é x y z")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_report(odd.clashing(spark.createDataFrame(rows, "doc_id long, text string")), width, percent).collect()}
    assert got == _similar(rows, width, percent)


def test_ngram_join_sets_of_different_size(spark):
    rng = random.Random(2)
    rows = []
    for g in range(20):  # groups of more than 8, so that pivots and tokens of few sets state a pair in both directions
        base = [f"w{g}x{rng.randrange(10**6)}" for _ in range(80)]
        for k in range(12):
            w = list(base)
            at, n = rng.randrange(len(w)), rng.randrange(0, 10)
            if k % 2:
                w[at:at] = [f"new{rng.randrange(10**6)}" for _ in range(n)]
            else:
                del w[at : at + n]
            for _ in range(rng.randrange(0, 4)):
                p = rng.randrange(len(w))
                w[p : p + rng.randrange(2)] = [f"new{rng.randrange(10**6)}"] * rng.randrange(2)
            rows.append((g * 100 + k, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_report(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()}
    assert got == _similar(rows, 5, 80)


def test_ngram_join_outlines_bound_the_overlap():
    rng = np.random.default_rng(4)
    for n, d in [(1, 0), (1, 1), (5, 2), (300, 10), (300, 300), (255, 3), (256, 5), (5000, 400), (40_000, 40_000)]:
        one = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        other = np.concatenate([one[d:], rng.integers(1, 1 << 63, d + n // 7, dtype=np.uint64)])
        most = ngram_join.most_overlap(ngram_join.outline(one), ngram_join.outline(other))
        assert n - d <= most <= n
        assert d < n or n < 300 or most < 0.95 * n
    full = ngram_join.outline(np.full(300, 7, np.uint64))
    assert full == b"" and ngram_join.most_overlap(full, full) is None


def test_ngram_join_counts_shared_tokens_of_full_and_other_cells(spark):
    few, many = 5 << 46, 9 << 46
    rows = [(r, 10, few + r // 2) for r in range(7)] + [(r, 10, many + r // 3) for r in range(7)]
    often = np.ones(1 << ngram_join.CELL_BITS, np.int64)
    often[9] = 100
    want = sorted((t, r, sum(u == t for _, _, u in rows)) for r, _, t in rows if sum(u == t for _, _, u in rows) > 1)
    for sketch in (often, np.ones_like(often)):
        got = ngram_join._shared(spark.createDataFrame(rows, "rep long, n long, token long"), sketch).collect()
        assert sorted((x["token"], x["rep"], x["c"]) for x in got) == want


def test_ngram_join_odd_rows(spark):
    docs = odd.documents(spark)
    rows = ngram_join.join_report(docs).collect()
    assert len(rows) == docs.count()
    by = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in rows}
    assert by[(2, 58)] == by[(3, 58)] == by[(None, 58)] == 1 and by[(5, 0)] == 5 and by[(None, 0)] is None
    kept = ngram_join.keep_first(docs, width=3, percent=90)
    assert kept.columns == docs.columns and {2, 3} & {r["doc_id"] for r in kept.collect()} == set()
    assert ngram_join.join_report(odd.empty(docs)).count() == 0


def test_tree_prunes_nothing_similar():
    rng = np.random.default_rng(4)
    base = np.sort(rng.choice(10**6, 400, replace=False).astype(np.uint64))
    members = []
    for i in range(60):
        own = np.unique(np.concatenate([rng.choice(base, 400 - int(rng.integers(0, 90)), replace=False), rng.integers(0, 10**6, int(rng.integers(0, 40))).astype(np.uint64)]))
        members.append((i, own.tobytes()))
    want = {}
    for i, raw in members:
        own = set(np.frombuffer(raw, np.uint64).tolist())
        both = len(own & set(base.tolist()))
        if 100 * both >= 80 * (len(own) + len(base) - both):
            want[i] = both
    assert dict(ngram_join.tree_overlaps(base, members, 80)) == want and 0 < len(want) < 60


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = [(i, odd.prose(50 + i % 7, i).capitalize() + ".", "en", f"s{i % 4}") for i in range(120)]
    docs += [(300 + i, docs[i][1], "en", "s0") for i in range(20)] + [(400, docs[3][1] + " tail", "en", "s1"), (401, None, None, None)]
    docs += [(500 + i, "junk!! " * 40, "en", "s2") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d[0], int(d[0] < 500), 0) for d in docs], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, docs[7][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    ids = [set(range(120)) | set(range(300, 320)) | {400}]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        if k < 4:
            assert now.columns == df.columns
        ids.append({r["doc_id"] for r in now.select("doc_id").collect()})
    assert ids[1] - {401} == ids[0]
    assert ids[2] - {401} == set(range(120)) | {400}
    alike = _similar([d[:2] for d in docs if d[0] in ids[2] - {401}], 5, 80)
    assert ids[3] - {401} == {i for i, (_, c) in alike.items() if c == i} and 400 not in ids[3]
    assert 7 not in ids[4] and ids[3] - ids[4] <= {i for i in range(120) if _similar([docs[i][:2], docs[7][:2]], 10, 1)[i][1] == 7 or i == 7 or i < 7}
    assert ids[5] <= ids[4] and len(ids[5]) > 80
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == [*df.columns, "repeats"]
