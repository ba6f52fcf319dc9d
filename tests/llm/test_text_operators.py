"""Exact dedup, decontamination, mixing, quality, secrets against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from finecast.llm import decontaminate, exact_dedup, mixing, quality, secrets_scan
from tests.llm import odd

SPACE = re.compile(r"[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return odd.documents(spark)


def test_exact_dedup(spark, docs):
    got = [tuple(r) for r in exact_dedup.exact_report(odd.clashing(docs)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    groups = defaultdict(list)
    for i, t in docs.select("doc_id", "text").collect():
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i, t))
    want = []
    for norm, rows in groups.items():
        rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        for k, r in enumerate(rows):
            want.append((r[2], rows[0][2], len(rows), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    assert sorted(map(str, got)) == sorted(map(str, want))
    kept = exact_dedup.drop_exact(odd.clashing(docs))
    assert kept.columns == odd.clashing(docs).columns
    assert kept.count() == len(groups)
    assert exact_dedup.exact_report(odd.empty(docs)).count() == 0


def test_exact_dedup_compares_bytes_inside_a_hash(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("same"))
    df = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup.exact_report(df).select("doc_id", "keep_id", "group_size").collect())) == [(1, 1, 2), (2, 1, 2), (3, 3, 1)]


def _words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _hits(words, items):
    marks, found = set(), set()
    for item, w in items:
        n = min(10, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in grams:
                marks |= set(range(i, i + n))
                found.add(item)
    return marks, found


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_decontamination(spark, docs, limit):
    bench = [(1, odd.prose(12)), (2, "Straße ΣΑΣ"), (3, None), (4, ""), (5, odd.prose(40, 1)), (6, "ONE"), (7, "x" * 250), (8, odd.prose(10)), (None, "gamma5")]
    table = spark.createDataFrame(bench, "item_id long, text string")
    got = [tuple(r) for r in decontaminate.contamination_report(odd.clashing(docs), table, broadcast_bytes=limit).collect()]
    items = [(str(i) if i is not None else None, _words(t)) for i, t in bench]
    want = []
    for i, t in docs.select("doc_id", "text").collect():
        w = _words(t)
        marks, found = _hits(w, items)
        names = sorted(f for f in found if f is not None)
        want.append((i, len(w), len(marks), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(marks)))
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_decontamination_across_stretches(spark, limit):
    """Passages at every place around the ends of stretches, in texts of those lengths, rows repeated, ids null."""
    passage = [f"p{i}" for i in range(10)]
    rows = []
    for at in (0, 53, 54, 55, 63, 64, 65, 118, 127, 128):
        for after in (0, 1, 70):
            rows.append((len(rows), " ".join([f"w{i}" for i in range(at)] + passage + [f"v{i}" for i in range(after)])))
    rows += [(None, rows[4][1])] * 3 + [(7, rows[7][1])]
    bench = spark.createDataFrame([(1, " ".join(passage)), (2, "v0"), (3, "w63 p0")], "item_id long, text string")
    got = decontaminate.contamination_report(spark.createDataFrame(rows, "doc_id long, text string"), bench, broadcast_bytes=limit).collect()
    items = [("1", passage), ("2", ["v0"]), ("3", ["w63", "p0"])]
    want = []
    for i, t in rows:
        marks, found = _hits(_words(t), items)
        want.append((i, len(_words(t)), len(marks), len(found)))
    assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(map(str, want))


def test_decontamination_cuts_and_drops(spark, docs):
    bench = spark.createDataFrame([(1, odd.prose(12)), (2, "été")], "item_id long, text string")
    clean = decontaminate.drop_contaminated(odd.clashing(docs), bench)
    assert clean.columns == odd.clashing(docs).columns
    texts = {r["doc_id"]: r["text"] for r in decontaminate.cut_spans(docs.where("doc_id IS NOT NULL"), bench).select("doc_id", "text").collect()}
    assert odd.prose(12) not in texts[2] and texts[2].split()[0] == odd.prose(60).split()[12]
    assert texts[8] == "ÀÉ Straße ΣΑΣ Été" and texts[5] is None and texts[9] == "one"
    assert decontaminate.contamination_report(odd.empty(docs), bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination_report(docs, odd.empty(bench)).collect())


def test_mix(spark, docs):
    rows = mixing.mix(odd.clashing(docs)).collect()
    assert len(rows) == docs.count()
    sizes = defaultdict(int)
    for s, t in docs.select("source", "text").collect():
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, budget, target = set(order), 1.5 * sum(sizes.values()), {}
    while left:  # clamp what is above its cap, share the rest again
        level = budget / sum(weight[s] for s in left)
        above = {s for s in left if weight[s] * level > 2 * sizes[s]}
        for s in above or left:
            target[s] = 2 * sizes[s] if above else weight[s] * level
            budget -= target[s]
        left -= above or left
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["size"] * r["repeats"] <= 2 * r["size"]
    for s in order:
        of = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in of) - target[s]) <= max(r["size"] for r in of)
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r["doc_id"], r["source"], r["taken"]) for r in again) == Counter((r["doc_id"], r["source"], r["taken"]) for r in rows)
    assert mixing.mix(odd.empty(docs)).count() == 0
    assert {r["taken"] for r in mixing.mix(docs.where("text IS NULL")).collect()} == {0}


def test_quality(spark, docs):
    good = [(i, odd.prose(40 + i % 30, i).capitalize() + ".") for i in range(200)]
    bad = [(1000 + i, " ".join(["spam!!"] * (30 + i % 20))) for i in range(200)]
    train = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(5, None), (77777, 1), (None, 0)], "doc_id long, quality int")
    model = quality.fit(train, labels)
    out = {r["doc_id"]: r for r in quality.score(train, model).collect()}
    held = [r for r in out.values() if r["held_out"]]
    assert len(held) > 50 and np.mean([r["predicted"] == (r["doc_id"] < 1000) for r in held]) > 0.97
    rows = quality.score(odd.clashing(docs), model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    same = {r["score"] for r in rows if r["doc_id"] in (5, 6) or r["text"] is None}
    assert len(same) == 1
    assert quality.quality_report(odd.empty(docs), labels).count() == 0
    assert {r["score"] for r in quality.quality_report(train, odd.empty(labels)).collect()} == {0.5}
    assert {r["score"] for r in quality.quality_report(train, labels.where("quality = 1")).collect()} == {1.0}
    kept = quality.keep_good(odd.clashing(train), labels)
    assert kept.columns == odd.clashing(train).columns


def _secrets(t):
    t, out = t or "", []
    for m in re.finditer(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[1]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", t):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer(r"[0-9a-f]+", t):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, m.end(), "hex"))
    return sorted(out)


def test_secrets(spark, docs):
    rng = np.random.default_rng(1)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    random = "".join(alphabet[i] for i in rng.integers(0, 64, 44)) + "="
    texts = [
        "PassWord: hunter22 token=abc token='abcdef.g' api-key=zzzzzzz ApiKey = \"k_e-y/1\"", "toKen:abcdef", "é AKIA" + "A1" * 8 + " AKIASHORT AKIA" + "B" * 30,
        "0123456789abcdef01234567 deadbeef", f"call {random} now", "internationalizationandlocalizationframework", "a" * 60, "x" * 24 + "0123456789", "secret:token=token:abcdefg", None, "",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(100 + i, odd.prose(300, i)) for i in range(30)] + [(4, texts[4]), (None, texts[0])], "doc_id long, text string")
    got = secrets_scan.secrets_report(odd.clashing(df)).collect()
    assert len(got) == df.count()
    by = {r["doc_id"]: r for r in got}
    for i, t in df.collect():
        r = by[i]
        want = _secrets(t)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(w[3] == k for w in want) for k in ("assign", "access", "hex")), t
        digest = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
        assert r["base_sha256"] == hashlib.sha256(digest.encode()).hexdigest()
        assert [x for x in r["spans"].split(",") if x and not x.startswith("random")] == [x for x in digest.split(",") if x]
    assert by[4]["spans"] == "random:5:50"
    assert not any("random" in r["spans"] for i, r in by.items() if i != 4)
    assert secrets_scan.secrets_report(odd.empty(docs)).count() == 0
    assert secrets_scan.secrets_report(odd.clashing(docs)).count() == docs.count()


B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def _found(spark, planted, plain):
    """Each key of (text, key) is found once, and nothing in plain texts."""
    texts = [t.format(k) for t, k in planted]
    df = spark.createDataFrame(list(enumerate(texts + plain)) + [(100 + i, odd.prose(300, i)) for i in range(30)], "doc_id long, text string")
    got = {r["doc_id"]: [(x["s"], x["e"]) for x in r["spans"] if x["k"] == 3] for r in secrets_scan.scan(df).collect()}
    for i, (t, (_, key)) in enumerate(zip(texts, planted, strict=True)):
        assert len(got[i]) == 1 and got[i][0][0] <= t.index(key) and got[i][0][1] >= t.index(key) + len(key), (t, got[i])
    assert not any(spans for i, spans in got.items() if i >= len(texts))


def _draw(rng, chars, n):
    return "".join(chars[i] for i in rng.integers(0, len(chars), n))


def test_secrets_inside_runs(spark):
    rng = np.random.default_rng(5)
    keys = [_draw(rng, B62 + "+/", 40), _draw(rng, B62, 44), _draw(rng, B62, 40)]
    _found(spark, list(zip(["run AWS_ACCESS_KEY_ID={} now", "at /user-files/{} there", "go sig={}== on"], keys, strict=True)), ["/usr-local/share/applications/environment", "MAX_LENGTH_OF_NAME=DEFAULT_LENGTH_OF_NAME"])


def test_secrets_of_one_case_and_short(spark):
    rng = np.random.default_rng(6)
    keys = [_draw(rng, B62[26:52], 44), _draw(rng, B62[:26], 44), _draw(rng, B62, 18)]
    _found(spark, [("key {} here", k) for k in keys], ["internationalizationandlocalizationframework", "Donaudampfschifffahrtsgesellschaft", "anticonstitutionnellement"])


def test_battery_tells_random_from_patterned():
    rng = np.random.default_rng(2)
    passed = [min(secrets_scan.battery(rng.integers(0, 64, 48), 64)) >= secrets_scan.LEVEL / 3 for _ in range(300)]
    assert np.mean(passed) > 0.98
    for x in (np.arange(48) % 64, np.zeros(48, int), np.tile([1, 60], 24)):
        assert min(secrets_scan.battery(x, 64)) < secrets_scan.LEVEL / 3
