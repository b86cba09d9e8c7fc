"""Operators 11 to 13 against brute force, planted cases and edges."""

import hashlib
import itertools
import math
import os
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeflow.llm import filter_audit, periodic, url_filter
from changeflow.llm.queries import OP12_RULES, op11_periodic_runs, op12_url_filter, op13_filter_audit

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


# --- Periodic runs


def _runs(s):
    """All runs by their definition: for each period the longest stretches of words that agree with those one period on."""
    found = {}
    for q in range(1, len(s) // 4 + 1):
        i = 0
        while i + q < len(s):
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # periods come in order, so the smallest stays
            i = j
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _sequences():
    rnd = random.Random(11)
    for n in range(13):
        yield [0] * n
    for letters in (1, 2, 3, 5):
        for _ in range(150):
            yield [rnd.randrange(letters) for _ in range(rnd.randrange(0, 40))]
    for _ in range(300):  # repeated pieces beside and within each other
        s = []
        for _ in range(rnd.randrange(1, 5)):
            piece = [rnd.randrange(3) for _ in range(rnd.randrange(1, 8))]
            piece = piece * rnd.randrange(1, 4)
            s += (piece * rnd.randrange(1, 8))[: rnd.randrange(1, 90)] + [rnd.randrange(4) for _ in range(rnd.randrange(3))]
        yield s


def test_runs_by_brute_force():
    some = 0
    for s in _sequences():
        assert periodic.runs_of(s) == _runs(s), s
        some += len(_runs(s))
    assert some > 500


def test_texts_by_brute_force():
    texts = [" ".join(f"w{x}" for x in s) for s in _sequences()]
    n, runs, left = periodic.treat(pa.array(texts))
    for text, count, own, rest in zip(texts, n, runs, left.to_pylist()):
        words = WORDS.findall(text)
        assert (count, own, rest) == (len(words), _runs(words), _collapsed(words, own))


def test_stretches_lose_no_run():
    rnd = random.Random(2)
    prose = [f"p{rnd.randrange(400)}" for _ in range(3000)]
    prose[1000:1030] = ["a", "b", "c"] * 10
    prose[2990:] = ["z"] * 10
    _, runs, left = periodic.treat(pa.array([" ".join(prose)] * 2 + [None, ""]))
    assert runs[0] == runs[1] == _runs(prose) and {(1000, 30, 3), (2990, 10, 1)} <= set(runs[0])
    assert runs[2:] == [[], []] and left.to_pylist()[2:] == ["", ""]


def test_long_runs_take_little_time():
    words = ["x", "y"] * 200_000
    _, runs, left = periodic.treat(pa.array([" ".join(words), "u v"]))
    assert runs == [[(0, 400_000, 2)], []] and left.to_pylist() == ["x y", "u v"]


def test_runs_of_a_table(spark):
    rows = [(1, "go " * 6, "k"), (1, "go " * 6, "k"), (2, None, "k"), (None, "\x0b a\x1cb " * 7, "k"), (3, "", "k"), (4, "no runs here", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumn("strongest", F.lit(1))
    out = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["strongest"] and tuple(r["strongest"]), r["collapsed"]) for r in periodic.find_runs(docs).collect()), key=str)
    assert out == sorted(
        [(1, 6, [(0, 6, 1)], (0, 6, 1), "go")] * 2
        + [(2, 0, [], None, ""), (0, 7, [(0, 7, 1)], (0, 7, 1), "a\x1cb"), (3, 0, [], None, ""), (4, 3, [], None, "no runs here")],
        key=str,
    )
    assert periodic.find_runs(docs.where("false")).count() == 0


def test_strongest_ties():
    assert periodic.strongest([(0, 8, 2), (9, 4, 1), (20, 13, 3), (40, 26, 6)]) == (20, 13, 3)
    assert periodic.strongest([(5, 8, 2), (5, 12, 3)]) == (5, 8, 2) and periodic.strongest([]) is None


def _op11(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
    tail = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, _collapsed(words, runs))]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *tail)


@here
def test_op11_by_brute_force(spark):
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    ours = {r["doc_id"]: tuple(r[c] for c in names) for r in op11_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    short = [r for r in docs if len(WORDS.findall(r["text"] or "")) < 3000]  # brute force is quadratic
    assert len(ours) == len(docs) and len(short) > 150
    for r in short:
        assert ours[r["doc_id"]] == _op11(r["doc_id"], r["text"])
    assert sum(1 for r in short if ours[r["doc_id"]][1]) > 5


# --- URL filters


def _grams(url):
    """Features by the definition, of a URL that has a host."""
    rest = url.split("://", 1)[1]
    cut = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    own, tail = rest[:cut].lower(), rest[cut:]
    tail = tail[: min((k for k in map(tail.find, "?#") if k >= 0), default=len(tail))].lower()
    out = []
    for text, mark in ((f".{own}/", ""), (tail, " ")):
        text = re.sub("[0-9]+", "0", text)
        for size in url_filter.SIZES:
            out += [mark + text[i : i + size] for i in range(max(1, len(text) - size + 1))]
    return out


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.fit(url_filter.examples(spark))


def test_weights_are_those_of_the_regression(spark, model):
    """At the optimum of a convex loss its gradient is zero; and scores follow from the weights."""
    hashing, regression = model.stages
    rows = url_filter.examples(spark).collect()
    assert len(rows) < 200
    at = {g: hashing.indexOf(g) for r in rows for g in _grams(r["url"])}
    used = sorted(set(at.values()))
    place = {k: i for i, k in enumerate(used)}
    x = np.zeros((len(rows), len(used)))
    for i, r in enumerate(rows):
        for g in _grams(r["url"]):
            x[i, place[at[g]]] += 1
    y = np.array([r["label"] for r in rows], float)
    w, b = regression.coefficients.toArray(), regression.intercept
    p = 1 / (1 + np.exp(-(x @ w[used] + b)))
    gradient = x.T @ (p - y) / len(rows) + url_filter.PENALTY * w[used]
    assert np.abs(gradient).max() < 1e-3 and abs((p - y).mean()) < 1e-3
    assert not np.delete(w, used).any()
    scores = [r["score"] for r in url_filter.judge(url_filter.examples(spark), model).orderBy("label", "url").collect()]
    assert np.allclose(scores, [s for _, _, s in sorted((r["label"], r["url"], s) for r, s in zip(rows, p))], atol=1e-9)
    assert ((p > 0.5) == (y > 0)).all()


def test_kinds_that_were_not_seen(spark, model):
    """Hosts of the kinds of the table under other names, with pages of harmless kinds and invented words."""
    bad = ["http://casino-win.example.com/en/5", "https://www.free-bets.example.org/de/1", "https://m.ads-track.example.com/en/9", "http://spam-farm.example.com/fr/7", "https://cheap-pills.example.org/en/4.html", "http://blog.adult-x.example.com/es/6#top", "https://mega-casino.example.org/en/4", "http://adserver2.example.com/en/7", "https://pornhub-free.example.com/en/1"]
    fine = ["https://ththth.example.com/en/5", "http://blog.tionsh.example.org/de/77?x=1", "https://m.therble.example.com/fr/6", "http://qxzvv.example.com/en/8", "https://kirjasto.example.org/en/4", "http://m.theron.example.com/es/9.html", "https://www.gardeners.example.com/en/6/", None, "", "no url"]
    urls = spark.createDataFrame([(u, 1) for u in bad] + [(u, 0) for u in fine], "url string, bad int")
    assert [(r["url"], r["verdict"]) for r in url_filter.judge(urls, model).collect() if (r["verdict"] == "block") != (r["bad"] == 1)] == []


def _parsed(url):
    if url is None or "://" not in url:
        return "", ""
    own, tail = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in own), tail


def _rule(url, rules):
    own, tail = _parsed(url)
    fits = []
    for rule in rules:
        of, _, start = rule.partition("/")
        if (own == of or own.endswith("." + of)) and tail.startswith("/" + start):
            fits.append(rule)
    return max(fits, key=lambda r: (len(r), rules[r] == "block", r), default=None)


URLS = [
    None, "", "plain", "http://", "https://net", "https://net/", "https://a.net/en/1", "HTTP://WWW.Example.NET/en/7?q=/de/", "http://example.net/EN/", "http://xexample.net/en/1",
    "http://example.com/de/1", "http://example.com?/de/", "http://example.com#x", "http://m.example.com/de", "http://a.org/fr/1", "http://org/fr/", "http://org/fr", "http://b.example.com/en/4",
    "http://x.example.net:80/en/1", "http://u@example.net/en/1", "ftp://ÄRGER.example.org/fr/ü", "a://b://c.net/en", "http://casino-win.org/fr/3", "http://casino-win.org/de/3\nx", "://example.net/en/",
]


def test_rules_both_ways(spark, model):
    urls = spark.createDataFrame([(u, "h", 1) for u in URLS], "url string, h string, found int")
    rules = OP12_RULES | {"example.org/f": "allow", "xample.net/": "block", "example.com/de/1": "allow", "org/fr": "block", "org": "block"}
    table = spark.createDataFrame([*rules.items(), ("org/fr", "allow"), (None, "block"), ("net/", None)], "rule string, verdict string")
    for rule, verdict in rules.items():
        assert "/" in rule or (rule, verdict) == ("org", "block")
    full = {("/" in r and r) or r: v for r, v in rules.items()}

    def expected(url):
        own, tail = _parsed(url)
        fits = [r for r in full if (own == r.split("/")[0] or own.endswith("." + r.split("/")[0])) and tail.startswith(r[len(r.split("/")[0]) :])]
        return max(fits, key=lambda r: (len(r), full[r] == "block", r), default=None)

    for given in (rules, table):
        out = url_filter.judge(urls, model, given).collect()
        assert sorted(((r["url"], r["host"], r["path"], r["rule"]) for r in out), key=str) == sorted(((u, *_parsed(u), expected(u)) for u in URLS), key=str)
        assert all(r["verdict"] == rules[r["rule"]] for r in out if r["rule"])
        assert out[0]["h"] == "h" and out[0]["found"] == 1
    assert url_filter.judge(urls.where("false"), model, table).count() == 0
    assert url_filter.judge(urls, model, table.where("false")).where("rule is not null").count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(urls.withColumn("Rule", F.lit(1)), model)


def test_tables_without_both_labels(spark):
    urls = spark.createDataFrame([("http://a.b/c",)], "url string")
    none = spark.createDataFrame([(None, 1), ("http://x/y", None)], "url string, label int")
    for table, score in ((none, 0.0), (none.unionByName(urls.withColumn("label", F.lit(1))), 1.0), (none.unionByName(urls.withColumn("label", F.lit(0))), 0.0)):
        assert [r["score"] for r in url_filter.judge(urls, url_filter.fit(table)).collect()] == [score]


def test_very_long_urls(spark, model):
    long = "http://" + "a." * 20_000 + "net/" + "x" * 100_000
    r = url_filter.judge(spark.createDataFrame([(long,)], "url string"), model, OP12_RULES).first()
    assert (len(r["host"]), len(r["path"]), r["rule"]) == (40_003, 100_001, "net/")


@here
def test_op12_by_brute_force(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    out = op12_url_filter(spark, SF).collect()
    assert len(out) == len(pages)
    kinds = ("casino", "bets", "pills", "spam", "adult", "ads-")
    for r in out:
        url = pages[r["page_id"]]
        assert ((r["host"], r["path"]), r["rule"]) == (_parsed(url), _rule(url, OP12_RULES))
        assert r["verdict"] == (OP12_RULES[r["rule"]] if r["rule"] else "block" if any(k in r["host"] for k in kinds) else "allow")


# --- Filter audit


def _fails(text):
    words = WORDS.findall(text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
    }


def _audit(docs, labels):
    """Every order over every document, one after the other."""
    rows = []
    for doc_id, text, source in docs:
        same = [i for i, t, _ in docs if (t or "") == (text or "") and i is not None]
        fails = _fails(text or "") | {"E": doc_id is not None and any(i < doc_id for i in same)}
        own = [(q, t) for i, q, t in labels if i == doc_id and i is not None]
        rows.append((source or "", fails, any(q == 1 for q, _ in own), any(t == 1 for _, t in own)))
    out = {}
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            stay = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [r for r in stay if r[1][f]]
                redundant = sum(r[1][f] for r in gone)
                stay, gone = [r for r in stay if not r[1][f]], gone + here
                alone = sum(r[0] == part and r[1][f] and sum(r[1].values()) == 1 for r in rows)
                out[part, "".join(order), step] = [len(stay), len(here), redundant, alone, sum(r[2] for r in here), sum(r[3] for r in here)]
    total = {}
    for (part, order, step), v in out.items():
        total[part, order[step - 1]] = total.get((part, order[step - 1]), 0) + v[1]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


COUNTS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def _write(spark, folder, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("mask", F.lit(1)).withColumn("n", F.lit("n")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_audit_by_brute_force(spark, tmp_path):
    rnd = random.Random(13)
    texts = ["word " * 250, "", None, "AAA bb", " ".join(f"w{i}" for i in range(220)), " ".join(f"W{i}" for i in range(220)) + " #", "a$b " * 300, "x\x0by\x1cz", "long " * 50_000]
    docs = [(rnd.choice([None, *range(30)]), rnd.choice(texts), rnd.choice(["s", "t", None, ""])) for _ in range(150)] + [(3, texts[4], "s")] * 4
    labels = [(rnd.choice([None, *range(35)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(60)]
    out = op13_filter_audit(spark, _write(spark, tmp_path / "t", docs, labels)).collect()
    ours = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COUNTS) for r in out}
    assert len(out) == len(ours) == 3 * 600 and ours == _audit(docs, labels)
    empty = op13_filter_audit(spark, _write(spark, tmp_path / "e", [], []))
    assert empty.count() == 0 and empty.columns == ["part", "filter_order", "step", *COUNTS]


def test_filters_in_any_number_and_order(spark):
    docs = spark.createDataFrame([(1, "a", "s"), (2, "a", "s"), (3, "b#", "s")], "doc_id long, text string, source string")
    out = filter_audit.audit(docs, {"Z": F.col("text").contains("#"), "M": F.lit(False)}, copies="C").collect()
    rows = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["shapley"]) for r in out}
    assert len(rows) == 18 and rows["CZM", 1] == (2, 1, 6) and rows["MZC", 2] == (2, 1, 6) and rows["MZC", 1] == (3, 0, 0)
    one = filter_audit.audit(docs, {"Z": F.col("text").contains("#")}).collect()
    assert [(r["filter_order"], r["kept"], r["removed"]) for r in one] == [("Z", 2, 1)]
    for wrong in ({}, {"C": F.lit(True)}, {c: F.lit(True) for c in "ABDEFG"}):
        with pytest.raises(ValueError):
            filter_audit.audit(docs, wrong, copies="C" if wrong else None)


def test_matrices():
    columns, m, mine = filter_audit.outcomes("ABCDE")
    assert len(columns) == 600 and {x.shape for x in m.values()} == {(32, 600)} and all(x.dtype == np.int64 for x in m.values())
    assert len({c for c, _ in columns}) == math.factorial(5) and columns == sorted(columns)
    assert (m["kept"] + m["removed"] + m["redundant"] <= 1).all() and m["unique_fails"].sum() == 600
    assert all(columns[k][0][columns[k][1] - 1] == "ABCDE"[mine[k]] for k in range(600))


@here
def test_op13_by_its_sql(spark):
    import duckdb

    from changeflow.llm.queries import OP13_SQL

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(OP13_SQL)
    names = [d[0] for d in found.description]
    ours = op13_filter_audit(spark, SF)
    assert sorted(names) == sorted(ours.columns)
    assert sorted(tuple(r[n] for n in names) for r in ours.collect()) == sorted(found.fetchall())
