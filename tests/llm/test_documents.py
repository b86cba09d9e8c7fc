"""SimHash, toxicity, quality, mixing, chat and HTML against brute force, planted cases and edges."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from changeflow.llm import chat, quality, simhash, toxicity
from changeflow.llm.mixing import mix, rates

LONG_TEXT = "lorem ipsum dolor " * 20_000


# --- SimHash


def _print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for b in "\x09\x0a\x0b\x0c\x0d":
        words = words.replace(b, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "a b c d", "A b\tC d\x0be f", "é É x y z", " a b c d e f g", "the the the the the the"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == _print(text)


def _near(ids_prints, radius=4):
    ids = {i: i for i, _ in ids_prints}
    root = lambda a: a if ids[a] == a else root(ids[a])
    for i, x in ids_prints:
        for j, y in ids_prints:
            if i < j and (x ^ y).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                ids[b] = a
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("segments", [2, 3, 4, 5])
@pytest.mark.parametrize("hot", [50_000, 3])
def test_multi_index_finds_every_link(spark, segments, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", hot)
    rnd = random.Random(segments)
    prints = []
    for _ in range(20):
        x = rnd.getrandbits(64)
        for _ in range(rnd.randrange(1, 9)):
            prints.append(x)
            for _ in range(rnd.randrange(0, 6)):
                x ^= 1 << rnd.randrange(64)
    prints = list(dict.fromkeys(prints))
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, segments).collect()
    ids, place = {i: i for i in range(len(prints))}, {x: i for i, x in enumerate(signed)}
    root = lambda a: a if ids[a] == a else root(ids[a])
    for u, v in links:
        a, b = sorted((root(place[u]), root(place[v])))
        ids[b] = a
    assert {i: root(i) for i in ids} == _near(list(enumerate(prints)))


def _texts(seed=3):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randrange(2, 8))) for _ in range(400)]
    texts = [" ".join(rnd.choices(words, k=rnd.randrange(20, 300))) for _ in range(30)]
    texts += [t + " tail" for t in texts[:10]] + texts[:5]
    return [(100 - i, t) for i, t in enumerate(texts)] + [(200, None), (201, ""), (202, "  "), (203, LONG_TEXT)]


def test_near_duplicate_documents(spark, docs_of):
    rows = _texts()
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs_of(rows)).collect()}
    expected = _near(sorted((i, _print(t)) for i, t in rows))
    assert found == expected and len(set(expected.values())) < len(rows) - 5


def test_keep_one(spark, docs_of):
    docs = docs_of([*_texts(), (50, "same id, again"), (50, "same id, again"), (None, "no id")]).withColumn("kept_id", F.lit(1))
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) and None in ids and 50 in ids
    assert simhash.keep_one(docs_of([])).count() == 0


# --- toxicity


def _toxic_rows(n=600, seed=1):
    rnd = random.Random(seed)
    clean = ["".join(rnd.choices("abcdefghij", k=rnd.randrange(3, 9))) for _ in range(500)]
    bad = ["rotten", "vile", "filthy", "wretch"]
    docs, labels = [], []
    for i in range(n):
        words, toxic = rnd.choices(clean, k=60), i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rnd.randrange(60)] = rnd.choice(bad)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity(spark, docs_of):
    docs, labels = _toxic_rows()
    table = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (10**6, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs_of(docs), table)
    held = {i for i, _ in docs if __import__("zlib").crc32(str(i).encode()) % 3 == 1}
    out = {r["doc_id"]: r for r in toxicity.score(docs_of([*docs, (-1, None), (-2, ""), (-3, LONG_TEXT)]), model).collect()}
    hits = [out[i]["score"] >= 0.7 for i in held if i % 5 == 0]
    wrong = [out[i]["score"] >= 0.7 for i in held if i % 5]
    assert sum(hits) / len(hits) > 0.95 and sum(wrong) / len(wrong) < 0.02
    assert all(0 <= r["score"] <= 1 for r in out.values()) and out[-1]["score"] == out[-2]["score"] < 0.7
    assert all(e["doc_id"] % 5 == 0 for e in out[0]["evidence"]) and out[0]["evidence"]
    kept = toxicity.reject(docs_of(docs).withColumn("score", F.lit("mine")), model)
    assert "score" in kept.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if 0 <= i and r["score"] < 0.7}


def _plain_toxicity(rows, share):
    """Scores by dictionaries: (id, toxic, text) examples to a function of a text."""
    words = lambda t: __import__("re").findall(r"\w+", t.lower())

    def weights(part):
        n, out = [sum(1 for r in part if r[1] == y) for y in (0, 1)], {}
        have, left = [Counter(), Counter()], [{}, {}]
        for _, y, t in part:
            have[y].update(set(words(t)))
            for before, w in zip(["", *words(t)], words(t)):
                left[y].setdefault(w, set()).add(before)
        h = lambda *c: -sum(x / sum(c) * math.log(x / sum(c)) for x in c if x)
        for w in {*have[0], *have[1]}:
            c = [min(have[y][w], len(left[y].get(w, ()))) for y in (0, 1)]
            r = [n[y] - c[y] for y in (0, 1)]
            gain = h(*n) - sum(c) / sum(n) * h(*c) - sum(r) / sum(n) * h(*r)
            out[w] = math.log(sum(n) / (have[0][w] + have[1][w])) * max(0, gain)
        return out

    def vector(t, weight):
        v = {w: (1 + math.log(n)) * weight[w] for w, n in Counter(words(t)).items() if weight.get(w, 0) > 0}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    def vote(t, part, weight):
        # Of equal cosines any may count here; the texts are made so that neighbours that tie have one label.
        q = vector(t, weight)
        near = sorted(((round(sum(x * e.get(w, 0) for w, x in q.items()), 12), y) for _, y, u in part for e in [vector(u, weight)]), reverse=True)[: toxicity.NEIGHBOURS]
        near = [(c, y) for c, y in near if c > 0]
        w = [1 / (toxicity.SOFT + 1 - min(c, 1)) for c, _ in near]
        return (0.5 * share + sum(x for x, (_, y) in zip(w, near) if y)) / (0.5 + sum(w)) if near else -1

    fold = {r: i % toxicity.FOLDS for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    votes = {}
    for k in range(toxicity.FOLDS):
        part = [r for r in rows if fold[r] != k]
        weight = weights(part)
        votes |= {r: vote(r[2], part, weight) for r in rows if fold[r] == k}
    mean = sum(r[1] for r in rows) / len(rows)
    heavy = {r: toxicity.PRIOR / mean if r[1] else (1 - toxicity.PRIOR) / (1 - mean) for r in rows}
    none = [r for r in rows if votes[r] < 0]
    bare = (sum(heavy[r] * r[1] for r in none) + toxicity.PRIOR) / (sum(heavy[r] for r in none) + 1)
    fitted = [(votes[r], r[1], heavy[r]) for r in rows if votes[r] >= 0]
    sigmoid = lambda z: 1 / (1 + math.exp(-z))

    def offset(a):  # where the derivative by the offset is zero, by bisection
        lo, hi = -50.0, 50.0
        for _ in range(80):
            b = (lo + hi) / 2
            lo, hi = (lo, b) if sum(h * (sigmoid(a * v + b) - y) for v, y, h in fitted) > 0 else (b, hi)
        return lo

    lo, hi = 0.0, 200.0  # and by the slope
    for _ in range(50):
        a = (lo + hi) / 2
        b = offset(a)
        lo, hi = (lo, a) if sum(h * v * (sigmoid(a * v + b) - y) for v, y, h in fitted) + a > 0 else (a, hi)
    weight = weights(rows)

    def score(t):
        v = vote(t, rows, weight)
        return bare if v < 0 else sigmoid(lo * v + offset(lo))

    return score


def test_scores_by_brute_force(spark, docs_of):
    docs, labels = _toxic_rows(150, 3)
    rows = [(i, labels[i][2], t) for i, t in docs]
    share = 0.2
    model, plain = toxicity.build(rows, share), _plain_toxicity(rows, share)
    texts = [*[t for _, t in docs[:25]], "rotten", "rotten vile zzz", "zzz", "", " ".join(t for _, t in docs[:3])]
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs_of(list(enumerate(texts))), model).collect()}
    assert all(abs(found[i] - plain(t)) < 1e-6 for i, t in enumerate(texts))


def test_nearest_examples_are_exact():
    rnd = np.random.default_rng(2)
    names = [f"w{i}" for i in range(60)]
    rows = [(i, int(rnd.random() < 0.3), " ".join(rnd.choice(names, rnd.integers(0, 30), p=np.arange(1, 61) / 1830))) for i in range(500)]
    rows += [(1000 + i, 1, rows[3][2]) for i in range(20)]  # copies
    sample = toxicity.Sample(rows)
    model = sample.model(np.ones(len(rows), bool), 0.3)
    index, dense = toxicity.Index(model), np.zeros((len(rows), len(model.words)))
    for i in range(len(rows)):
        dense[i, model.at[model.begin[i] : model.begin[i + 1]]] = model.value[model.begin[i] : model.begin[i + 1]]
    assert index.common.shape[1] and len(index.value)
    for _, q in sample.vectors(np.arange(len(rows)) % 3 == 0, model):
        cos = np.round(dense[:, q[0]] @ q[1], 11)
        got, who = index.neighbours(*q)
        best = np.lexsort((np.arange(len(rows)), -cos))[: toxicity.NEIGHBOURS]
        best = best[cos[best] > 0]
        assert np.allclose(got, cos[best], atol=1e-9) and np.allclose(cos[who], got, atol=1e-9) and len(set(who.tolist())) == len(best)


def test_toxicity_without_examples(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs_of([(1, "a b")]), none)
    assert [r["score"] for r in toxicity.score(docs_of([(1, "a b"), (1, "a b")]), model).collect()] == [0.0, 0.0]
    assert toxicity.score(docs_of([]), model).count() == 0
    assert toxicity.reject(docs_of([]), model).count() == 0 and toxicity.reject(docs_of([(1, "a b")]), model).count() == 1


def test_toxicity_sample_bounds(spark, docs_of):
    docs, labels = _toxic_rows()
    table = spark.createDataFrame([*labels, (600, 1, 1)], "doc_id long, quality int, toxic int")
    # A repeated id lends one example, the first text in order; rows over the bound on characters are left out.
    model = toxicity.fit(docs_of([*docs, *[(i, "zz") for i, _ in docs], (600, "vile " * 40_000)]), table, per_class=50, chars=50_000)
    assert 50 < len(model.ids) <= 100 and len(set(model.ids.tolist())) == len(model.ids) and 600 not in model.ids


def _same(model, other):
    assert (model.curve, model.bare, model.share) == (other.curve, other.bare, other.share)
    assert list(map(str, model.words)) == list(map(str, other.words))
    assert all(np.array_equal(getattr(model, f), getattr(other, f)) for f in ("weight", "ids", "toxic", "begin", "at", "value"))


def test_toxicity_fit_by_tasks(spark, docs_of):
    docs, labels = _toxic_rows(120, 5)
    odd = ["", " \n", "\u0130stanbul VILE vile Vile", "vile " * 300, "\ud55c\uae00 \u00df \u1e9e", "?!", docs[3][1], docs[5][1]]
    docs += [(1000 + i, t) for i, t in enumerate(odd)]
    labels += [(1000 + i, 1, i % 2) for i in range(len(odd))]
    table = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    rows = lambda docs, labels: [(i, y, t) for (i, t), (_, _, y) in zip(docs, labels) if __import__("zlib").crc32(str(i).encode()) % 3 != 1]
    share = lambda found: sum(y for _, y, _ in found) / len(found)
    for d, k in ((docs, labels), ([(i, " ?!"[i % 3]) for i in range(30)], [(i, 1, i % 2) for i in range(30)]), (docs[:15], [(i, 1, int(i == 1)) for i in range(15)])):
        found = rows(d, k)
        assert {y for _, y, _ in found} == {0, 1}
        _same(toxicity.fit(docs_of(d), table(k)), toxicity.build(found, share(found)))


def test_toxicity_fit_leaves_the_driver_free(spark, docs_of):
    import tracemalloc

    rnd = random.Random(8)
    names = ["".join(rnd.choices("abcdefgh", k=8)) for _ in range(2000)]
    docs = [(i, " ".join(rnd.choices(names, k=3000))) for i in range(120)]
    table = spark.createDataFrame([(i, 1, i % 2) for i in range(120)], "doc_id long, quality int, toxic int")
    stored, known = docs_of(docs).localCheckpoint(), [(i, i % 2, t) for i, t in docs if __import__("zlib").crc32(str(i).encode()) % 3 != 1]
    peaks, made = [], []
    for run in (lambda: toxicity.build(known, sum(y for _, y, _ in known) / len(known)), lambda: toxicity.fit(stored, table)):
        tracemalloc.start()
        try:
            made.append(run())
            peaks.append(tracemalloc.get_traced_memory()[1])
        finally:
            tracemalloc.stop()
    _same(*made)
    assert peaks[1] < peaks[0] / 4, peaks


# --- quality


def _kneser_ney(texts):
    """The model by its formulas, with dictionaries of strings."""
    grams = lambda t: [("\0\0\0" + " ".join(t.split()))[i : i + 4] for i in range(len(" ".join(t.split())))]
    counts = {4: Counter(g for t in texts for g in grams(t))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount = {k: quality.discounts(Counter(n for n in counts[k].values() if n <= 4)) for k in counts}
    after = {k: {} for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            after[k].setdefault(g[:-1], []).append(n)

    def p(g):
        k, take = len(g), lambda n: discount[len(g)][min(n, 3) - 1]
        lower = p(g[1:]) if k > 1 else 1 / (len(counts[1]) + 1)
        seen = after[k].get(g[:-1])
        if not seen:
            return lower
        n = counts[k].get(g, 0)
        return (n - take(n) if n else 0) / sum(seen) + sum(map(take, seen)) / sum(seen) * lower

    def perplexity(t):
        return math.exp(-sum(math.log(p(g)) for g in grams(t)) / len(grams(t))) if grams(t) else None

    return p, perplexity


def test_kneser_ney(spark, docs_of, monkeypatch):
    texts = ["the cat sat on the mat and  the other cat sat", "on the other\nmat then they ran", "Ящик ящик", "", None]
    model = quality.fit_model(spark.createDataFrame([(t,) for t in texts], "text string"))
    p, perplexity = _kneser_ney([t or "" for t in texts])
    units = sorted(set("".join(t or "" for t in texts).replace("\n", " ")))
    assert math.isclose(sum(p("cat" + u) for u in units) + p("cat\u1234"), 1, rel_tol=1e-9)
    asked = [*texts, "the zebra", "THE!! cat cat cat", "щик \ud83d\ude00 𝒳 x", "a", " \n ", "the " * 5000]
    for slice_of in (quality.SLICE, 40):
        monkeypatch.setattr(quality, "SLICE", slice_of)
        monkeypatch.setattr(quality, "ROWS", 3)
        assert spark.sparkContext.defaultParallelism
        docs = docs_of([(i, t) for i, t in enumerate(asked) if t is None or "\ud83d" not in t]).repartition(2)
        out = {r["doc_id"]: r["perplexity"] for r in quality.perplexities(docs, model).collect()}
        for i, got in out.items():
            want = perplexity((asked[i] or "").encode("utf-16-le").decode("utf-16-le"))
            assert got is want is None or math.isclose(got, want, rel_tol=1e-9)


def test_the_model_makes_few_tasks_and_exchanges(spark):
    texts = spark.createDataFrame([("the cat sat on the mat",), ("the other mat",)], "text string")
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    were = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        model = quality.fit_model(texts)
        assert model.table.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism  # it was 8 x 60: two tables an order
        told = model.log_p(spark.createDataFrame([(int(c),) for c in quality.codes("the bat")], "code long"))
        assert told.count() == 7
        plan = told._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning") <= 4
    finally:
        for k, v in were.items():
            spark.conf.set(k, v)


def test_classifier_by_brute_force(spark, docs_of):
    rows, labels = _quality_rows()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    good = {i for i, q, _ in labels if i is not None and q == 1} - {i for i, q, _ in labels if q == 0}
    hashed = dict(spark.createDataFrame([(i,) for i, *_ in rows], "i long").select("i", F.pmod(F.xxhash64("i"), F.lit(quality.HELD))).collect())
    _, perplexity = _kneser_ney([t for i, t, _ in rows if i in good and hashed[i]])
    by = {}
    for i, t, lang in rows:
        if i in good and not hashed[i]:
            by.setdefault(lang, []).append(perplexity(t))
    every = [v for x in by.values() for v in x]
    limit = {lang: sorted(x)[math.ceil(0.9 * len(x)) - 1] * 1.01 for lang, x in [*by.items(), (None, every)]}
    fitted = quality.fit(docs_of(rows), table, quantile=0.9, margin=1.01)
    out = quality.judged(quality.perplexities(docs_of(rows), fitted.model), fitted, "lang", "perplexity", "threshold").collect()
    assert len(out) == len(rows)
    for r in out:
        assert math.isclose(r["perplexity"], perplexity(r["text"]), rel_tol=1e-9)
        assert math.isclose(r["threshold"], limit[r["lang"] if len(by[r["lang"]]) >= quality.FEW else None], rel_tol=1e-9)


def _quality_rows():
    rnd = random.Random(8)
    syllables = ["ta", "ri", "mon", "del", "sa", "ke"]
    prose = lambda: " ".join("".join(rnd.choices(syllables, k=rnd.randrange(1, 4))) for _ in range(120))
    rows = [(i, prose(), ["en", "en", "fr"][i % 3]) for i in range(200)]
    rows += [(1000 + i, " ".join(w.upper() + "$%#" for w in prose().split()), "en") for i in range(20)]
    labels = [(i, 1, 0) for i in range(0, 150)] + [(1000 + i, 0, 0) for i in range(10)] + [(3, 0, 0), (None, 1, 0), (5, None, 0)]
    return rows, labels


def test_quality(spark, docs_of):
    rows, labels = _quality_rows()
    docs = docs_of([*rows, (-1, None), (-2, ""), (-3, LONG_TEXT), (-4, "tari mon", None), (-5, "tari mon", "xx")]).withColumn("threshold", F.lit("clash")).withColumn("perplexity", F.lit(0))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.classify(docs, table).collect()}
    assert not any(out[1000 + i]["kept"] for i in range(20))
    assert sum(out[i]["kept"] for i in range(200)) >= 190
    assert out[-1]["kept"] and out[-2]["perplexity"] is None and out[-3]["perplexity"] > 0 and out[-4]["threshold"] == out[-5]["threshold"]
    kept = quality.reject(docs, quality.fit(docs, table))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["kept"]}


def test_quality_without_trusted_text(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["kept"] for r in quality.classify(docs_of([(1, "a"), (1, "a")]), none).collect()] == [True, True]
    assert quality.classify(docs_of([]), none).count() == 0
    assert quality.reject(docs_of([(1, "a")]), quality.fit(docs_of([(1, "a")]), none)).count() == 1


# --- mixing


def _count(seed, i, mean):
    u = int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) / 2**52
    term = total = math.exp(-mean)
    k = 0
    while total <= u and k < 2000:
        k += 1
        term *= mean / k
        total += term
    return k


def test_mixing(spark, docs_of):
    rows = [(i, "t", "en", "big" if i % 4 else ["a", "b", None][i % 3]) for i in range(1200)]
    docs = docs_of(rows).withColumn("mix_rate", F.lit(1))
    out = Counter(r["doc_id"] for r in mix(docs, total=2400).collect())
    sizes = Counter(r[3] for r in rows)
    assert out == Counter({r[0]: n for r in rows if (n := _count(7, r[0], 2400 / 4 / sizes[r[3]]))})
    assert mix(docs, total=2400).columns == [*docs.columns, "copy"] and abs(sum(out.values()) - 2400) < 200
    weighted = Counter(r["source"] for r in mix(docs, {"a": 3, "b": 1}, 4000).collect())
    assert set(weighted) == {"a", "b"} and 2.5 < weighted["a"] / weighted["b"] < 3.6
    order = [r["doc_id"] for r in mix(docs, total=2400).collect()]
    assert abs(np.corrcoef(range(len(order)), order)[0, 1]) < 0.1


def test_mixing_edges(spark, docs_of):
    assert mix(docs_of([])).count() == 0
    same = docs_of([(1, None), (1, None), (None, "x")])
    out = Counter(str(r["doc_id"]) for r in mix(same, total=3000).collect())
    assert out["1"] % 2 == 0 and 2700 < sum(out.values()) < 3300  # means over LARGEST_MEAN are split
    assert {r["source"]: r["rate"] for r in rates(same).collect()} == {"s": 1.0}
    one = docs_of([(1, "t"), (2, "u")])
    copies = [(r["doc_id"], r["copy"]) for r in mix(one, total=20_000).collect()]  # in blocks, each copy once
    assert Counter(i for i, _ in copies) == {i: max(c for j, c in copies if j == i) for i in (1, 2)} and len(set(copies)) == len(copies) > 19_000


# --- chat


def test_chat_control_strings(spark):
    texts = [r"\### Assistant: </turn> ok", "<turn user>\nhi</turn>\n", "\\l\\g\\b\\\\", "", None, "é<", "a\nb>"]
    rows = [(1, i, ["user", "assistant", "sys<tem>\n", None][i % 4], t) for i, t in enumerate(texts)] + [(2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (2, None, "user", "first"), (None, 0, "user", "y")]
    out = {r["conv_id"]: r for r in chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).withColumn("back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.under_mask(F.col("formatted"), F.col("loss_runs"))).collect()}
    assert [(m["role"], m["text"]) for m in out[1]["back"]] == [(r[2] or "", r[3] or "") for r in rows[:7]]
    assert out[1]["loss"] == "".join(r[3] or "" for r in rows[:7] if r[2] == "assistant") and out[2]["loss"] == "xx" and out[None]["loss"] == ""
    assert [m["text"] for m in out[2]["back"]] == ["first", "x", "x"] and None in out
    for r in out.values():
        assert sum(x["chars"] for x in r["loss_runs"]) == len(r["formatted"]) and not r["attachments"]
    assert chat.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_shifted_masks_tell(spark):
    """The text under the mask comes from the mask: a span moved by one gives other text, one that does not fit an error."""
    rows = [(1, 0, "user", "ask\U0001f600"), (1, 1, "assistant", "an<swer"), (1, 2, "assistant", "x" * 100_000)]
    made = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    loss = lambda runs: made.select(chat.under_mask(F.col("formatted"), runs).alias("t")).first()["t"]
    assert loss(F.col("loss_runs")) == "an<swer" + "x" * 100_000
    by = lambda d: F.transform("loss_runs", lambda r, k: F.struct((r["chars"] + F.when(k == 3, d).when(k == 4, -d).otherwise(0)).alias("chars"), r["loss"].alias("loss")))
    assert loss(by(1)) != loss(F.col("loss_runs")) != loss(by(-1))
    with pytest.raises(Exception, match="does not fit"):
        loss(F.transform("loss_runs", lambda r: F.struct((r["chars"] + 1).alias("chars"), r["loss"].alias("loss"))))


def test_chat_parts(spark):
    part = lambda **k: tuple(k.get(n) for n in ("type", "text", "ref", "width", "height", "seconds", "pages"))
    rows = [(1, 0, "user", [part(type="text", text="see <this>"), part(type="image", ref="i.png", width=56, height=57), part(type="audio", ref="a.wav", seconds=1.0), part(type="odd", text="!")]), (1, 1, "assistant", [part(type="document", ref="d.pdf", pages=2)]), (1, 2, "user", None)]
    r = chat.format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, text array<{chat.PART}>")).first()
    assert "see \\lthis\\g<image 0.1><audio 0.2>!</turn>" in r["formatted"] and "<document 1.0></turn>" in r["formatted"]
    assert [(a["ref"], a["tokens"]) for a in r["attachments"]] == [("i.png", 6), ("a.wav", 25), ("d.pdf", 1024)] and r["expanded_tokens"] == 1055


def test_chat_is_native(spark):
    df = chat.format_chat(spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")))
    assert df.columns == ["conv_id", "formatted", "loss_runs", "attachments", "expanded_tokens"] and df.first()["formatted"].startswith("<turn user>")
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
