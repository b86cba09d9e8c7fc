"""The pipeline's near-duplicates against brute force over all pairs."""

import random

import numpy as np

from changeflow.llm import common, shingles


def _set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _groups(rows):
    sets = [_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    return group


def _rows():
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefgh", k=4)) for _ in range(3000)]
    texts = []
    for k in range(40):
        base = rnd.choices(words, k=rnd.randrange(20, 200))
        texts.append(" ".join(base))
        for edits in (1, 1, 2, 3, len(base) // 40):  # similarities on both sides of 0.8
            near = base.copy()
            for at in rnd.sample(range(len(base)), edits):
                near[at] = rnd.choice(words)
            texts.append(" ".join(near))
    hub = rnd.choices(words, k=100)
    for k in range(60):  # each near the hub, most not near each other
        texts.append(" ".join(hub[: 2 * (k % 7)] + hub[2 * (k % 7) + 1 :]) + f" tail{k} " + " ".join(rnd.choices(words, k=4)))
    rnd.shuffle(texts)
    return [(1000 - i, t) for i, t in enumerate(texts)] + [(1, None), (2, ""), (3, "one two"), (4, "One  two")]


def test_every_similar_pair_is_found(spark, docs_of, monkeypatch):
    rows = _rows()
    group = _groups(rows)
    expected = {min(i for (i, _), g in zip(rows, group) if g == own) for own in set(group)}
    for hot in (shingles.HOT, 3):
        monkeypatch.setattr(shingles, "HOT", hot)
        assert {r["doc_id"] for r in shingles.keep_one(docs_of(rows)).collect()} == expected
    assert len(expected) < len(rows) / 2


def test_texts_under_one_id_both_stay(spark, docs_of):
    a, b = ("zeta beta gamma delta " * 3).strip(), "quite another text that stands under the same id"
    out = shingles.keep_one(docs_of([(3, b), (5, b), (5, a), (5, a), (None, a)]))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == sorted([(3, b), (5, a), (0, a)])
    assert shingles.keep_one(docs_of([])).count() == 0


def test_the_index_of_fingerprints_links_most_pairs(spark, docs_of, monkeypatch):
    """Without the bands: SimHash alone finds near copies, and no pair that the sets do not confirm."""
    rows = _rows()
    group = _groups(rows)
    monkeypatch.setattr(shingles, "bands", lambda found: np.empty(0, np.int64))
    for crowd in (shingles.CROWD, 5):
        monkeypatch.setattr(shingles, "CROWD", crowd)
        kept = {r["doc_id"] for r in shingles.keep_one(docs_of(rows)).collect()}
        expected = {min(i for (i, _), g in zip(rows, group) if g == own) for own in set(group)}
        assert expected <= kept
        if crowd > 5:
            assert len(rows) - len(kept) > 0.7 * (len(rows) - len(expected))


def test_sketches_refute_no_similar_pair():
    rnd, sets, pairs = np.random.default_rng(3), [], []
    for size in (1, 5, 9, 90, 250, 257, 1030, 5000):
        for share in np.r_[0.5:1:12j, 0.8]:
            both = round(size * share)
            a, b = rnd.integers(0, 2**64, (2, size), np.uint64)
            b[:both] = a[:both]
            cut = round(size * 0.8)  # a subset at a similarity of 0.8, or nearly so
            pairs += [(len(sets), len(sets) + 1), (len(sets), len(sets) + 2)]
            sets += [np.unique(a), np.unique(b), np.unique(a[:cut])]
    left, right = np.array(pairs).T
    sketches = np.array([shingles.sketch(s) for s in sets], object)
    on = shingles.possible(left, right, np.array([len(s) for s in sets], np.int32), sketches, 0.8)
    both = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in pairs])
    union = np.array([len(sets[i]) + len(sets[j]) for i, j in pairs]) - both
    assert on[both >= 0.8 * union].all() and (both == 0.8 * union).any()
    assert not on[both < 0.6 * union].any()


def test_a_group_of_unlike_copies_sends_few_pairs_to_the_sets(spark, docs_of, monkeypatch):
    """Texts of one base, each pair of which shares bands and is not similar enough."""
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefgh", k=4)) for _ in range(3000)]
    base, rows = rnd.choices(words, k=150), []
    for k in range(150):
        text = base.copy()
        for at in rnd.sample(range(150), 7):
            text[at] = rnd.choice(words)
        rows.append((k, " ".join(text)))
    sent, links_of = [], shingles.links_of
    monkeypatch.setattr(shingles, "links_of", lambda met, *more: sent.append(met.distinct().count()) or links_of(met, *more))
    group = _groups(rows)
    assert {r["doc_id"] for r in shingles.keep_one(docs_of(rows)).collect()} == {min(i for (i, _), g in zip(rows, group) if g == own) for own in set(group)}
    assert len(set(group)) > 100 and sum(sent) < 3 * len(rows), sent


def test_a_worker_lets_go_of_another_operators_state():
    common.worker_state("one", lambda: 1)
    common.leave_state()
    assert common.worker_state("one", lambda: 2) == 2
    common.leave_state()
