"""Main text of pages: the markup, the suffix array and the whole operator against brute force."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import html

NOTICE = "we use small files to keep this site running well for all of you"


@pytest.mark.parametrize(
    "page,main,other",
    [
        ("<nav>m</nav><article><h1>T &amp; U</h1><p>a<b>b</b>  c<p>d</article><footer>f</footer>", [["T", "&", "U"], ["ab", "c"], ["d"]], [["m"], ["f"]]),
        ("<article>x<div class='ad'>buy</div><aside>s</aside><section id=comments>c</section>y</article>", [["x"], ["y"]], [["buy"], ["s"], ["c"]]),
        ("<script>var t='</p><article>';</script><p>a<p>b <!-- <p>c --> d", [], [["a"], ["b", "d"]]),
        ("<div class=cookie-notice>n</div><form>f</form><div class=has-sidebar>k</div>", [], [["k"]]),
        ("1 < 2 &lt;b&gt; &unknown; &#233;", [], [["1", "<", "2", "<b>", "&unknown;", "é"]]),
        ("<p title=\"a>b\">t</p><p title=\"open>u</p>", [], [["t"], ["u"]]),
        ("<!-- open <p>x", [], []),
        ("<div role=main>m<p>n</div><div itemprop='articleBody'>o</div>p", [["m"], ["n"], ["o"]], [["p"]]),
        ("<article>a<article class='comment odd'>c</article></article><article class='post hentry'>b</article>", [["a"], ["b"]], [["c"]]),
        (None, [], []),
        ("<b>" * 3000 + "deep" + "</i>" * 3000, [], [["deep"]]),
        # End tags that may be left out end what they should, so that a mark bans its own element only.
        ('<article><p class="ad">buy<p>real text</article>', [["real", "text"]], [["buy"]]),
        ('<article><ul><li class="promo">x<li>real item</ul></article>', [["real", "item"]], [["x"]]),
        ("<article><p class=notice>n<div>real</div></article>", [["real"]], [["n"]]),
        ("<article><dl><dt class=ad>a<dd>b<dt>c</dl><table><tr><td class=ad>x<td>y<tr><td>z</table>w</article>", [["b"], ["c"], ["y"], ["z"], ["w"]], [["a"], ["x"]]),
        ("<article><ul><li>a<ul><li class=ad>b</ul>c<li>d</ul></article>", [["a"], ["c"], ["d"]], [["b"]]),
        ('<article><div class="social-history">real words</div><div class="ad-slot top">buy</div></article>', [["real", "words"]], [["buy"]]),
        ("<article>a<span class=ad>x</span>b<p>c</div>d</article>", [["a"], ["b"], ["c"], ["d"]], [["x"]]),
        ("<article>a<table><tr><td>b</div></article>c</td></table>d</article>e", [["a"], ["b"], ["c"], ["d"]], [["e"]]),
        ("<article><h1>t<h2 class=ad>u<h3>v</article>", [["t"], ["v"]], [["u"]]),
    ],
)
def test_blocks(page, main, other):
    own, kinds, rest = html.split_page(page)
    assert (own if main else []) == main and all(k <= html.WEAK_CORE for k in kinds) == (not own or bool(main))
    assert (rest if main else own) == other


@pytest.mark.parametrize(
    "page,main",
    [
        # The article of a page stands in a form, in a marked wrapper, or is a card itself.
        ("<form id=f><header>h</header><main><article><p>all of it</article></main><footer>f</footer></form>", [["all", "of", "it"]]),
        ('<div class="search-page"><article>found words</article></div>', [["found", "words"]]),
        ('<div class="banner-page"><nav>n</nav><article>words</article></div>after', [["words"]]),
        ('<div id="sidebar-wrapper"><main>main words<div class=ad>buy</div></main></div>', [["main", "words"]]),
        ('<article class="card">card words</article>', [["card", "words"]]),
        ("<form><p>only this</form>", [["only", "this"]]),
        # But not where the page has an article of its own, nor out of what holds no main text.
        ('<article>own words</article><div class="related-list"><article class="card">other</article></div>', [["own", "words"]]),
        ('<div>the page is here</div><div class="related-list"><article>other</article></div>', [["the", "page", "is", "here"]]),
        ("<p>text</p><aside><article>other</article></aside><nav><main>n</main></nav>", [["text"]]),
        ("<article>a<form><main>inner</main></form>b</article>", [["a"], ["b"]]),
        # Evidence inside an article: something to press, cells and inline words, code.
        ('<article><table><tr><td class="share">12%<td class=ad>x</table></article>', [["12%"]]),
        ('<article><div class="share-block">Share price table</div><div class="share-block">Share: <a href=x>here</a></div></article>', [["Share", "price", "table"]]),
        ('<article><div class=menu>soup, bread</div><div class=menu><a href=x>home</a></div></article>', [["soup,", "bread"]]),
        ('<article><pre><span class="comment"># c</span> x = 1</pre><code><div class="ad header">y</div></code></article>', [["#", "c", "x", "=", "1"], ["y"]]),
        ('<article>see <span class="alert">this</span> word<span class="ad">x</span></article>', [["see", "this", "word"]]),
        ('<article>t<div class="comment-list"><p>nice</div><section class="comments">c</section></article>', [["t"]]),
    ],
)
def test_wrappers_and_evidence(page, main):
    assert html.split_page(page)[0] == main


def test_very_long_and_deep_pages():
    words = " ".join(f"w{k}" for k in range(200_000))
    own, _, _ = html.split_page(f"<article><p>{words}</article>")
    assert len(own) == 1 and len(own[0]) == 200_000
    page = "<article><table><tr><td>" + "<b>" * 50_000 + "<div>x</div>" * 50_000
    assert len(html.split_page(page)[0]) == 50_000


def test_suffix_array_by_brute_force():
    rnd = np.random.default_rng(5)
    for n in (1, 2, 3, 40, 200):
        tokens = np.r_[rnd.integers(0, 2, n - 1), 9].astype(np.int64)
        order, common = html.suffix_array(tokens)
        suffixes = sorted(range(n), key=lambda i: tokens[i:].tolist())
        assert order.tolist() == suffixes
        for k in range(1, n):
            a, b = tokens[suffixes[k - 1] :], tokens[suffixes[k] :]
            m = min(len(a), len(b))
            assert common[k] == (int(np.argmax(a[:m] != b[:m])) if (a[:m] != b[:m]).any() else m)


@pytest.mark.parametrize("least", [2, 3])
def test_repeats_by_brute_force(least):
    rnd = np.random.default_rng(3)
    for _ in range(30):
        page = np.sort(rnd.integers(0, 5, 150))
        ends = np.flatnonzero(np.diff(page, append=-1))
        tokens = rnd.integers(0, 2, 150).astype(np.int64)
        tokens[ends] = 100 + np.arange(len(ends))
        counts = rnd.random(150) < 0.8
        owner = page // 2 if least == 2 else page
        order, common = html.suffix_array(tokens)
        got = html.repeats(order, common, owner, counts, least, long=3)
        owners = {}
        for i in np.flatnonzero(counts):
            for n in range(3, 151 - i):
                owners.setdefault(tuple(tokens[i : i + n]), set()).add(owner[i])
        for i in range(150):
            best = max((n for n in range(3, 151 - i) if len(owners.get(tuple(tokens[i : i + n]), ())) >= least), default=0) if counts[i] else 0
            assert got[i] == best


def _plain(pages, shard):
    """The texts of (key, host, html) rows that differ, by sets and counting."""
    read = {k: (h, *html.split_page(p)) for k, h, p in pages}
    out = {}
    kin = {k: html.kin_of(html.word_hashes(own), k) for k, (_, own, _, _) in read.items()}
    for host in {h for h, *_ in read.values()}:
        there = [k for k, r in read.items() if r[0] == host]
        shards = max(1, -(-sum(len(p or "") for k, h, p in pages if h == host) // shard))
        parts = [[k for k in there if k % shards == n] for n in range(shards)]
        stands, windows, votes = {}, {}, {}
        for part in parts:
            own = {}
            for k in part:
                for words in read[k][1] if (read[k][2] or [9])[0] <= html.WEAK_CORE else []:
                    own.setdefault(tuple(words), set()).add(kin[k])
            for words, on in own.items():
                votes[words] = votes.get(words, 0) + (len(on) >= max(html.NOTICE, len({kin[k] for k in part if (read[k][2] or [9])[0] <= html.WEAK_CORE}) // 2 + 1))

        def streams(k):
            _, own, kinds, rest = read[k]
            return [*own, *rest], [*kinds, *[html.EVIDENCE] * len(rest)]

        def spans(k):
            """Runs of the stream outside the article's core, as ((block, word) or end marks, words)."""
            run = []
            for b, (words, kind) in enumerate(zip(*streams(k))):
                if kind == html.CORE:
                    yield run
                    run = []
                else:
                    run += [(b, i, w) for i, w in enumerate(words)] + [(b, -1, None)]
            yield run

        for k in there:
            for words, kind in zip(*streams(k)):
                if kind == html.CORE:
                    continue
                stands.setdefault(tuple(words), set()).add(kin[k])
            for run in spans(k):
                for i in range(len(run) - html.LONG + 1):
                    windows.setdefault(tuple(w for _, _, w in run[i : i + html.LONG]), set()).add(kin[k])
        for k in there:
            _, own, kinds, _ = read[k]
            hit = set()
            for run in spans(k):
                for i in range(len(run) - html.LONG + 1):
                    if len(windows[tuple(w for _, _, w in run[i : i + html.LONG])]) >= html.SPREAD:
                        hit |= {(b, i) for b, i, _ in run[i : i + html.LONG]}
            n = [len(stands.get(tuple(w), ())) for w in own]
            weak = [kind in (html.WEAK_CORE, html.WEAK_OPEN) and (m >= html.SPREAD or all((b, i) in hit for i in range(len(own[b])))) for b, (kind, m) in enumerate(zip(kinds, n))]
            if own and kinds[0] <= html.WEAK_CORE:
                notice = [2 * votes.get(tuple(w), 0) > sum(map(bool, parts)) for w in own]
                core = [b for b in range(len(own)) if not weak[b] and not notice[b]]
                gone = [weak[b] or bool(core) and not core[0] <= b <= core[-1] for b in range(len(own))]
                out[k] = " ".join(" ".join(w) for w, g in zip(own, gone) if not g)
            else:
                gone = {(b, i) for b, words in enumerate(own) for i in range(len(words)) if weak[b] or (b, i) in hit}
                if 2 * len(gone) > sum(map(len, own)):
                    gone = {(b, i) for b, words in enumerate(own) for i in range(len(words)) if weak[b]}
                out[k] = " ".join(w for b, words in enumerate(own) for i, w in enumerate(words) if (b, i) not in gone)
    return out


def _site(seed, n=40):
    """Pages with and without articles, with notices, weak marks, quotes and copies."""
    rnd = random.Random(seed)
    prose = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=5)) for _ in range(n))
    quote, pages = prose(60), []
    for i in range(n):
        body = f"<h1>{prose(4)}</h1><p>{prose(30)}"
        if i % 4 == 0:
            body += f"<p>{quote}"
        body += f'<div class="share-counter">{"tell all friends of this story" if i % 3 else prose(5)}</div><p>{prose(20)}'
        if i % 5:
            body += "<p>sign up here for more"
        body = f"<article>{body}</article>" if i % 3 else f"<div>{body}</div>"
        pages.append((i, f"http://h{i % 4 // 2}.example/{i}", f"<nav>home {prose(2)}</nav>{body}<p>{NOTICE}</p><footer>{NOTICE}</footer>"))
    copies = [(100 + i, "http://h0.example/x", pages[i][2]) for i in (0, 1)] + [(200, None, None), (201, None, ""), (202, "http://h1.example", "<article><p>sign up here for more</article>")]
    return pages + copies


@pytest.mark.parametrize("shard", [1 << 20, 10_000])
def test_main_text_by_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(html, "SHARD", shard)
    df = spark.createDataFrame(_site(4), "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))
    keyed = df.select("page_id", F.xxhash64("html", "url").alias("k"), "url", "html").collect()
    pages = {r["k"]: (r["k"], (r["url"] or "://").split("/")[2] if r["url"] else "", r["html"]) for r in keyed}
    expected = _plain([(k, h, p) for k, h, p in pages.values()], shard)
    out = {r["page_id"]: r["text"] for r in html.main_text(df).collect()}
    assert out == {r["page_id"]: expected[r["k"]] for r in keyed}
    alone = {r["page_id"]: r["text"] for r in html.main_text(df, array=False).collect()}
    article = [i for i in range(40) if i % 3]
    # The array takes weakly marked blocks and notices out of articles, and nothing else.
    assert all("tell all friends" in alone[i] and "tell all friends" not in out[i] for i in article)
    if shard == 10_000:
        return  # shards of few pages know no notices
    assert all("sign up here" in alone[i] and "sign up here" not in out[i] for i in article if i % 5)
    assert all(len(out[i].split()) >= 54 + 60 * (i % 4 == 0) for i in article)
    assert all(NOTICE not in out[i] for i in range(40) if i % 12) and out[200] == out[201] == "" and out[202] == "sign up here for more"


@pytest.mark.parametrize("shard", [1 << 20, 200])
def test_copies_and_quotes_keep_their_text(spark, monkeypatch, shard):
    monkeypatch.setattr(html, "SHARD", shard)
    rnd = random.Random(2)
    prose = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(n))
    story, quote, notice = prose(60), prose(12), prose(10)
    texts = [f"title{i} {story} date{i}" for i in range(5)]  # near copies of one article
    texts += [f"{prose(20)} {quote} {prose(20)}" for _ in range(2)]
    pages = [(i, f"http://h.example/{i}", f"<div>{t}</div><p>{notice}</p>") for i, t in enumerate(texts + [prose(40) for _ in range(4)])]
    out = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i, t in enumerate(texts):
        assert t in out[i]
    assert all(notice not in out[i] for i in range(5, 11))


def test_streams_leave_the_disk_before_the_output(spark):
    """Their shuffle files go with the checkpoint, whether or not the driver collects its garbage."""
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files, found = store.getAllFiles().iterator(), {}
        while files.hasNext():
            at = files.next()
            if at.getName().startswith("shuffle_"):
                found[at.getName()] = at.length()
        return found

    def more():
        return sum(size for name, size in shuffled().items() if name not in before)

    before = shuffled()
    words = [" ".join(f"w{k}x{i}" for i in range(400)) for k in range(60)]  # 96,000 bytes of hashes
    rows = [(k, f"http://h{k % 3}.org/{k}", f"<nav>menu {k}</nav><p>{words[k]}</p>") for k in range(60)]
    out = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    until = time.time() + 10
    while more() > 30_000 and time.time() < until:
        time.sleep(0.2)
    assert more() <= 30_000  # counts only
    assert sorted(r["text"] for r in out.collect()) == sorted(words)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_empty_table(spark):
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
