"""Operator 12: URL filters: rules by host and path, and a classifier where no rule fits.

Method: logistic regression (L2) on counts of hashed character n-grams of host and path, trained from a
small labelled URL table. The host is read with a dot before and a slash behind it, so that n-grams know
where a label begins and ends; digits are one character, since numbers in URLs name pages; n-grams of paths
are told from those of hosts. A URL is blocked if the probability reaches ``threshold``. The default table
has more harmless URLs than others, so that a host of unknown words passes.

Rules: ``host/path`` fits its host and all subdomains if the URL's path starts with the rule's path; the
longest rule that fits decides. Up to ``INLINE`` rules are an expression; a table of rules of any size is met
by equal keys: each URL's host suffixes, with as much of its path as some rule has characters, so no rule
host with very many paths is compared with its URLs one by one.

Distribution: parsing, n-grams, hashing and scoring are DataFrame functions and Spark's own models, one pass
without a shuffle; with a table of rules one join on keys more. Training reads the labelled table only; the
weights are ``1 << BITS`` numbers.

Defined results: the host goes from the first ``://`` to a slash, question mark, hash or the end, with A-Z
lower-cased (ports and user names are part of it, so rules do not fit such hosts); the path goes on to a
question mark, hash or the end. A null URL and one without ``://`` have an empty host and path, and are
judged like any other. Of rules of equal length the one that blocks wins; a host without a dot at its ends is
compared as it stands. Very long URLs are read whole; labels are 1 (block) and 0, null ones and null URLs of
the labelled table are left out, and a table without both labels gives the share of label 1 to all; repeated
rows come out as often; an empty table gives an empty table; other columns stay, and clash with nothing but
names given for the result.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import bound, fresh

#: Lengths of n-grams, bits of their hash, weight of the penalty.
SIZES, BITS, PENALTY = (3, 4, 5), 16, 0.002
INLINE = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The default labelled table: invented hosts of kinds that corpora leave out (betting, adult, advertising and
#: tracking, spam and link farms, medicine shops, fakes and loans, stolen software), and of harmless kinds, some
#: with words that look like the others. The rest of a host and the paths that tell nothing are dealt alike to both.
BLOCKED = """
casino-royale online-casino best-casino casinos casino bigwin-slots slots-online win-jackpot poker-room videopoker roulette-win bingo-bonus casino-bonus/bonus/spin
sports-bets bet-now free-bet betting-tips bets24 bets live-bets/bet/odds free-spins free-money win-prizes lottery-winner
ads adserver ads-network ad-click best-ads/popup tracker track-click clicktrack tracking-pixel ads-tracker popunder-ads banner-ads/banner/click track affiliate-track
spam spam-links link-farm content-farm/page/spam spam-blog spammers seo-links buy-backlinks linkfarm
cheap-viagra pills-online cheap-meds buy-pills/order/pills cheap pills diet-pills cheap-pharmacy cialis-shop
adult-videos adult xxx-tube/watch/xxx porn free-porn sex-cams adult-dating hot-xxx escort-adult porn-tube adult-cams
cheap-replica replica-watches fake-bags payday-loans fast-loans easy-cash crypto-doubler
warez/crack/keygen keygen-crack torrent-free cracked-apps malware-download phishing-login
"""
FINE = """
news daily-news weather the-times garden reading-room thinking nation national library university/courses/physics history museum theory
garden-notes recipes cooking travel mountains theatre the-other another there other weathers research station nature/birds/owls science mathematics
parliament council school children hospital sport/football/results football chess music film/reviews/cinema painting books poetry writing language
open-source/docs/install software python-notes data/sets code maps ocean forest farming/wheat farm-museum farmers housing building energy traffic trains
health/sleep medicine nursing fitness family election economy market-day bank-holiday work national-parks the-nation writers letters notes archive journal
magazine tools loading-bay readings roads shadow-play alphabet bettering better-reading window winter/snow twins winners-history clicking-beetles free-church freedom
cheapside-history essex-history sussex canada trade tradition adults-learning/courses/evening bettys-bakery pillow-shop spam-museum tracks-and-trails
thing therapy north south wheel rathaus kirche bibliothek musique ecole jardin escuela noticias playa
"""
BEFORE, AFTER, PATHS = ("", "www.", "m.", "blog."), (".example.com", ".example.net", ".example.org"), ("/en/1", "", "/de/2/", "/fr/3.html", "/", "/en/4?page=2", "/es/5#top")


def examples(spark: SparkSession) -> DataFrame:
    """The default labelled table: (url, label)."""
    rows = []
    for label, names in ((1, BLOCKED), (0, FINE)):
        for k, name in enumerate(names.split()):
            own, _, telling = name.partition("/")
            rows.append((f"https://{BEFORE[k % 4]}{own}{AFTER[k % 3]}{'/' + telling if telling else PATHS[k % 7]}", label))
    return spark.createDataFrame(rows, "url string, label int")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def grams(of_host: Column, of_path: Column, sizes: Iterable[int] = SIZES) -> Column:
    """The character n-grams of a host and a path, those of the path behind a blank."""

    def of_size(letters: Column, mark: str, size: int) -> Column:
        gram = lambda i: F.concat(F.lit(mark), *[F.coalesce(F.get(letters, i + k), F.lit("")) for k in range(size)])
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(letters) - size, F.lit(0))), gram)

    def cut(text: Column, mark: str) -> Column:
        return bound(text, lambda letters: F.flatten(F.array(*[of_size(letters, mark, size) for size in sizes])))

    # Characters are taken apart once: a place in a text is found by walking to it, one in an array at once.
    plain = [F.regexp_replace(F.translate(c, UPPER, LOWER), "[0-9]+", "0") for c in (of_host, of_path)]
    letters = [F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0)) for c in (F.concat(F.lit("."), plain[0], F.lit("/")), plain[1])]
    return F.concat(*[cut(text, mark) for text, mark in zip(letters, ("", " "))])


def fit(labelled: DataFrame, bits: int = BITS, penalty: float = PENALTY, url_col: str = "url", label_col: str = "label") -> PipelineModel | float:
    """The classifier of a table of URLs with labels 1 (block) and 0; the share of label 1 where one of the labels is missing."""
    known = labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull())
    share = known.agg(F.avg(F.when(F.col(label_col) > 0, 1.0).otherwise(0.0)).alias("share")).first()["share"] or 0.0
    if share in (0.0, 1.0):
        return share
    rows = known.select(grams(host(F.col(url_col)), path(F.col(url_col))).alias("grams"), F.when(F.col(label_col) > 0, 1.0).otherwise(0.0).alias("label"))
    counted = HashingTF(inputCol="grams", outputCol="features", numFeatures=1 << bits)
    # A small table: few tasks, and the same order of sums each time.
    return Pipeline(stages=[counted, LogisticRegression(regParam=penalty, standardization=False, maxIter=50, tol=1e-6)]).fit(rows.coalesce(1))


def _parts(rule: str) -> tuple[str, str]:
    """A rule's host, lower-cased, and its path with the slash that begins it."""
    own, slash, rest = rule.partition("/")
    return own.lower(), slash + rest


def by_expression(of_host: Column, of_path: Column, rules: dict[str, str]) -> Column:
    """The longest of the rules (by rule, ``allow`` or ``block``) that fits, as (rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules.items(), key=lambda r: (len(r[0]), r[1] == "block", r[0])):
        own, start = _parts(rule)
        fits = ((of_host == own) | of_host.endswith("." + own)) & of_path.startswith(start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def by_table(urls: DataFrame, host_col: str, path_col: str, rules: DataFrame, out: str) -> DataFrame:
    """``urls`` with the longest fitting rule of a table (rule, verdict) as a struct ``out``; each (host, path) is met once."""
    cut = F.instr("rule", "/")
    best = rules.where(F.col("rule").isNotNull() & F.col("verdict").isNotNull()).groupBy("rule").agg(F.max("verdict").alias("verdict"))  # block comes after allow
    if best.isEmpty():
        return urls.withColumn(out, F.lit(None).cast("struct<rule:string,verdict:string>"))
    split = best.select(
        F.translate(F.when(cut > 0, F.substr("rule", F.lit(1), cut - 1)).otherwise(F.col("rule")), UPPER, LOWER).alias("own"),
        F.when(cut > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise("").alias("start"),
        F.struct(F.length("rule").alias("size"), F.col("verdict"), F.col("rule")).alias("found"),
    )
    # The different lengths of paths: no more than the longest has characters.
    lengths = F.array(*[F.lit(r["n"]) for r in split.select(F.length("start").alias("n")).distinct().orderBy("n").collect()])
    pairs = urls.select(F.col(host_col).alias("h"), F.col(path_col).alias("p")).distinct()
    labels = F.split("h", r"\.")
    suffixes = bound(labels, lambda own: F.transform(F.sequence(F.lit(1), F.size(own)), lambda i: F.array_join(F.slice(own, i, F.size(own)), ".")))
    keys = pairs.select("h", "p", F.explode(suffixes).alias("own")).select("h", "p", "own", F.explode(F.filter(lengths, lambda n: n <= F.length("p"))).alias("n"))
    keys = keys.select("h", "p", "own", F.substr("p", F.lit(1), F.col("n")).alias("start"))
    met = keys.join(split, ["own", "start"]).groupBy("h", "p").agg(F.max("found").alias("f"))
    of_host, of_path = fresh([*urls.columns, out], "of_host"), fresh([*urls.columns, out], "of_path")
    named = met.select(F.col("h").alias(of_host), F.col("p").alias(of_path), F.struct(F.col("f.rule").alias("rule"), F.col("f.verdict").alias("verdict")).alias(out))
    return urls.join(named, (F.col(host_col) == F.col(of_host)) & (F.col(path_col) == F.col(of_path)), "left").drop(of_host, of_path)


def judge(urls: DataFrame, model: PipelineModel | float, rules: dict[str, str] | DataFrame | None = None, url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """``urls`` with host, path, rule (null if none fits), score (the probability of label 1) and verdict (``allow`` or ``block``)."""
    clash = {c.lower() for c in urls.columns} & {"host", "path", "rule", "score", "verdict"}
    if clash:
        raise ValueError(f"columns that the result has: {sorted(clash)}")
    names = list(urls.columns)
    h, p = F.col("host"), F.col("path")
    made = urls.withColumn("host", host(F.col(url_col))).withColumn("path", path(F.col(url_col)))
    found = fresh(made.columns, "found")
    if isinstance(rules, DataFrame):
        made = by_table(made, "host", "path", rules, found)
    elif len(rules or {}) <= INLINE:
        made = made.withColumn(found, by_expression(h, p, rules or {}))
    else:
        made = by_table(made, "host", "path", urls.sparkSession.createDataFrame(list(rules.items()), "rule string, verdict string"), found)
    # The model's columns have fixed names, so the rows go through it as one struct.
    whole = made.select(F.struct(*[F.col(f"`{c}`") for c in made.columns]).alias("row"), grams(h, p).alias("grams"))
    if isinstance(model, float):
        scored, score = whole, F.lit(model)
    else:
        scored, score = model.transform(whole), vector_to_array("probability")[1]
    rule = F.col(f"row.{found}")
    return scored.select(
        *[F.col(f"row.`{c}`").alias(c) for c in names],
        F.col("row.host").alias("host"),
        F.col("row.path").alias("path"),
        rule["rule"].alias("rule"),
        score.alias("score"),
        F.coalesce(rule["verdict"], F.when(score >= threshold, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
