import re

import pytest
from pyspark.sql import functions as F

from changeflow.functions.mask import mask
from changeflow.functions.regex import UnsupportedPattern, compile_rule
from changeflow.operators.routing import Route, Router
from changeflow.operators.rules import MaskRule, RegexRule, RuleEngine
from changeflow.sources.snapshot import snapshot


def _replace(spark, text, pattern, template):
    p, r = compile_rule(pattern, template)
    return spark.createDataFrame([(text,)], "v string").select(F.regexp_replace("v", F.lit(p), F.lit(r))).first()[0]


@pytest.mark.parametrize(
    "text,pattern,template,expected",
    [
        ("user@example.com", r"@example\.com$", "@masked.com", "user@masked.com"),
        ("user@example.com\n", r"@example\.com$", "@masked.com", "user@example.com\n"),
        ("1234567890", r"(\d{3})(\d{3})(\d{4})", "($1) $2-$3", "(123) 456-7890"),
        ("a\rb\nc", "a.b", "x", "x\nc"),
        ("ab", "(a)(b)", "$2$1", "ba"),
        ("ab", "(a)(b)", "$1x", ""),
        ("ab", "(a)(b)", "${1}x", "ax"),
        ("ab", "(?P<first>a)", "<$first>", "<a>b"),
        ("ab", "a", "$$", "$b"),
        ("ab", "a", "\\1", "\\1b"),
        ("a\x0bb", r"\s", "_", "a\x0bb"),
        ("x[y]&&z", "[[&]", "_", "x_y]__z"),
        ("Ab", "(?i)aB", "x", "x"),
        ("é1", r"\w", "x", "éx"),
        ("a b", r"\bb", "x", "a x"),
        ("a\nb", "(?m)a$", "x", "x\nb"),
        ("ab12", "[[:alpha:]]+", "x", "x12"),
        ("a{b}", "{b}", "x", "ax"),
    ],
)
def test_dialect(spark, text, pattern, template, expected):
    assert _replace(spark, text, pattern, template) == expected


def _by_the_rule(pattern, text, new):
    """Replacing as the dialect does: the preferred match from each place on, but no empty one where the last one ended."""
    out, at, copied, last = [], 0, 0, -1
    while at <= len(text) and (m := re.compile(pattern).search(text, at)):
        out.append(text[copied : m.start()])
        if m.end() > last or m.start() == 0:
            out.append(new)
        copied = last = m.end()
        at = max(m.end(), at + 1)
    return "".join(out) + text[copied:]


def test_empty_matches(spark):
    texts = ["", "a", "b", "aab", "baab", "xaabbax", "ab12", "123", "a1b22", "  a b ", "aé1"]
    patterns = ["a*", "[a-z]*", "a?", "(a|)", "(|a)", "a??", "a*?", "(a|b)*", r"\d*", "x?a*", "(?:ab)*", "a*|b", "b|a*", "a??b|", "(a*)(b*)", "(a??)(b??)"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    made = [compile_rule(p, "<>") for p in patterns]
    for r in rows.select("v", *[F.regexp_replace("v", F.lit(p), F.lit(t)).alias(f"r{k}") for k, (p, t) in enumerate(made)]).collect():
        for k, p in enumerate(patterns):
            assert r[f"r{k}"] == _by_the_rule(p, r["v"], "<>"), (p, r["v"])
    assert [_replace(spark, "ab é", p, "-") for p in ("[[:alpha:]]*", r"\pL?", r"^a*", r"\b")] == ["- -é-", "-- -", "-b é", "-ab- é"]


@pytest.mark.parametrize("pattern", ["(?=a)", "(?<!a)b", r"(a)\1", "a++", "a*+", "(?>a)", "(", "a)", "[", r"\Z", r"\k<a>"])
def test_refused(pattern):
    with pytest.raises(UnsupportedPattern):
        compile_rule(pattern, "")


def _mask(text, sign):
    raw = text.encode()
    return text if len(raw) <= 2 else bytes([raw[0]]).decode("latin-1") + sign * (len(raw) - 2) + bytes([raw[-1]]).decode("latin-1")


@pytest.mark.parametrize("text", ["", "a", "12", "123", "1234567890123456", "é€x", "é", "aé", "日本"])
@pytest.mark.parametrize("sign", ["*", "xo"])
def test_mask_counts_bytes(spark, text, sign):
    assert spark.createDataFrame([(text,)], "v string").select(mask(F.col("v"), sign)).first()[0] == _mask(text, sign)


def test_golden_users(spark):
    rows = [(1, "john@example.com", "1234567890", 25, "123-45-6789"), (2, "jane@example.com", "9876543210", 17, "987-65-4321"), (3, "bob@example.com", "5551234567", 30, "555-12-3456")]
    users = spark.createDataFrame(rows, "id int, email string, phone string, age int, ssn string")
    engine = RuleEngine(
        {
            "users": [
                {"type": "transform", "column": "email", "parameters": {"type": "mask", "mask_char": "*"}},
                {"type": "transform", "column": "phone", "parameters": {"type": "regex", "pattern": r"^(\d{3})(\d{3})(\d{4})$", "replace": "($1) $2-$3"}},
                {"type": "filter", "column": "age", "parameters": {"operator": "gte", "value": 18, "allow_empty_deletes": True}},
                {"type": "transform", "column": "ssn", "parameters": {"type": "mask", "mask_char": "X"}},
            ]
        }
    )
    out = {r["id"]: r for r in engine.apply(snapshot(users, "users"), "users").select("new.*").collect()}
    assert sorted(out) == [1, 3]
    assert out[1]["email"] == "j**************m" and out[1]["phone"] == "(123) 456-7890" and out[1]["ssn"] == "1XXXXXXXXX9"
    # Another table has no rules.
    assert engine.apply(snapshot(users, "others"), "others").count() == 3


def test_deletes(spark):
    row = "struct<id:int,name:string,n:int>"
    c = spark.createDataFrame([(1, "DELETE", None, (1, "secret", 5)), (2, "UPDATE", (1, "secret", 5), None)], f"_seq long, _op string, new {row}, old {row}")
    masked = {r["_seq"]: r for r in MaskRule("name", "*").apply(c).collect()}
    assert masked[1]["old"]["name"] == "s****t" and masked[1]["new"] is None and masked[2]["new"]["name"] == "s****t"
    kept = {r["_seq"]: r for r in MaskRule("name", "*", allow_empty_deletes=True).apply(c).collect()}
    assert kept[1]["old"]["name"] == "secret"
    replaced = {r["_seq"]: r for r in RegexRule("name", "s", "S").apply(c).collect()}
    assert replaced[1]["old"]["name"] == "secret" and replaced[2]["new"]["name"] == "Secret"
    assert MaskRule("n", "*").apply(c).columns == c.columns


def test_routing(spark):
    rows = spark.createDataFrame([(1, "a", 2.0)], "id long, username string, total double")
    from changeflow import model

    changes = snapshot(rows, "users", model.ReplicationKey(model.PRIMARY_KEY, ("id",)))
    router = Router({"users": {"destination_table": "customers", "column_mappings": [{"source": "id", "destination": "customer_id"}, {"source": "username", "destination": ""}]}})
    r = router.apply(changes, "users").first()
    assert r["_table"] == "customers" and r["new"].asDict() == {"customer_id": 1, "username": "a", "total": 2.0}
    assert r["_key"]["columns"] == ["customer_id"] and r["old"] is None
    full = router.apply(snapshot(rows, "users"), "users").first()
    assert full["_key"]["type"] == "FULL" and full["_key"]["columns"] == []
    assert router.apply(changes, "orders").first()["_table"] == "users"
    router.add(Route("users", "", operations=()))
    assert router.apply(changes, "users").count() == 0
    assert re.match("users", router.destination("users"))
