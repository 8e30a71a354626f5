import random
import re

from pyspark.sql import functions as F

from recordloom.llm.secrets import RULES, Rule, find_secrets, redact, span_text
from recordloom.llm.trigram_queries import trigram_query
from tests.llm.edges import EDGE_TEXTS, documents, empty


def brute(text):
    spans = []
    for place, rule in enumerate(RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                spans.append((m.start(), place, m.end()))
    return ",".join(f"{RULES[p].kind}:{s}:{e}" for s, p, e in sorted(spans))


def run(spark, rows):
    found = find_secrets(documents(spark, rows)).select("doc_id", span_text(F.col("secret_spans")).alias("s"))
    return sorted((repr(r["doc_id"]), r["s"]) for r in found.collect())


PLANTED = [
    (20, 'é password = "abcDEF123456" and token:short and AKIAABCDEFGHIJKLMN'), (21, "PassWd:'aaaaaaaaaaaa' deadbeefdeadbeef0"),
    (22, "token=secret: abcdefghijklmnop"), (23, "token=secret=abcdefghijklmnop api-key=000000000000 apikey=000000000000"),
    (24, "AKIAAKIA12 AKIAAKIA1234567890 akiaabcdefghijklmn"), (25, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18),
    (26, "xoxb-1234567890-abc secret=" + "f" * 40), (27, "K token=aaaaaaaaaaaaa paſſword=aaaaaaaaaaaaa"), (28, "a" * 16 + "g" + "b" * 15),
]


def test_planted_and_edges(spark):
    rows = PLANTED + EDGE_TEXTS + PLANTED[:2]
    assert run(spark, rows) == sorted((repr(i), brute(t)) for i, t in rows)


def test_random_texts(spark):
    rng = random.Random(4)
    parts = ["token", "secret", "api_key", "=", ":", ' "', "'", " ", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "é", "x", "\n", "."]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(25)))) for i in range(400)]
    assert run(spark, rows) == sorted((repr(i), brute(t)) for i, t in rows)


def test_empty(spark):
    assert find_secrets(empty(documents(spark))).count() == 0


def test_other_columns_stay(spark):
    docs = documents(spark, PLANTED).drop("secret_spans", "_s_key", "_s_text")
    assert find_secrets(docs).columns == [*docs.columns, "secret_spans"]


def test_no_indexed_rule(spark):
    assert find_secrets(documents(spark, PLANTED), [Rule("hex", "[0-9a-f]+", 0, 16)]).count() == len(PLANTED)


def holds(query, text):
    if query is True:
        return True
    if isinstance(query, str):
        return query in text
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1:])


def test_queries_hold_for_every_match():
    rng = random.Random(8)
    patterns = [r.pattern for r in RULES] + ["ab(cd|ef)?gh", "x(yz)+w", "(abc|de)f{2,3}g", "a.cde", "^abc$", "(?:)", "[a-c]de", "a*bcd"]
    alphabet = "abcdefghwxyz _-=:'\"AKI0123456789"
    for pattern in patterns:
        query = trigram_query(pattern)
        for _ in range(300):
            text = "".join(rng.choice(alphabet) for _ in range(30))
            for sample in (text, "password=" + text, "abcdfffg xyzyzw abghcd", "ghp_" + "a" * 40, "AKIA" + "Z" * 20, "xoxb-" + "a" * 12):
                if re.search(pattern, sample):
                    assert holds(query, sample.lower()), (pattern, sample)
    assert trigram_query("[0-9a-f]+") is True and trigram_query(r"AKIA[A-Z0-9]+") == ("and", "aki", "kia")


def test_redaction(spark):
    found = find_secrets(documents(spark, [(1, "x token=aaaaaaaaaaaaaaaaaaaaaaaaaaaa y"), (2, "é AKIAABCDEFGHIJKLMNO z"), (3, None), (4, "clean")]))
    texts = {r["doc_id"]: r["t"] for r in found.select("doc_id", redact(F.col("text"), F.col("secret_spans")).alias("t")).collect()}
    assert texts == {1: "x [SECRET] y", 2: "é [SECRET] z", 3: None, 4: "clean"}
