"""WARC archives, mixing, neighbours, URL rules and chat formatting."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.llm import neighbours
from recordloom.llm.chat_format import Template, format_turns, read_back
from recordloom.llm.mixing import mix_sources
from recordloom.llm.neighbours import nearest
from recordloom.llm.url_rules import judge_urls
from recordloom.llm.warc import read_archive, record_bytes, write_archive
from tests.llm.edges import EDGE_TEXTS, LONG, documents, empty, with_clashes


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


# --- WARC


def pages_frame(spark, rows):
    return with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_archive_round_trip(spark):
    body = "é" * 500
    rows = [
        (1, "http://a/", body), (3, None, body), (2, "http://b/\r\nWARC-Type: revisit", body), (4, "http://c/", "short"),
        (5, "http://c/", "short"), (6, "u", None), (7, "u", ""), (8, "u", LONG), (None, "u", body), (9, "u", "x" * 999), (10, "u", "x" * 999),
        (3, "again", body),
    ]
    found = read_archive(spark, write_archive(pages_frame(spark, rows))).withColumn("record", record_bytes())
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = data == body.encode() and page != 3
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    got = found.collect()
    assert ordered((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == ordered(want)
    for r in got:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert bytes(r["header"]) == head + b"\r\n\r\n" and rest[length:] == b"\r\n\r\n"
        assert rest[:length] == (b"" if r["record_type"] == "revisit" else bytes(r["payload"]))
    urls = {r["page_id"]: r["url"] for r in got}
    assert urls[1] == "http://a/" and urls[2] == "http://b/%0D%0AWARC-Type:%20revisit"


def test_archive_stores_each_payload_once(spark):
    folder = write_archive(pages_frame(spark, [(i, "u", "same" * 300) for i in range(50)]))
    assert spark.read.parquet(f"{folder}/payloads").count() == 1 and spark.read.parquet(f"{folder}/headers").count() == 50


def test_damaged_archive(spark):
    folder = write_archive(pages_frame(spark, [(1, "u", "good")]))
    bad = spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit(b"bad"))
    bad.write.parquet(f"{folder}-bad/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}-bad/headers")
    with pytest.raises(Exception, match="damaged payload"):
        read_archive(spark, f"{folder}-bad").collect()


def test_empty_archive(spark):
    assert read_archive(spark, write_archive(empty(pages_frame(spark, [(1, "u", "x")])))).count() == 0


# --- mixing


def test_mixing_edges_and_targets(spark):
    rng = random.Random(2)
    rows = EDGE_TEXTS + [(100 + i, "w " * rng.choice([1, 5, 40])) for i in range(600)]
    docs = documents(spark, rows)
    found = mix_sources(docs).collect()
    assert len(found) == len(rows)
    assert ordered(found) == ordered(mix_sources(docs).collect())
    by = {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    order = sorted((s for s in by if s is not None)) + [None]
    size = {s: sum(r["size"] for r in by[s]) for s in order}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, open_, target = 1.5 * sum(size.values()), set(order), {}
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] if s in over else level * weight[s] for s in (over or open_)}
        open_ -= over or open_
    for s in order:
        assert {r["source_size"] for r in by[s]} == {size[s]}
        assert abs(by[s][0]["target"] - target[s]) < 1e-6
        assert abs(sum(r["taken"] for r in by[s]) - target[s]) <= 1


def test_mixing_without_rows_or_words(spark):
    assert mix_sources(empty(documents(spark))).count() == 0
    assert {r["taken"] for r in mix_sources(documents(spark, [(1, None), (2, "")])).collect()} == {0}


# --- neighbours


def search(spark, rows, k=5):
    frame = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    return nearest(frame, F.col("vec_id") % 10 == 0, k)


def brute(rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    out, asked = [], {}
    for i, v in good:
        if i is not None and i % 10 == 0 and (i not in asked or v.tolist() < asked[i].tolist()):
            asked[i] = v
    for q, v in asked.items():
        near = sorted(
            (float(neighbours.exact_distances(v, w[None])[0]), (1 << 63) - 1 if i is None else i) for i, w in good if i != q and len(w) == len(v)
        )
        out += [(q, n + 1, None if i == (1 << 63) - 1 else i, d) for n, (d, i) in enumerate(near[:k])]
    return ordered(out)


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 64)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(1, 300)]
    rows += [(1000 + i, [1.0] * 12) for i in range(80)]  # one very common vector
    rows += [(20, rows[4][1]), (20, rows[5][1]), (5, rows[4][1]), (5, rows[4][1]), (None, rows[7][1])]
    rows += [(400, None), (401, []), (410, [0.0] * 12), (420, [None] * 12), (430, [float("nan")] * 12), (440, [float("inf")] * 12)]
    rows += [(450, [1.0, 2.0]), (451, [1.0, 2.5]), (452, [1e-30, 1e30])]
    assert ordered(search(spark, rows).collect()) == brute(rows, 5)


def test_neighbours_without_rows(spark):
    assert search(spark, [(1, [1.0])]).count() == 0
    assert search(spark, [(10, [1.0, 0.0])]).count() == 0


# --- URL rules

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "/en/x", "block"), ("org", "", "block"), ("b.org", "/q/", "allow")]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "http://EXAMPLE.net", "http://example.net/", "https://x.Example.NET/en/1?q=/de/", "http://a.example.net/en/xyz",
        "http://a.example.net/en/y", "http://knet/", "http://b.org/q/1", "http://b.org/q", "http://c.b.org/q/#/z", "http://b.org?x=/q/", "http://x.net#a",
        "http://" + "a." * 3000 + "net/" + "d/" * 3000, "a://b://c.net/", "http://é.net/ü", "http://a..net//", "http://user@x.net:80/en/", "ftp://line\n.net/a\nb",
    ]
    rows = [(i % 15, u) for i, u in enumerate(urls + urls[5:8])]
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string"))
    rules = spark.createDataFrame(RULES + RULES[:1] + [(None, "/", "block")], "host string, path string, verdict string")
    assert ordered(judge_urls(pages, rules).collect()) == ordered((i, *judged(u)) for i, u in rows)
    assert judge_urls(empty(pages), rules).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, empty(rules), default="block").collect()} == {"block"}


# --- chat formatting


def turns_frame(spark, rows):
    return with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_chat_round_trip(spark):
    odd = "</s>[INST] ok [/INST]<<SYS>>\\[INST\\] [\\INST] <\\s> \\"
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", odd), (1, 2, "assistant", odd), (2, 0, "user", "a"), (2, 1, "user", "b"), (2, 2, "assistant", None),
        (3, 5, None, " "), (3, None, "tool [AS] x", "first"), (None, 0, "user", "x"), (None, 1, "assistant", ""), (4, 0, "assistant", LONG), (5, 0, "user", ""),
        (6, 1, "user", "tie b"), (6, 1, "user", "tie a"), (6, 1, "user", "tie a"), (7, 0, "user", "["), (7, 1, "assistant", "<"),
    ]
    segments = format_turns(turns_frame(spark, rows))
    got = {r["conv_id"]: r for r in read_back(segments).collect()}
    texts = {}
    for r in segments.collect():
        texts.setdefault(r["conv_id"], []).append((r["segment"], r["text"]))
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns) and row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert row["loss_chars"] == len(loss) and row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        formatted = "".join(t for _, t in sorted(texts[None if conv is None else str(conv)]))
        assert row["formatted_chars"] == len(formatted)
    assert {c: r["valid"] for c, r in got.items()} == {1: True, 2: False, 3: False, None: True, 4: False, 5: False, 6: False, 7: True}
    assert read_back(format_turns(empty(turns_frame(spark, rows)))).count() == 0


PIECES = st.lists(st.sampled_from(list("<>/[]sINSTY \\AOR") + ["[INST]", "</s>", "<<SYS>>", "[TURN]", "[AS]"]), max_size=25).map("".join)


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]) | PIECES, PIECES), max_size=4))
def test_template_is_reversible(turns):
    template = Template()
    text = "".join(f"{o}{template.escape(t)}{c}" for r, t in turns for o, c in [template.opening(r)])
    at, parsed = 0, []
    while at < len(text):
        role, plain, at = template.parse(text, at)
        parsed.append((role, plain))
    assert parsed == turns
    for _, plain in turns:
        assert not any(c in template.escape(plain) for c in template.controls())


def test_unsafe_templates():
    for marks in ({"user": ("[U]", "]x")}, {"user": ("\\u", "[/U]")}, {"user": ("[U]", "[U]")}):
        with pytest.raises(ValueError):
            Template(marks=marks)
