"""URL filter, decontamination, archives and search on small tables of odd rows."""

import hashlib
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from accordance.llm import op4_url_reputation as url
from accordance.llm import op5_winnowing as winnow
from accordance.llm import op7_arc as arc
from accordance.llm import op10_pivots as pivots
from accordance.llm.queries import URL_RULES
from accordance.llm.tables import lower_ascii, new_path, words_of
from tests.llm import brute


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"),
        "https://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "x://org/fr/a": ("org", "/fr/a", "org/fr/", "allow"),
        "http://b.org/FR/": ("b.org", "/FR/", None, "allow"),
        "http://c.net": ("c.net", "", None, "allow"),
        "http://c.net?x=/": ("c.net", "", None, "allow"),
        "http://c.net#/": ("c.net", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "no scheme/en": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://É.Net:80/a b": ("É.net:80", "/a b", None, "allow"),
        "http://user@u.net/\n": ("user@u.net", "/\n", "net/", "block"),
    }
    rows = [(n, u, "x", "y") for n, u in enumerate(cases)] + [(None, "http://c.net", "", ""), (0, next(iter(cases)), "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, bad string")
    outcomes = spark.createDataFrame([(1, True), (1, False), (None, True)], "page_id long, bad boolean")
    got = Counter(tuple(r) for r in url.filter_urls(pages, outcomes, URL_RULES).collect())
    expected = Counter((n, *cases[u]) for n, u, *_ in rows)
    assert got == expected
    assert url.filter_urls(pages.where("false"), outcomes, URL_RULES).count() == 0
    assert url.filter_urls(pages, outcomes.where("false"), URL_RULES).count() == len(rows)


def test_bad_hosts_are_blocked_and_shrink_to_their_domain(spark):
    rows, bad = [], []
    for n in range(400):  # a bad domain of many hosts, a good one, and a host with one bad page
        rows += [(3 * n, f"http://h{n % 40}.bad.org/"), (3 * n + 1, f"http://h{n % 40}.good.org/")]
        bad += [(3 * n, n % 11 != 0), (3 * n + 1, n % 47 == 0)]
    rows += [(5000, "http://new.bad.org/"), (5001, "http://new.good.org/"), (5002, "http://one.other.org/")]
    bad += [(5002, True)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    outcomes = spark.createDataFrame(bad, "page_id long, bad boolean")
    got = {r.page_id: r.verdict for r in url.filter_urls(pages, outcomes, {}).collect()}
    assert {got[3 * n] for n in range(400)} == {"block"} and {got[3 * n + 1] for n in range(400)} == {"allow"}
    assert (got[5000], got[5001], got[5002]) == ("block", "allow", "allow")


def test_hosts_are_held_against_the_rate_of_all_pages(spark):
    """A host far above a low rate is blocked though most of its pages are good; with a higher lift it isn't."""
    pages = spark.sql("SELECT id AS page_id, concat('http://h', id % 20, '.x', id % 20, '.org/') AS url FROM range(8000)")
    outcomes = pages.selectExpr("page_id", "id_in % IF(page_id % 20 = 3, 3, 25) = 0 AS bad".replace("id_in", "(page_id DIV 20)"))
    judged = url.filter_urls(pages, outcomes, {}).where("verdict = 'block'").select("host").distinct()
    assert [r.host for r in judged.collect()] == ["h3.x3.org"]
    assert url.filter_urls(pages, outcomes, {}, lift=8.0).where("verdict = 'block'").isEmpty()


def test_posterior_is_between_host_and_prior(spark):
    hosts = spark.createDataFrame(
        [("a.x.org", 9, 10), ("b.x.org", 1, 10), ("c.x.org", 0, 0), ("d.y.co.uk", 5, 10)], "host string, k long, n long"
    )
    got = {r.host: r.a / (r.a + r.b) for r in url.host_reputation(hosts).collect()}
    assert 0.1 < got["b.x.org"] < got["c.x.org"] < got["a.x.org"] < 0.9
    names = spark.createDataFrame([("a.b.co.uk",), ("b.org",), ("org",), ("",)], "h string")
    h = names.select(url.domain_of(url.F.col("h")), url.suffix_of(url.F.col("h"))).collect()
    assert [tuple(r) for r in h] == [("b.co.uk", "co.uk"), ("b.org", "org"), ("org", "org"), ("", "")]


def brute_hits(text, items, window=10):
    w = brute.words(text)
    hit, found = set(), set()
    for item_id, item in items:
        own = brute.words(item)
        size = min(window, len(own))
        windows = {tuple(own[s : s + size]) for s in range(len(own) - size + 1)} if own and item_id is not None else set()
        for s in range(len(w) - size + 1) if windows else ():
            if tuple(w[s : s + size]) in windows:
                hit.update(range(s, s + size))
                found.add(str(item_id))
    return len(hit), sorted(found)


def test_every_shared_window_is_found(spark):
    """Few words, so that chance hits, ties and repeated windows abound; items of every length."""
    rng = random.Random(9)
    text = lambda n, words: " ".join(rng.choice(words) for _ in range(n))
    few, many = "a b c".split(), [f"w{n}" for n in range(60)]
    items = [(n, text(n, many)) for n in range(1, 30)] + [(100 + n, text(n, few)) for n in range(6, 24, 3)]
    items += [(200, None), (201, ""), (None, "w1 w2 w3"), (1, items[0][1]), (202, "same words here"), (203, "Same, WORDS; here")]
    docs = [(n, text(rng.randrange(60), rng.choice([few, many]))) for n in range(60)]
    for n in range(60, 90):
        part = rng.choice(items)[1] or ""
        docs.append((n, f"{text(5, many)} {part.upper()}! {text(4, many)}"))
    docs += [(500, None), (501, ""), (7, "another text of seven"), (None, items[20][1]), (501, ""), (502, "x " * 50_000 + items[25][1])]
    df = spark.createDataFrame([(*d, "a", 1) for d in docs], "doc_id long, text string, words string, t int")
    items_df = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, n_hit int")
    got = Counter((r.doc_id, r.text, r.n_hit or 0, tuple(r.item_ids or ())) for r in winnow.marked(df, items_df).collect())
    expected = Counter()
    for doc_id, own in docs:
        n_hit, found = brute_hits(own, items)
        expected[doc_id, own, n_hit, tuple(found)] += 1
    assert got == expected
    long_items = [i for i in items if i[0] is not None and len(brute.words(i[1])) >= 10]
    long_df = spark.createDataFrame([(*i, 0) for i in long_items], "item_id long, text string, n_hit int")
    got = {(r.doc_id, r.text): r.n_hit for r in winnow.contamination(df, long_df).join(df.select("doc_id", "text"), "doc_id").collect()}
    assert all(got.get(d, 0) == brute_hits(d[1], long_items)[0] for d in docs if list(zip(*docs))[0].count(d[0]) == 1 and d[0] is not None)
    assert winnow.contamination(df, items_df.where("false")).count() == 0
    assert winnow.marked(df.where("false"), items_df).count() == 0
    clashing = df.selectExpr("doc_id", "text", "t AS N_HIT", "words AS _doc", "words AS `f.x`", "t AS _key")
    own = winnow.marked(clashing, items_df)
    assert own.columns == ["doc_id", "text", "_doc", "f.x", "_key", "n_hit", "item_ids"] and own.count() == len(docs)
    kept = winnow.without_contaminated(df, items_df)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(d for d in docs if not brute_hits(d[1], items)[0])


PAGES = [
    (5, "http://a/", "x" * 100), (2, "http://a/", "x" * 100), (9, "http://b c/\n\t", "x" * 100), (3, None, "y" * 99),
    (4, "", "y" * 99), (1, "http://é/", None), (6, "u", ""), (7, "u", "línea\r\n\r\nWARC/1.1\r\n" + "é" * 60),
    (8, "u", "línea\r\n\r\nWARC/1.1\r\n" + "é" * 60), (None, "n", "z" * 200), (10, "n", "z" * 200), (2, "http://a/", "x" * 100),
    (11, "filedesc://x", "\n" * 150), (12, "u", "long " * 100_000),
]


def test_archives_come_back(spark):
    pages = spark.createDataFrame([(*p, 0, "d") for p in PAGES], "page_id long, url string, html string, offset int, digest string")
    rows = arc.archive_pages(pages).collect()
    first = {}
    for page_id, _, html in PAGES:
        if page_id is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page_id), page_id)
    expected = Counter()
    seen = set()
    for page_id, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        data = (html or "").encode()
        revisit = html in first and len(data) >= 100 and html in seen
        seen.add(html)
        kind = "revisit" if revisit else "response"
        expected[page_id, len(data), hashlib.sha256(data).hexdigest(), kind, first[html] if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == expected
    ids = {r.record_id for r in rows}
    assert len(ids) == len(rows) and {r.refers_to_id for r in rows if r.record_type == "revisit"} <= ids
    assert {r.warc_date for r in rows} == {"2024-02-29T12:34:56Z"}
    assert arc.archive_pages(pages.where("false")).count() == 0


def test_both_versions_are_parsed_by_their_declared_lengths(spark, monkeypatch):
    v1 = b"filedesc://a 0.0.0.0 20010203040506 text/plain 8\n1 0 own\n\n"
    v1 += b"http://a/ 1.2.3.4 20010203040506 text/html 5\nx\n\ny\n\n"
    v2 = b"filedesc://b 0.0.0.0 20010203040506 text/plain 200 - - 0 b 8\n2 0 own\n\n"
    v2 += b"http://b/ 1.2.3.4 20020203040506 text/html 404 sum - 70 b 0\n\n"
    got = [r[1:] for r in arc.parse_arc(v1 + v2)]
    assert got == [
        ("http://a/", "20010203040506", "text/html", b"x\n\ny\n"),
        ("http://b/", "20020203040506", "text/html", b""),
    ]
    for wrong in (v1[:-4], v1 + b"http://b/ 1.2.3.4 20020203040506 text/html 404 sum - 70 b 0\n\n", v1.replace(b"1 0 own", b"3 0 own")):
        with pytest.raises(ValueError):
            list(arc.parse_arc(wrong))
    monkeypatch.setattr(arc, "ARCHIVE_RECORDS", 3)
    pages = spark.range(20).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "repeat('a', CAST(id AS INT)) AS html")
    path = new_path(spark, "arc")
    arc.write_arc(pages.coalesce(1), path)
    rows = arc.read_arc(spark, path, contents=True).collect()
    assert {(r.page_id, r.url, r.payload) for r in rows} == {(n, f"http://h/{n}", "a" * n) for n in range(20)}


def brute_top(rows, k=5):
    vectors = [
        (i, [int((256 * x) // 1) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and x == x and abs(x) != float("inf") for x in v)
    ]
    out = set()
    for q, x in vectors:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q)
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def test_search_is_exact(spark):
    rng = random.Random(3)
    rows = [(n, [rng.gauss(0, 1) for _ in range(12)]) for n in range(300)]
    rows += [(n, [float(n % 3), 0.0, 0.5]) for n in range(300, 360)]  # ties and shorter vectors
    rows += [(1000, None), (1001, []), (1002, [None, 1.0]), (1003, [float("nan")]), (1004, [float("inf")]), (None, [1.0])]
    rows += [(n, [1e6] * 12) for n in range(2000, 2052)]  # sums beyond 2^53
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, rank int, score string")
    is_query = pivots.F.col("vec_id") % 50 == 0
    for block in (pivots.BLOCK, 2):
        got = pivots.top_k(df.repartition(7), is_query, block=block)
        assert {tuple(r) for r in got.collect()} == brute_top(rows)
    assert pivots.top_k(df.where("vec_id = 0"), is_query).count() == 0
    assert pivots.top_k(df.where("vec_id < 3"), is_query).count() == 2
    assert pivots.top_k(df.where("false"), is_query).count() == 0


def test_words_end_at_the_same_characters_and_take_no_slow_pattern(spark):
    every = ["a" + "".join(map(chr, range(n, n + 4096))) + "b" for n in range(0, 0x110000, 4096) if not 0xD000 <= n < 0xE000]
    texts = [None, "", *every, *(f"x{chr(n)}y" for n in (*range(0x300), 0xD7FF, 0xE000, 0xFFFF, 0x10000, 0x10FFFF))]
    rows = spark.createDataFrame(list(enumerate(texts)), "n long, text string")
    got = dict(rows.select("n", words_of(rows.text).alias("w")).collect())
    assert got == {n: brute.words(t) for n, t in enumerate(texts)}

    # A negated class takes six to nine times as long.
    docs = [(" ".join(f"Wörter{n % 97} of text {n}," for n in range(20_000)),)] * 8
    long = spark.createDataFrame(docs, "text string").repartition(4).cache()
    text, negated = F.col("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def seconds(words):
        times = []
        for _ in range(3):
            began = time.perf_counter()
            long.agg(F.sum(F.size(words))).collect()
            times.append(time.perf_counter() - began)
        return min(times)

    slow = seconds(F.regexp_extract_all(lower_ascii(text), negated, F.lit(0)))
    fast = seconds(words_of(text))
    long.unpersist()
    assert fast < 0.6 * slow, (fast, slow)
