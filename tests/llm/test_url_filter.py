import re

import pytest

from sparkcdc.llm import url_filter


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    text = "".join(c.lower() if c.isascii() else c for c in url or "")
    there = [t for t in (*url_filter.STRICT, *url_filter.SOFT) if re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", text)]
    soft = [url_filter.SOFT[t] for t in there if t in url_filter.SOFT]
    bad = any(t in url_filter.STRICT for t in there) or (len(soft) >= 2 and sum(soft) >= url_filter.THRESHOLD)
    return host, path, rule, verdict or ("block" if bad else "allow")


URLS = [None, "", "no scheme casino", "http://A.Example.ORG/en/17?x#y", "https://example.org/es/", "https://example.org/ES/", "http://org/x", "http://borg/x",
        "http://x.com/fr/", "http://x.com/de/1", "http://com/de/", "http://x.com?de/", "http://x.net/a://b/c", "ftp://user@h.org:80/x", "http://x.net/free/free",
        "http://free-bets.net", "http://freebets.net", "http://x.net/casino", "http://x.net/casinos", "http://x.net/ecasino", "http://x.net/é" + "casino",
        "http://x.net/" + "bet" * 50_000, "http://x.net/win_win", "http://x.net/WIN/Cheap", "://", "http://", "http://x.net/poker", "http://x.org", "a\nb://x.com/fr/\n?q"]


def test_rows_of_every_sort(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, URLS[3], "h"), (3, URLS[3], "h")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    got = url_filter.judged(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(URLS[3 if r.page_id is None else r.page_id])
    assert url_filter.judged(pages.where("false")).count() == 0


@pytest.mark.parametrize("words", [url_filter.Vocabulary((), {}, 1), url_filter.Vocabulary(("a b",), {"é": 3}, 3, several=1)])
def test_other_vocabularies_and_no_rules(spark, words):
    pages = spark.createDataFrame([(1, "x://a b/é"), (2, "x://ab/éé")], "page_id int, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judged(pages, vocabulary=words, rules=()).collect()}
    assert got == {1: (None, "block" if words.strict else "allow"), 2: (None, "block" if words.strict else "allow")}


def test_query_against_the_letter(spark):
    from sparkcdc.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    urls = dict(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect())
    got = QUERIES["op6_url_filter"](spark, folder).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {k: plain(u) for k, u in urls.items()}


def test_one_soft_term_is_not_several(spark):
    urls = ["http://a.net/poker", "http://a.net/poker/poker", "http://a.net/poker/bet", "http://a.net/casino"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: r.verdict for r in url_filter.judged(pages).collect()}
    assert got == {0: "allow", 1: "allow", 2: "block", 3: "block"}


def test_vocabulary_from_a_table(spark):
    terms = [(f"soft{i}", 1 + i % 3) for i in range(4000)] + [(f"Strict{i}", None) for i in range(1000)]
    terms += [(None, 1), ("", None), ("soft7", 9), ("soft8", None)]
    words = url_filter.Vocabulary.read(spark.createDataFrame(terms, "term string, weight int"), threshold=4)
    assert (len(words.soft), len(words.strict), words.soft["soft7"]) == (3999, 1001, 9)
    urls = ["x://h/soft0/soft3", "x://h/soft2/soft3", "x://h/soft7", "x://h/soft1/soft2", "x://h/STRICT9", "x://h/strict9x", "x://h/soft8"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = [r.verdict for r in sorted(url_filter.judged(pages, vocabulary=words, rules=()).collect())]
    assert got == ["allow", "block", "allow", "block", "block", "allow", "block"]
    with pytest.raises(ValueError):
        url_filter.Vocabulary.read(spark.createDataFrame(terms, "term string, weight int"), limit=100)
    assert url_filter.Vocabulary.read(spark.createDataFrame([], "term string, weight int")).soft == {}
