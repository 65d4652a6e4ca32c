"""Secret spans and URL parts against their definitions on short, odd and very long values."""

import hashlib
import random
import re
import time

import pytest

from plantlake.llm import queries, secret_scan, url_filter

KEYS = ["password", "passwd", "SECRET", "Token", "api_key", "apikey", "x", "AKIA", "😀", "é"]
VALUES = ["abc", "abcdef", "a=b.c/", "AKIA" + "Z" * 15, "AKIA" + "9" * 16, "AKIA" + "Q" * 17, "f" * 23, "0a" * 12, "e" * 25, ""]
GAPS = ["", " ", "=", ": ", '": "', "' = '", "\n", "-", "\t="]


def base_spans(text):
    out = [("assign", m) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = {"assign": 0, "access": 1, "hex": 2}
    return sorted((m.start(), order[k], k, m.end()) for k, m in out)


def test_base_spans_of_random_texts_and_one_row_for_each(spark):
    pick = random.Random(11)
    texts = ["token=abc", "AKIA12", "plain", None, "", "token=abc AKIA12 ffff"]
    texts += ["".join(pick.choice(pick.choice((KEYS, VALUES, GAPS))) for _ in range(pick.randint(1, 9))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in secret_scan.digest(secret_scan.find_spans(df)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = base_spans(t or "")
        counts = [sum(k == kind for _, _, k, _ in want) for kind in ("assign", "access", "hex")]
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == counts, t
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in want)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), t
        assert set(filter(None, text.split(","))) <= set(got[i].spans.split(","))


def test_spans_of_nothing_and_of_long_runs(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, spans int")
    assert secret_scan.find_spans(empty).columns == ["doc_id", "n_assign", "n_access", "n_hex", "spans"]
    assert secret_scan.find_spans(empty).count() == 0
    start = time.time()
    df = spark.createDataFrame([(1, "x" * 400_000 + " a://b")], "doc_id bigint, text string")
    assert secret_scan.find_spans(df).first().spans == []
    assert time.time() - start < 30


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = re.sub("[A-Z]", lambda m: m[0].lower(), rest[:cut])
    path = re.split("[?#]", rest[cut:])[0] if rest[cut : cut + 1] == "/" else ""
    return host, path


@pytest.mark.parametrize("seed", [1, 2])
def test_urls_with_separators_anywhere(spark, seed):
    pick = random.Random(seed)
    bits = ["http", "://", "/", "?", "#", "Example.org", "h.com", "com", "/fr/", "/de/", "/en/1", "/es/", "next=", "É", "\n", ".", "", "sub.example.org"]
    urls = ["https://example.com?next=https://x.org/en/1", "http://h.com#a://b/fr/x", "://", "a://", "://b", None, "", "x://y/z"]
    urls += ["".join(pick.choice(bits) for _ in range(pick.randint(1, 8))) for _ in range(500)]
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: r for r in url_filter.judge(df, rules).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = parts(u)
        fits = [(h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, url_filter.DEFAULT))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u


def test_urls_of_an_empty_table(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    none = spark.createDataFrame([], "page_id bigint, url string, host int, rule int")
    got = url_filter.judge(none, rules)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"] and got.count() == 0
