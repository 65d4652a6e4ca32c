"""Main text of held-out pages whose article stands in an element without a telling name."""

import re

import pyarrow.parquet as pq
import pytest

from conftest import SF_SMALL
from plantlake.llm import html_extract as x


def unnamed(source, tag, attributes=""):
    source = re.sub(r"<(?:article|main)\b[^>]*>", f"<{tag}{attributes}>", source)
    return re.sub(r"</(?:article|main)>", f"</{tag}>", source)


def expected(source):
    page = x.parse(source)
    return x.kept_text(page, x.teacher(page))


def recall_and_precision(model, pairs):
    right = wanted = found = 0
    for source, text in pairs:
        page = x.parse(source)
        got = x.kept_text(page, x.decode(page.parent, model.log_odds(x.features(page)))).split("\n")
        want = text.split("\n")
        right += sum(b in want for b in got)
        wanted, found = wanted + len(want), found + len(got)
    return right / wanted, right / found


@pytest.fixture(scope="module")
def pages():
    sources = pq.read_table(f"{SF_SMALL}/pages.parquet")["html"].to_pylist()
    return [s for s in sources if s and x.teacher(x.parse(s))]


@pytest.fixture(scope="module")
def split(pages):
    cut = 2 * len(pages) // 3
    return pages[:cut][: x.SAMPLE], pages[cut:]


@pytest.fixture(scope="module")
def model(split):
    return x.fit(split[0])


@pytest.mark.parametrize("tag, attributes", [("article", ""), ("div", ' class="content"'), ("div", ""), ("section", ""), ("div", ' class="x1"')])
def test_the_container_needs_no_known_word(split, model, tag, attributes):
    recall, precision = recall_and_precision(model, [(unnamed(s, tag, attributes), expected(s)) for s in split[1]])
    assert recall >= 0.95 and precision >= 0.98


def test_no_class_or_id_at_all(split, model):
    strip = lambda s: re.sub(r' (?:class|id)="[^"]*"', "", unnamed(s, "div"))
    recall, precision = recall_and_precision(model, [(strip(s), expected(s)) for s in split[1]])
    assert recall >= 0.95 and precision >= 0.95


def test_other_layouts(split, model):
    made = [(source, "\n".join(" ".join(b.split()) for b in blocks)) for source, blocks in x.layouts(split[1], 2, seed=99)]
    recall, precision = recall_and_precision(model, made)
    assert recall >= 0.95 and precision >= 0.95


def test_a_corpus_that_marks_no_article(split):
    model = x.fit([unnamed(s, "div") for s in split[0]])
    recall, precision = recall_and_precision(model, [(unnamed(s, "div"), expected(s)) for s in split[1]])
    assert recall >= 0.8 and precision >= 0.9


def test_nothing_to_learn_from_keeps_everything():
    model = x.fit(["<p>too short</p>", ""])
    page = x.parse("<div>a<p>b</div>")
    assert x.kept_text(page, x.decode(page.parent, model.log_odds(x.features(page)))) == "a\nb"
