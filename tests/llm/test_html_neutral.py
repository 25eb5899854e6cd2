"""op5 on layouts whose names say nothing, on tags that are left out, and on very deep pages."""

import collections
import time

import pyarrow.parquet as pq
import pytest
import xxhash
from page_layouts import KINDS, pages

from noticeweave.llm import html


@pytest.fixture(scope="module")
def model():
    sources = [h for h in pq.read_table("/root/testdata/sf0.1/pages.parquet").column("html").to_pylist() if h]
    return html.train(sorted(sources, key=lambda h: xxhash.xxh64(h.encode(), seed=42).intdigest())[: html.SAMPLE])


def extracted(model, sources):
    parsed = [html.blocks(s) for s in sources]
    return ["\n".join(t for (_, t), yes in zip(page, labels) if yes) for page, labels in zip(parsed, model.label(html.features(parsed)))]


def test_articles_where_names_say_nothing(model):
    made = list(pages(30, "test"))
    exact = collections.Counter(kind for (kind, _, wanted), got in zip(made, extracted(model, [s for _, s, _ in made])) if got == wanted)
    assert sum(exact.values()) >= 27 * len(KINDS) and all(exact[kind] >= 20 for kind in KINDS), exact


def test_pages_that_mark_their_article(model):
    others = [h for h in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist() if h]
    wanted = ["\n".join(t for place, t in html.blocks(h) if html.marked_main(place)) for h in others]
    assert sum(a == b for a, b in zip(extracted(model, others), wanted)) >= 0.99 * len(others)


def test_a_head_ends_at_what_it_cannot_hold():
    say = lambda page: [t for _, t in html.blocks(page)]
    assert say("<html><head><title>t</title><p>Hello</p>") == ["Hello"]
    assert say("<head><meta charset=x><style>p{}</style><link rel=y><body>Hi") == ["Hi"] and say("<head><title>t</title>Hello <b>you</b>") == ["Hello you"]
    assert say("<head><noscript><img></noscript><script>a</script></head><div>x</div>") == ["x"] and say("<title>t</title><h1>x") == ["x"]


def test_links_are_seen_however_deep():
    linked = lambda page: [place.linked for place, _ in html.blocks(page)]
    assert linked("<p><a><b><i><u><em><span>link</span></em></u></i></b></a></p>") == [True]
    assert linked("<p><a href=x>a</a> and much more text than that</p><p>x <a>y</p><p>z</p>") == [False, False, False]


def test_deep_pages_take_seconds(model):
    for page, count in (("<div>x" * 20_000, 20_000), ("<b>x</p></i>" * 20_000, 20_000), ("<ul><li>x" * 10_000, 10_000), ("<div class='a b'>" * 100_000 + "x", 1)):
        began = time.perf_counter()
        parsed = html.blocks(page)
        assert len(parsed) == count
        model.label(html.features([parsed]))
        assert time.perf_counter() - began < 20
