"""No input makes a pattern slow, and none loses or gains text."""

import time

import pytest

from tablelearn.llm import decontaminate, htmltree, pii, toxicity


@pytest.fixture(autouse=True)
def quick():
    t = time.perf_counter()
    yield
    assert time.perf_counter() - t < 3


def test_cut_off_and_hostile_tags():
    attrs = " ".join(f'a{i}="v"' for i in range(40))
    assert htmltree.main_text(f"<p>Hello there</p><img {attrs}") == "Hello there"
    assert htmltree.main_text("<p>Hello</p><img " + "'\" = " * 100_000) == "Hello"
    assert htmltree.main_text("<p>Hello</p><img " + "x='\"" * 100_000 + "<b>") == "Hello"
    assert htmltree.main_text("<p>One</p>" + "<svg>" * 50_000 + "<p>Two</p>") == "One\n\nTwo"
    assert htmltree.main_text('<p title="a > b">x</p><p title="open>y</p><p>z "q" \'s</p>') == "x\n\ny\n\nz \"q\" 's"
    assert htmltree.main_text("<p>a < b <i>c</i> <3") == "a < b c <3"


@pytest.mark.parametrize("tag", ["svg", "noscript", "select", "iframe", "object", "canvas", "template"])
def test_open_raw_elements_keep_the_page(tag):
    assert htmltree.main_text(f"<p>One</p><{tag}><p>Two</p>") == "One\n\nTwo"
    assert htmltree.main_text(f"<p>One</p><{tag}>gone</{tag}><p>Two</p>") == "One\n\nTwo"


def test_open_title_script_and_inline_math():
    assert htmltree.main_text("<title>T<p>One</p>") == "One"
    assert htmltree.main_text("<p>One</p><script>var x = '<p>no</p>'") == "One"
    assert htmltree.main_text("<p>Let <math><mi>x</mi></math> be</p>") == "Let x be"


def test_long_runs_beside_an_address():
    blob = "aB3x/9Qz+" * 110_000
    text = f"{blob}@b.org and mail jo@ex.org now {blob}"
    spans = pii.base_spans(text)
    at = text.index("jo@ex.org")
    assert ("email", at, at + 9) in spans
    wins = pii.windows(blob[:50_000] + "@" + blob[:50_000])
    assert max(b - a for a, b in wins if b - a > 5000) <= 2 * pii.MAX_SIDE + 1
    assert pii.windows("write to [jo@ex.org] or a(at)b.c") == [(9, 20), (24, 32)]


def test_long_runs_of_marks():
    dashes = "-" * 100_000
    assert decontaminate.tokens(f"{dashes}a{dashes}b{dashes} {dashes} _c_") == [f"a{dashes}b", "c"]
    assert toxicity.bucket(f"{dashes}word{dashes}") == toxicity.bucket("word") == toxicity.bucket("12Word_3")
